"""Operator 9: quality rules with adaptive thresholds, DataFrame functions only.

Counts are taken over each whole text. Fixed floor: at least ``min_words`` words, and at most half of them in repeated
three-word windows. Beyond that, each language and source has thresholds of its own: mergeable quantile sketches of the
ratios of its rows (``percentile_approx``, combined map-side and again after one small shuffle) give quartiles, and a row
is rejected where a ratio lies beyond its group's fence: ``spread`` interquartile ranges plus a least margin.

Nulls: a null text has no words and fails the floor; null languages or sources form groups like any value. A ratio
without a denominator is null and rejects nothing. Repeated rows are judged alike. An empty table gives no rows. The
input's columns travel in the struct ``row``, so no name of theirs can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, broadcast_if_small, let, materialize, tidy

_SPACES = " \t\n\x0b\x0c\r"
# The symbols counted.
_SYMBOLS = "#*$%&|<>"
#: Ratio: (side that rejects, least margin beyond the quartile).
RULES = {"mean_word": ("both", 1.5), "symbol_ratio": ("high", 0.05), "dup_line_ratio": ("high", 0.5), "repeat_ratio": ("high", 0.35)}


def _repeats(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more."""
    hashes = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = lambda s: F.filter(s, lambda e, j: F.coalesce(e["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get(s, j + 1)["h"], F.lit(False)))
        return let(
            let(ordered, lambda s: F.transform(again(s), lambda e: e["i"])),
            lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda i: i + 1), F.transform(p, lambda i: i + 2)))),
        )

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def metrics(text: Column) -> Column:
    """Struct of the counts of one text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    solid = F.translate(text, _SPACES, "")
    words = F.filter(F.split(text, SPACE_CLASS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, _SPACES, "") != "")
    of_words = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeats(w).cast("long").alias("r")))
    of_lines = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    return F.struct(
        of_words.alias("w"), of_lines.alias("l"), F.length(solid).cast("long").alias("chars"),
        (F.length(text) - F.length(F.translate(text, _SYMBOLS, ""))).cast("long").alias("symbols"),
    )


@tidy
def quality_rules(docs: DataFrame, carry: list[str] | None = None, min_words: int = 50, max_repeat_percent: int = 50, spread: float = 3.0) -> DataFrame:
    """Adds to every row its counts, base_failed and kept. ``carry``: the columns to bring along in ``row`` (all)."""
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or docs.columns)]).alias("row")
    m = docs.select(row, F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), metrics(F.col("text")).alias("m"))
    m = m.select(
        "row", "g_lang", "g_source", F.col("m.w.n").alias("n_words"), F.col("m.chars").alias("word_chars"), F.col("m.symbols").alias("n_symbols"),
        F.col("m.l.d").alias("n_dup_lines"), F.col("m.w.r").alias("n_repeat_words"), F.col("m.l.n").alias("n_lines"),
    )
    m = materialize(m, "quality")
    ratio = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    m = m.select(
        "*", ratio("word_chars", "n_words").alias("mean_word"), ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"), ratio("n_repeat_words", "n_words").alias("repeat_ratio"),
        ((F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))).alias("base_failed"),
    )
    quartiles = [F.percentile_approx(c, [0.25, 0.75], 10000).alias(f"q_{c}") for c in RULES]
    fences = m.where(~F.col("base_failed")).groupBy("g_lang", "g_source").agg(*quartiles)
    fences = materialize(fences, "quality-fences").select(F.col("g_lang").alias("f_lang"), F.col("g_source").alias("f_source"), *[f"q_{c}" for c in RULES])
    joined = m.join(broadcast_if_small(fences), F.col("g_lang").eqNullSafe(F.col("f_lang")) & F.col("g_source").eqNullSafe(F.col("f_source")), "left")
    bad = F.lit(False)
    for c, (side, margin) in RULES.items():
        low, high = F.col(f"q_{c}")[0], F.col(f"q_{c}")[1]
        reach = spread * (high - low) + margin
        bad = bad | F.coalesce(F.col(c) > high + reach, F.lit(False))
        if side == "both":
            bad = bad | F.coalesce(F.col(c) < low - reach, F.lit(False))
    return joined.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~bad).alias("kept"))


# Quartiles in the oracle: the sketch returns the value of rank ceil(q * n), which is quantile_disc.
ORACLE = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, lang, source, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
      FROM (SELECT *, unnest(range(1, len(ws) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS rep FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(rep, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, word_chars / nullif(n_words, 0) AS mean_word, n_symbols / nullif(word_chars, 0) AS symbol_ratio, n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
             n_repeat_words / nullif(n_words, 0) AS repeat_ratio, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m),
q AS (SELECT lang, source, quantile_disc(mean_word, [0.25, 0.75]) AS a, quantile_disc(symbol_ratio, [0.25, 0.75]) AS s, quantile_disc(dup_line_ratio, [0.25, 0.75]) AS l,
             quantile_disc(repeat_ratio, [0.25, 0.75]) AS p FROM b WHERE NOT base_failed GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(mean_word > a[2] + 3 * (a[2] - a[1]) + 1.5, false) OR coalesce(mean_word < a[1] - (3 * (a[2] - a[1]) + 1.5), false)
         OR coalesce(symbol_ratio > s[2] + 3 * (s[2] - s[1]) + 0.05, false) OR coalesce(dup_line_ratio > l[2] + 3 * (l[2] - l[1]) + 0.5, false)
         OR coalesce(repeat_ratio > p[2] + 3 * (p[2] - p[1]) + 0.35, false)) AS kept
FROM b LEFT JOIN q ON b.lang IS NOT DISTINCT FROM q.lang AND b.source IS NOT DISTINCT FROM q.source
"""
