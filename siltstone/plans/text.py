"""Queries of the text functions over ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..registry import query, table


def _sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _sql_words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def _sql_without(x: str, patterns: list[str], flags: str) -> str:
    for p in patterns:
        quoted = p.replace("'", "''")
        x = f"regexp_replace({x}, '(?{flags}){quoted}', '', 'g')"
    return x


_SQL_INDENT = rf"""array_to_string(list_transform(string_split(t, chr(10)), lambda l: CASE WHEN (starts_with(l, '  ') OR starts_with(l, chr(9))) AND regexp_matches(l, '\S')
    THEN repeat(' ', least(length(l) - length(regexp_replace(l, '^\s+', '')), 8)) || array_to_string({_sql_words('l')}, ' ') ELSE array_to_string({_sql_words('l')}, ' ') END), chr(10))"""


def _kept(c):
    """Rows whose text is not null. A filter would be pushed below the projection and clean every text twice."""
    return F.explode(F.array_compact(F.array(c)))


@query(rf"SELECT doc_id, {_sql_strip(r'''regexp_replace(lower(text), '\s+', ' ', 'g')''')} AS text FROM documents")
def normalize_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.normalize(F.col("text")).alias("text"))


@query(
    rf"""WITH a AS (SELECT doc_id, {_sql_without(_sql_without('text', T.RFC_LINES, 'm'), T.BOILERPLATE, 'im')} AS t FROM documents),
b AS (SELECT doc_id, regexp_replace(replace(replace(replace(nfc_normalize(t), chr(160), ' '), chr(8217), ''''), chr(8212), '--'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS t FROM a),
c AS (SELECT doc_id, {_sql_strip(rf'''regexp_replace({_SQL_INDENT}, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g')''')} AS text FROM b)
SELECT doc_id, text FROM c WHERE length(text) >= 400"""
)
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _kept(T.clean(F.col("text"))).alias("text"))


@query(rf"SELECT doc_id, {_SQL_INDENT} AS text FROM (SELECT doc_id, text AS t FROM documents)")
def indent_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.indent_lines(F.col("text")).alias("text"))


@query(
    r"""SELECT doc_id, kind, regexp_replace(regexp_replace(CASE WHEN kind IN ('code', 'readme') THEN regexp_replace(regexp_replace(regexp_replace(text, '<reponame>[^\n]*\n?', '', 'g'), '<filename>[^\n]*\n?', '', 'g'), '<gh_stars>[^\n]*\n?', '', 'g')
 WHEN kind = 'reddit' THEN regexp_replace(regexp_replace(text, '(?m)^\[deleted\]:\s*', '', 'g'), '(?m)^\[removed\]\s*$', '', 'g') ELSE text END, '^([^\S\n]*\n)+', ''), '(\n[^\S\n]*)+$', '') AS text
FROM (SELECT *, CASE source WHEN 'src0' THEN 'code' WHEN 'src1' THEN 'readme' WHEN 'src2' THEN 'reddit' WHEN 'src3' THEN 'stackexchange' ELSE 'generic' END AS kind FROM documents)"""
)
def clean_by_source(spark, sf_dir):
    # the dimension of source types is five literal rows, so a CASE replaces the look-up join
    kind = F.col("source")
    kind = F.when(kind == "src0", "code").when(kind == "src1", "readme").when(kind == "src2", "reddit").when(kind == "src3", "stackexchange").otherwise("generic")
    return table(spark, sf_dir, "documents").withColumn("kind", kind).select("doc_id", "kind", T.clean_by_source(F.col("text"), F.col("kind")).alias("text"))


_HEADED = "CASE doc_id % 3 WHEN 0 THEN '# Copyright 2024 A' || chr(10) || '# more' || chr(10) WHEN 1 THEN '/* x Copyright y */' || chr(10) ELSE '' END || text"


@query(
    rf"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '^/\*[\s\S]*?(?i:Copyright)[\s\S]*?\*/\s*\n?', ''), '^#\s*(?i:Copyright).*\n(#.*\n)*', ''), '^\n+', '') AS text FROM (SELECT doc_id, {_HEADED} AS t FROM documents)"""
)
def strip_license(spark, sf_dir):
    """Every third document gets a comment header of either kind first."""
    head = F.when(F.col("doc_id") % 3 == 0, "# Copyright 2024 A\n# more\n").when(F.col("doc_id") % 3 == 1, "/* x Copyright y */\n").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", T.strip_license(F.concat(head, "text")).alias("text"))


@query(
    rf"""WITH a AS (SELECT doc_id, {_sql_strip('text')} AS t FROM documents),
b AS (SELECT doc_id, {_sql_strip(rf'''regexp_replace(regexp_replace({_sql_without('t', T.WEB_LINES, 'im')}, '\n{{4,}}', chr(10) || chr(10) || chr(10), 'g'), '[ \t]{{4,}}', '   ', 'g')''')} AS text FROM a)
SELECT doc_id, text FROM b WHERE len({_sql_words('text')}) BETWEEN 30 AND 10000"""
)
def clean_web_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _kept(T.clean_web(F.col("text"))).alias("text"))


@query()
def truncate_references(spark, sf_dir):
    """Documents with a list of citations appended to those whose id is even."""
    refs = "".join(f"\n[{i}] Author title" for i in range(1, 31))
    text = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit(refs))).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", _kept(T.truncate_references(text)).alias("text"))


_TAGLESS = _sql_strip(r"regexp_replace(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')")


@query(
    rf"""WITH a AS (SELECT doc_id, {_TAGLESS} AS t FROM documents), b AS (SELECT doc_id, t, left(t, 8192) AS h FROM a WHERE length(t) >= 200)
SELECT doc_id, CASE WHEN length(t) <= 8192 THEN t WHEN contains(h, '.') AND 8192 - strpos(reverse(h), '.') > 8192 * 0.7 THEN left(h, 8193 - strpos(reverse(h), '.')) ELSE h END AS text FROM b"""
)
def clean_passage(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _kept(T.clean_passage(F.col("text"))).alias("text"))


@query(
    rf"""WITH a AS (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(text, 'https?://\S+|www\.\S+', '[URL]', 'g'), chr(10)), lambda l: {_sql_strip('l')}), lambda l: l <> ''), chr(10)) AS text FROM documents)
SELECT doc_id, text FROM a WHERE len({_sql_words('text')}) BETWEEN 10 AND 2000"""
)
def mask_urls(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", _kept(T.clean_comment(F.col("text"))).alias("text"))


@query(
    """SELECT doc_id, CASE WHEN length(text) <= 500 THEN text WHEN contains(left(text, 500), ' ') AND 500 - strpos(reverse(left(text, 500)), ' ') > 350
THEN left(text, 500 - strpos(reverse(left(text, 500)), ' ')) || '...' ELSE left(text, 500) || '...' END AS text FROM documents"""
)
def truncate_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.truncate_words(F.col("text")).alias("text"))


@query(
    rf"""WITH t AS (SELECT {_sql_strip(r'''regexp_replace(regexp_replace(regexp_replace(lower(text), '"[^"]+"', '"{X}"', 'g'), '\b\d+\b', '{N}', 'g'), '\s+', ' ', 'g')''')} AS x FROM conversations WHERE role = 'user')
SELECT count(*) AS total, count(DISTINCT x) AS templates, round(count(DISTINCT x) / greatest(count(*), 1), 6) AS ratio FROM t"""
)
def template_diversity(spark, sf_dir):
    t = table(spark, sf_dir, "conversations").where("role = 'user'").select(T.template_of(F.col("text")).alias("x"))
    return t.agg(F.count("*").alias("total"), F.count_distinct("x").alias("templates")).select("total", "templates", F.round(F.col("templates") / F.greatest("total", F.lit(1)), 6).alias("ratio"))


@query(
    rf"""WITH a AS (SELECT page_id, regexp_extract(html, '(?i)<title[^>]*>([^<]+)</title>', 1) AS title, regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g') AS t FROM pages),
b AS (SELECT page_id, title, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '<br\s*/?>', chr(10), 'g'), '</p>', chr(10) || chr(10), 'g'), '</div>', chr(10), 'g'), '</h[1-6]>', chr(10) || chr(10), 'g'), '<[^>]+>', ' ', 'g') AS t FROM a),
c AS (SELECT page_id, title, replace(replace(replace(replace(replace(t, '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"') AS t FROM b),
d AS (SELECT page_id, nullif({_sql_strip('title')}, '') AS title, {_sql_strip(r'''regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g')''')} AS text FROM c)
SELECT page_id, title, CASE WHEN length(text) > 100 THEN text END AS text FROM d"""
)
def html_regex_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.html_title(F.col("html")).alias("title"), T.html_text(F.col("html")).alias("text"))


@query(
    rf"""WITH a AS (SELECT doc_id, {_sql_strip('p')} AS p FROM (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS p FROM documents)),
b AS (SELECT doc_id, {_sql_strip("replace(p, chr(10), ' ')")} AS p FROM a WHERE NOT (starts_with(p, '#') OR starts_with(p, '```') OR starts_with(p, '|') OR starts_with(p, '---')))
SELECT doc_id, CASE WHEN length(p) <= 500 THEN p WHEN contains(left(p, 500), ' ') THEN left(p, 500 - strpos(reverse(left(p, 500)), ' ')) || '...' ELSE left(p, 500) || '...' END AS passage FROM b WHERE length(p) >= 80"""
)
def passages(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(T.passages(F.col("text"))).alias("passage"))


@query()
def extractive_summary(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.extractive_summary(F.regexp_replace("text", "\n", "\n\n"), 500).alias("summary"))


@query(
    rf"""SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE length(line) BETWEEN 20 AND 2000 AND length(line) - length(replace(line, ' ', '')) >= 3"""
)
def good_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(T.good_line(F.col("line")))


_REASON = r"""CASE WHEN n < 5 THEN 'too few lines' WHEN len(list_filter(ls, lambda l: length(l) > 1000)) > n * 0.1 THEN 'likely minified' WHEN (length(text) - n + 1) / n > 200 THEN 'average line too long'
WHEN regexp_matches(left(text, 2000), '(?m)^// Code generated .* DO NOT EDIT|(?i)^# This file is auto-generated|^# Generated by') THEN 'generated'
WHEN len(list_filter(ls, lambda l: regexp_matches(l, '\S'))) < n * 0.3 THEN 'too sparse' ELSE 'ok' END"""
_LINED = "(SELECT *, len(ls) AS n FROM (SELECT *, string_split(text, chr(10)) AS ls FROM documents))"


@query(f"SELECT doc_id, {_REASON} AS reason FROM {_LINED}")
def code_quality_reason(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.code_quality(F.col("text")).alias("reason"))


@query(f"SELECT source, reason, count(*) AS docs FROM (SELECT source, {_REASON} AS reason FROM {_LINED}) GROUP BY source, reason")
def filter_reasons(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source", T.code_quality(F.col("text")).alias("reason")).agg(F.count("*").alias("docs"))


@query(
    rf"""SELECT doc_id, CASE WHEN len(list_intersect(list_distinct(({_sql_words('lower(text)')})[1:50]), {T.GERMAN!r})) >= 3 THEN 'de' ELSE 'en' END AS language FROM documents"""
)
def detect_language(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.detect_language(F.col("text")).alias("language"))


@query(
    rf"""WITH a AS (SELECT doc_id, {_sql_strip('text')} AS t FROM documents), b AS (SELECT doc_id, length(t) AS n, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS k FROM a)
SELECT doc_id, round(k / greatest(n, 1), 6) AS ratio FROM b WHERE n >= 20 AND k / greatest(n, 1) >= 0.3"""
)
def alpha_ratio(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", T.alpha_ratio(F.col("text")).alias("r"), F.length(T.strip(F.col("text"))).alias("n"))
    return d.where("n >= 20 and r >= 0.3").select("doc_id", F.round("r", 6).alias("ratio"))
