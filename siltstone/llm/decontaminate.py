"""Operator 2: benchmark decontamination, DataFrame functions only.

Words are runs of letters and digits, lower-cased; shingles are five words. A window as long as an item (in words) is
compared with it when both SimHash fingerprints lie within ``radius`` bits: the fingerprint is cut into radius + 1
blocks, and two fingerprints within the radius agree on one block at least, so an equi-join on (length, block, value)
finds every such pair. Candidates are verified by exact weighted-shingle similarity (multiset Jaccard).

Windows that can't pass the verification are never hashed: similarity s of two windows of n shingles needs 2sn/(1+s)
shared ones, so only windows are built in which that many positions hold a shingle of some item of that length. This
drops nothing that the verification would keep. They come of the sorted positions: a run of that many hits that fits a
window gives its starts, and runs give disjoint ones, so rows are hits and windows to be verified, never their product.

Two windows at a similarity of just 0.8 differ in about 10 of 64 bits. In a simulation (40,000 pairs each of 50, 100 and
200 words without repeats, 11 % of them changed) more than 21 bits differ in 0.02 %, 0.01 % and 0.01 % of pairs, more
than 15 in 2 to 3 %; so the radius is 21, and that is the loss at the border.

Very long texts go whole; a match costs the square of its item's length, as each of its windows is verified.

Nulls: null texts have no words. Items and documents under five words match nothing. A null doc_id is a value like any
other. Repeated rows match alike. An empty table on either side gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, let, materialize, tidy

def normal_words(text: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(clean, " "), lambda w: w != "")

def shingle_hashes(words: Column, n: int = 5) -> Column:
    """Hashes of all n-word shingles of an array of words."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *[F.get(words, i + j) for j in range(1, n)]))

def simhash_votes(hashes: str) -> list[Column]:
    """64 aggregates: votes for each bit less votes against it."""
    return [F.sum(F.shiftright(hashes, b).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"b{b}") for b in range(64)]

def fingerprint_of_votes() -> Column:
    out = F.lit(0).cast("long")
    for b in range(64):
        out = out.bitwiseOR(F.shiftleft(F.when(F.col(f"b{b}") > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), b))
    return out

def index_blocks(fp: Column, radius: int) -> Column:
    """Array of (block, value) of the radius + 1 blocks of a fingerprint."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])

@tidy
def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, shingle: int = 5, radius: int = 21) -> DataFrame:
    """One row (doc_id, text_key, item_id, similarity) for each document and item that it holds a window of.

    text_key is xxhash64 of the text.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), normal_words(F.col("text")).alias("words"))
    items = materialize(items.where(F.size("words") >= shingle).select("*", F.size("words").alias("w"), shingle_hashes(F.col("words"), shingle).alias("grams")), "decon")
    grams = materialize(items.select("w", F.explode("grams").alias("gram")).distinct(), "decon")

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    spread = slim.select("doc_id", "text_key", F.posexplode(let(normal_words(F.col("text")), lambda w: shingle_hashes(w, shingle))).alias("pos", "gram"))
    hits = spread.join(broadcast_if_small(grams), "gram").groupBy("doc_id", "text_key", "w").agg(F.array_sort(F.collect_set("pos")).alias("ps"))

    width = F.col("w") - (shingle - 1)
    least = F.ceil(F.lit(2 * similarity / (1 + similarity)) * width - 1e-9).cast("int")
    lasts = F.slice("ps", least, F.greatest(F.size("ps") - least + 1, F.lit(0)))
    runs = F.transform(lasts, lambda last, i: F.struct(F.greatest(last - width + 1, F.get("ps", i - 1) + 1, F.lit(0)).alias("a"), F.get("ps", i).alias("b")))
    starts = hits.select("doc_id", "text_key", "w", F.explode(F.filter(runs, lambda r: r["a"] <= r["b"])).alias("r"))
    starts = starts.select("doc_id", "text_key", "w", F.explode(F.sequence("r.a", "r.b")).alias("start"))

    wanted = materialize(starts.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("w", "start")).alias("at")), "decon")
    right = broadcast_if_small(wanted).alias("r")

    held = slim.alias("l").join(right, F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_key") == F.col("r.text_key")))
    held = held.select("l.doc_id", "l.text_key", normal_words(F.col("text")).alias("words"), "at")
    windows = held.select("doc_id", "text_key", F.explode(let(F.col("words"), lambda x: F.transform("at", lambda p: F.struct(p["w"].alias("w"), p["start"].alias("start"), F.slice(x, p["start"] + 1, p["w"]).alias("words"))))).alias("p"))
    windows = materialize(windows.select("doc_id", "text_key", "p.*"), "decon")

    keys = ["doc_id", "text_key", "w", "start"]
    prints = windows.select(*keys, F.explode("words").alias("word")).select(*keys, F.xxhash64("word").alias("h"))
    prints = prints.groupBy(*keys).agg(*simhash_votes("h")).select(*keys, fingerprint_of_votes().alias("fp"))
    item_prints = items.select("item_id", "w", F.explode("words").alias("word")).select("item_id", "w", F.xxhash64("word").alias("h"))
    item_prints = item_prints.groupBy("item_id", "w").agg(*simhash_votes("h")).select("item_id", "w", fingerprint_of_votes().alias("item_fp"))
    left = prints.select(*keys, "fp", F.explode(index_blocks(F.col("fp"), radius)).alias("k")).select(*keys, "fp", "k.*")
    index = materialize(item_prints.select("item_id", "w", "item_fp", F.explode(index_blocks(F.col("item_fp"), radius)).alias("k")).select("item_id", "w", "item_fp", "k.*"), "decon")
    near = left.join(broadcast_if_small(index), ["w", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    pairs = near.select(*keys, "item_id").distinct()

    sides = [F.col(f"l.{k}") for k in keys]
    on = F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.text_key") == F.col("r.text_key")) & (F.col("l.w") == F.col("r.w")) & (F.col("l.start") == F.col("r.start"))
    ours = pairs.alias("l").join(windows.dropDuplicates(keys).alias("r"), on).select(*sides, "item_id", F.explode(shingle_hashes(F.col("r.words"), shingle)).alias("gram"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    theirs = pairs.join(broadcast_if_small(items.select("item_id", "grams")), "item_id").select(*keys, "item_id", F.explode("grams").alias("gram"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    weights = ours.unionByName(theirs).groupBy(*keys, "item_id", "gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    scored = weights.groupBy(*keys, "item_id").agg((F.sum(F.least("a", "b")) / F.sum(F.greatest("a", "b"))).alias("similarity"))
    return scored.where(F.col("similarity") >= similarity).groupBy("doc_id", "text_key", "item_id").agg(F.max("similarity").alias("similarity"))

ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT item_id, list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '') AS ws FROM benchmark),
dg AS (SELECT doc_id, i AS pos, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - 3)) AS i FROM d)),
bg AS (SELECT item_id, n, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT *, len(ws) - 4 AS n, unnest(range(1, len(ws) - 3)) AS i FROM b)),
bc AS (SELECT item_id, n, g, count(*) AS c FROM bg GROUP BY ALL),
hit AS (SELECT dg.doc_id, bc.item_id, bc.n, pos FROM dg JOIN bc USING (g)),
top AS (SELECT doc_id, max(pos) AS last FROM dg GROUP BY doc_id),
st AS (SELECT doc_id, item_id, n, s, count(*) AS c FROM (SELECT *, unnest(range(greatest(pos - n + 1, 1), pos + 1)) AS s FROM hit) GROUP BY ALL),
cand AS (SELECT st.* FROM st JOIN top USING (doc_id) WHERE c >= ceil(1.6 / 1.8 * n - 1e-9) AND s + n - 1 <= last),
wc AS (SELECT cand.doc_id, item_id, n, s, dg.g, count(*) AS a FROM cand JOIN dg ON dg.doc_id = cand.doc_id AND dg.pos BETWEEN s AND s + n - 1 GROUP BY ALL),
sim AS (SELECT wc.doc_id, wc.item_id, wc.s, sum(least(a, coalesce(bc.c, 0))) AS shared, wc.n FROM wc LEFT JOIN bc ON bc.item_id = wc.item_id AND bc.g = wc.g GROUP BY ALL)
SELECT doc_id, item_id, round(max(shared / (2 * n - shared)), 6) AS similarity FROM sim WHERE shared / (2 * n - shared) >= 0.8 GROUP BY doc_id, item_id
"""
