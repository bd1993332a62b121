"""Deduplication: exact, by line, by episode, by SimHash, by containment.

"First" always means the least value of an explicit order column. Groups are never gathered: the first of a group is an
aggregate, and near-duplicate pairs are made between representatives of equal fingerprints only.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .lineage_cut import checkpointed


def first_by(df: DataFrame, key: Column, order: str, keep: list[str] | None = None) -> DataFrame:
    """The first row of each key: its order value, ``keep`` columns, and how many rows the key has."""
    row = F.struct(order, *(keep or []))
    out = df.groupBy(key.alias("key")).agg(F.min(row).alias("r"), F.count("*").alias("copies"))
    return out.select("key", "r.*", "copies")


def exact_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    return first_by(docs, F.sha2(F.col(text), 256), order)


def line_dedup(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """First place (document, line number) of each good, normalised line."""
    lines = docs.select(order, F.posexplode(F.split(F.col(text), "\n")).alias("n", "raw")).withColumn("line_no", F.col("n").cast("long"))
    lines = lines.select(order, "line_no", T.normalize(F.col("raw")).alias("line")).where(T.good_line(F.col("line")))
    out = lines.groupBy(F.md5("line").alias("line_md5")).agg(F.min(F.struct(order, "line_no")).alias("r"), F.count("*").alias("copies"))
    return out.select("line_md5", "r.*", "copies")


def simhash(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = 5) -> DataFrame:
    """64-bit SimHash of word n-grams over ``[a-z0-9]`` text; low 64 bits of MD5. Signed, same bit pattern.

    The n-grams of a document are exploded where it lies; votes are summed there, so one row per document is shuffled.
    """
    words = T.words(F.regexp_replace(F.lower(F.col(text)), r"[^a-z0-9\s]", ""))
    grams = F.transform(F.array(words), lambda w: F.when(F.size(w) < n, F.array(F.array_join(w, " "))).otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))))[0]
    digest = docs.select(key, F.explode(grams).alias("g")).select(key, F.md5("g").alias("m"))
    half = lambda at: F.conv(F.substring("m", at, 8), 16, 10).cast("long")
    h = digest.select(key, F.shiftleft(half(17), 32).bitwiseOR(half(25)).alias("h"))
    votes = h.groupBy(key).agg(*[F.sum(F.shiftright("h", b).bitwiseAND(F.lit(1)) * 2 - 1).alias(f"b{b}") for b in range(64)])
    bits = [F.shiftleft(F.when(F.col(f"b{b}") > 0, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), b) for b in range(64)]
    return votes.select(key, reduce(lambda a, b: a.bitwiseOR(b), bits).alias("fingerprint"))


def block_keys(fingerprint: Column, threshold: int, spare: int = 3) -> Column:
    """Array of keys, one for each choice of ``spare`` of threshold + spare blocks: prints within the threshold differ in
    ``threshold`` blocks at most, so they agree on one choice at least. A key holds spare / (threshold + spare) of the 64
    bits, 27 for a threshold of 4, so unequal prints seldom meet."""
    m = threshold + spare
    edges = [64 * i // m for i in range(m + 1)]
    part = [F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.xxhash64(F.lit(i), *[part[j] for j in some]) for i, some in enumerate(combinations(range(m), spare))])


def near_pairs(prints: DataFrame, threshold: int = 4, key: str = "doc_id") -> DataFrame:
    """Pairs (a < b) of different fingerprints within the threshold, each named by its first document.

    Membership of the rest is ``prints`` itself: equal fingerprints are one class.
    """
    reps = prints.groupBy("fingerprint").agg(F.min(key).alias("rep"))
    keyed = reps.select("rep", "fingerprint", F.explode(block_keys(F.col("fingerprint"), threshold)).alias("k"))
    left, right = keyed.alias("l"), keyed.alias("r")
    distance = F.bit_count(F.col("l.fingerprint").bitwiseXOR(F.col("r.fingerprint")))
    pairs = left.join(right, (F.col("l.k") == F.col("r.k")) & (F.col("l.rep") < F.col("r.rep")) & (distance <= threshold))
    return pairs.select(F.col("l.rep").alias("a"), F.col("r.rep").alias("b"), distance.alias("distance")).distinct()


def greedy_near_dedup(prints: DataFrame, threshold: int = 4, key: str = "doc_id") -> DataFrame:
    """Documents kept when each, in order, is dropped if an earlier kept one lies within the threshold.

    Rounds over the pairs of representatives: one whose earlier neighbours are all decided is decided. Every round is a
    checkpoint; there are as many as the longest chain of earlier neighbours.
    """
    pairs = checkpointed(near_pairs(prints, threshold, key))
    nodes = prints.groupBy("fingerprint").agg(F.min(key).alias("rep")).select("rep")
    state = checkpointed(nodes.join(pairs.select(F.col("b").alias("rep")).distinct().withColumn("open", F.lit(True)), "rep", "left").select("rep", F.when(F.col("open"), F.lit(None)).otherwise(F.lit(True)).cast("boolean").alias("kept")))
    while state.where("kept is null").limit(1).count():
        seen = pairs.join(state.select(F.col("rep").alias("a"), "kept"), "a").groupBy(F.col("b").alias("rep")).agg(F.coalesce(F.bool_or("kept"), F.lit(False)).alias("hit"), F.bool_and(F.col("kept").isNotNull()).alias("done"))
        state = checkpointed(state.join(seen, "rep", "left").select("rep", F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("hit"), False).when(F.col("done"), True).alias("kept")))
    return state.where("kept").select(F.col("rep").alias(key))


def drop_contained(texts: Column) -> Column:
    """Array of texts without those contained in another; of equal ones the first stays. Longest win."""
    indexed = F.transform(texts, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    covers = lambda a, b: F.contains(b["x"], a["x"]) & ((F.length(b["x"]) > F.length(a["x"])) | ((b["x"] == a["x"]) & (b["i"] < a["i"])))
    return F.transform(F.array(indexed), lambda s: F.transform(F.filter(s, lambda a: ~F.exists(s, lambda b: covers(a, b))), lambda a: a["x"]))[0]
