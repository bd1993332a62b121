"""Operator 8: near-duplicate documents by SimHash and anchor-point covering.

Fingerprints: majority bits of XXH64 over word shingles. Exact repeats collapse first, so what follows sees each
fingerprint once. The covering code is a product of repetition codes: the 64 bits are cut into ``k`` blocks and every
block is all zeros or all ones, 2**k anchors in all; a fingerprint's home is the anchor its blocks' majorities give. A
pair within the threshold meets at one of the two homes, so it is enough to replicate a fingerprint to every anchor that
is the home of something within the threshold of it (these all lie within covering radius plus threshold), and of those
only to anchors above its own home. ``k`` grows with the logarithm of the number of fingerprints, so homes stay small.
Each anchor compares its homes with its visitors in blocks and returns a spanning forest of the links it found, never
all pairs; an anchor over ``anchor_rows`` is dealt out in a grid of chunks.

Nulls: a null or wordless text has fingerprint zero, linked like any other. A null doc_id keeps its row; it never names
a component unless all its members are null. Repeated rows share a component. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, materialize, small_parts, tidy

_BITS = np.array([[(v >> b) & 1 for b in range(8)] for v in range(256)], np.int64)


def shingle_hashes(text: bytes | None, shingle: int = 3, seed: int = 42) -> list[int]:
    """Hashes of the word shingles of one text: A-Z lower-cased, words joined by one space. Fewer words are one shingle."""
    words = (text or b"").lower().split()
    n = len(words)
    if n <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = [0, *ends[: n - shingle].tolist()]
    return [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]


def fingerprint(text: bytes | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned SimHash of one text."""
    return majority(np.array(shingle_hashes(text, shingle, seed), "<u8"))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes (little-endian uint64), as an unsigned integer."""
    if not len(hashes):
        return 0
    octets = hashes.view(np.uint8).reshape(-1, 8)
    votes = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, ``text_key`` (xxhash64 of the text) and ``fp``, the fingerprint's bits as a signed long."""

    def run(batches):
        for batch in small_parts(batches):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            prints = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], names=["doc_id", "text_key", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_key")).mapInArrow(run, "doc_id long, text_key long, fp long")


def blocks(k: int) -> list[tuple[int, int]]:
    """(first bit, length) of k nearly equal blocks of the 64 bits."""
    edges = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def anchors(prints: np.ndarray, k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) pairs: each print's home first, then all anchors above it that it must visit."""
    home = np.zeros(len(prints), np.int64)
    cost = np.empty((k, len(prints)), np.int64)
    for i, (first, length) in enumerate(blocks(k)):
        mask = np.uint64(((1 << length) - 1) << first)
        ones, need = np.bitwise_count(prints & mask).astype(np.int64), length // 2 + 1
        home |= (ones >= need).astype(np.int64) << i
        cost[i] = np.where(ones >= need, ones - need + 1, need - ones)
    rows, found = [np.arange(len(prints))], [home]
    for size in range(1, threshold + 1):
        for flip in combinations(range(k), size):
            at = np.nonzero(sum(cost[i] for i in flip) <= threshold)[0]
            to = home[at] ^ sum(1 << i for i in flip)
            up = to > home[at]
            rows.append(at[up])
            found.append(to[up])
    return np.concatenate(rows), np.concatenate(found)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, smallest node of its component) with the same components as the links a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def tree(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some of the links a-b themselves, with the same components as all of them and no cycle."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = flat[: len(a)], flat[len(a) :]
    label, live, taken = np.arange(len(nodes)), np.arange(len(a)), []
    while True:
        x, y = label[i[live]], label[j[live]]
        live, x, y = live[x != y], x[x != y], y[x != y]
        if not len(live):
            break
        high, first = np.unique(np.maximum(x, y), return_index=True)  # each root hangs on one smaller one
        label[high] = np.minimum(x, y)[first]
        taken.append(live[first])
        while (label[label] != label).any():
            label = label[label]
    keep = np.concatenate(taken) if taken else live
    return a[keep], b[keep]


def links_of(homes: np.ndarray, visitors: np.ndarray, threshold: int, cells: int = 1_000_000, span=forest) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of all links between homes and visitors within the threshold."""
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    step = max(1, cells // max(1, len(visitors)))
    for i in range(0, len(homes), step):
        part = homes[i : i + step]
        near = np.bitwise_count(part[:, None] ^ visitors[None, :]) <= threshold
        x, y = np.nonzero(near)
        x, y = part[x].view(np.int64), visitors[y].view(np.int64)
        off = x != y
        if off.any():
            u, v = span(x[off], y[off])
            a.append(u)
            b.append(v)
    return np.concatenate(a), np.concatenate(b)


def anchor_links(distinct: DataFrame, threshold: int = 3, home_size: int = 128, anchor_rows: int = 100_000, true_links: bool = False) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``distinct(fp)`` within the threshold. With true_links each is itself
    within it; else they are stars, which components() takes in fewer rounds. ``distinct`` is a written table.

    k, the blocks of the code, grows until a block has two bits, at 2**32 anchors.
    """
    k = min(32, max(4, (max(1, distinct.count() // home_size) - 1).bit_length()))
    span = tree if true_links else forest

    def spread(batches):
        for batch in batches:
            rows = batch.column(0).to_numpy().view(np.uint64)
            for i in range(0, len(rows), 2000):
                part = rows[i : i + 2000]
                at, to = anchors(part, k, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(part[at].view(np.int64)), pa.array(np.arange(len(at)) < len(part))], names=["anchor", "fp", "home"])

    met = distinct.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean")
    size = met.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    hot = materialize(size.where(F.col("all") > anchor_rows), "simhash")
    if hot.isEmpty():
        dealt = met.select("anchor", F.lit(0).alias("hc"), F.lit(0).alias("vc"), "fp", "home", F.lit(True).alias("visit"))
    else:
        grid = hot.select("anchor", F.ceil(F.col("homes") / anchor_rows).cast("int").alias("nh"), F.ceil(F.col("all") / anchor_rows).cast("int").alias("nv"))
        dealt = met.join(broadcast_if_small(grid), "anchor", "left").fillna(1, ["nh", "nv"])
        at = F.hash("fp")
        sides = F.array(F.struct(F.lit(True).alias("visit")), F.struct(F.lit(False).alias("visit")))
        dealt = dealt.select("*", F.explode(sides).alias("s")).where("s.visit or home")
        dealt = dealt.select("anchor", "fp", F.col("s.visit").alias("visit"), F.explode(F.sequence(F.lit(0), F.when(F.col("s.visit"), F.col("nh")).otherwise(F.col("nv")) - 1)).alias("c"), F.pmod(at, "nh").alias("h"), F.pmod(at, "nv").alias("v"))
        dealt = dealt.select("anchor", F.when(F.col("visit"), F.col("c")).otherwise(F.col("h")).alias("hc"), F.when(F.col("visit"), F.col("v")).otherwise(F.col("c")).alias("vc"), "fp", (~F.col("visit")).alias("home"), "visit")

    def compare(t: pa.Table) -> pa.Table:
        fp, home = t.column("fp").to_numpy().view(np.uint64), t.column("home").to_numpy(zero_copy_only=False)
        a, b = links_of(fp[home], fp[t.column("visit").to_numpy(zero_copy_only=False)], threshold, span=span)
        if len(a):
            a, b = span(a, b)
        return pa.table({"a": a, "b": b})

    return dealt.groupBy("anchor", "hc", "vc").applyInArrow(compare, "a long, b long")


@tidy
def near_duplicates(docs: DataFrame, threshold: int = 3, shingle: int = 3, seed: int = 42, home_size: int = 128, anchor_rows: int = 100_000, similarity: float | None = None) -> DataFrame:
    """doc_id, fp (signed long) and component_id, the smallest doc_id reachable over links of <= threshold bits.

    With ``similarity``: doc_id, text_key and root, which names the component over all pairs of documents whose shingle
    sets have that Jaccard. Links of <= threshold bits are verified by it, and what they have not connected is completed
    (see jaccard.py).
    """
    if similarity is not None:
        from .jaccard import similar_documents  # which needs the functions above

        return similar_documents(docs, similarity, shingle, seed, threshold, home_size, anchor_rows)
    prints = materialize(fingerprints(docs, shingle, seed), "simhash")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash")
    roots = components(anchor_links(distinct, threshold, home_size, anchor_rows), "simhash")
    classes = materialize(distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "simhash")
    names = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = classes.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def fingerprint_hex(fp):
    """Column: 16 lowercase hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
