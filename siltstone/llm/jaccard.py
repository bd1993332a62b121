"""Operator 8 with a similarity: SimHash links verified and completed to all pairs of a Jaccard of word shingles.

A document is its set of XXH64 values over five-word shingles (words as in simhash.py). Equal sets collapse first. Then:

1. Anchors link fingerprints within the threshold; of each print's links the least and the greatest are verified on the
   whole sets. This joins exact and close copies, and large groups of copies nearly whole, at two links a document.
2. At a Jaccard of 0.8 five-word fingerprints differ by about 10 bits of 64, which no anchors can cover, so what is left
   is completed without loss. Two sets of n shingles with a Jaccard of s or more share one among the first
   n - ceil(s n) + 1 of each, in any order that all documents keep. Each set emits only these. Where many rows of a batch
   have one shingle and one group found so far, they become one row before the shuffle, so that no group of copies makes
   a hot shingle. Shingles that one group alone emits end there. Of every other shingle, its least set is compared with
   the least of each group.
3. Of shingles that still join different groups, all pairs of sets in different groups that can reach s by their sizes
   and places are verified; rows of a shingle's largest group meet only other groups. Shingles with rows combined, or too
   many to hold, bring their rows again for this. A shingle's rows are compared where they lie, in blocks of a square if
   one task can't hold them, so that a pair to be ruled out never becomes a row.

Before a pair's whole sets are fetched, the counts of their shingles by the first bits give an upper bound of the
similarity; only pairs that it leaves are verified.

The order takes shingles of seldom used buckets first, by counts over all documents, so that phrases which many documents
share are not what they meet by. Any counts give the same result.

Nulls: null and wordless texts have the empty set and are one group; a text under five words is one shingle. Repeated
rows share a group. Ties don't matter: groups are whole components. A text may be of any length; its set is held in
memory by itself. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, components, drop, materialize, small_parts, tidy
from .repeats import _batch, release
from .simhash import anchor_links, majority, shingle_hashes

_BITS = 16


def shingle_set(text: bytes | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """Sorted different shingle hashes of one text."""
    return np.unique(np.array(shingle_hashes(text, shingle, seed), "<u8"))


def prefix(grams: np.ndarray, ranks: np.ndarray, shift: int, similarity: float) -> np.ndarray:
    """What a set must emit: its first shingles by rank of the bucket, then hash."""
    order = np.lexsort((grams, ranks[grams >> np.uint64(shift)]))
    return grams[order[: len(grams) - ceil(similarity * len(grams) - 1e-9) + 1]]


def bucket_counts(slim: DataFrame, sample: int, shingle: int, seed: int) -> np.ndarray:
    """Shingles by the first bits of their hash, over all documents, or one in ``sample``."""

    def tally(batches):
        counts = np.zeros(1 << _BITS, np.int64)
        for batch in small_parts(batches, 500):
            found = [shingle_set(t, shingle, seed) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            if found:
                counts += np.bincount((np.concatenate(found) >> np.uint64(64 - _BITS)).astype(np.int64), minlength=1 << _BITS)
        at = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "c"])

    some = (slim.where(F.pmod("text_key", F.lit(sample)) == 0) if sample > 1 else slim).select("text")
    table = some.mapInArrow(tally, "bucket long, c long").groupBy("bucket").agg(F.sum("c").alias("c")).toArrow()
    out = np.zeros(1 << _BITS, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("c").to_numpy()
    return out


#: Bits of the counts that bound a pair's similarity.
_COUNTS = 7


def counts_of(grams: np.ndarray) -> bytes:
    """Shingles of a set by their first bits; 255 stands for that many or more."""
    return np.minimum(np.bincount((grams >> np.uint64(64 - _COUNTS)).astype(np.int64), minlength=1 << _COUNTS), 255).astype(np.uint8).tobytes()


def may_reach(n: np.ndarray, m: np.ndarray, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m shingles with these counts (a row of uint8 each) can have the similarity."""
    both = np.minimum(x, y)
    return (both == 255).any(axis=1) | (both.sum(axis=1, dtype=np.int64) >= similarity / (1 + similarity) * (n + m) - 1e-6)


#: A set in the place of a shingle: (size, set, place of the shingle in its order).
_ITEM = ["n", "set", "pos"]


def can_reach(n: int, pos: int, m: int, at: int, similarity: float) -> bool:
    """Whether sets of n and m shingles can have the similarity if the first one they share is at these places: all
    before it is in one set only, a share of their sizes at most."""
    return min(n, m) >= similarity * max(n, m) - 1e-6 and (pos + at) * (1 + similarity) <= (n + m) * (1 - similarity) + 1e-6


#: Rows of one shingle and group that a batch leaves apart, and rows of one shingle that a task holds.
_APART, _HELD = 64, 4096


def emit(batches):
    """Rows (set, n, root, firsts) -> (gram, root, n, set, pos, many): one for each shingle, or with ``many`` the least
    one of those of a group."""
    for batch in small_parts(batches):
        firsts = batch.column(3)
        sizes = firsts.value_lengths().to_numpy()
        at = np.repeat(np.arange(len(sizes)), sizes)
        gram, n, name, root = firsts.flatten().to_numpy(), batch.column(1).to_numpy()[at], batch.column(0).to_numpy()[at], batch.column(2).to_numpy()[at]
        pos = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.lexsort((name, n, root, gram))
        gram, root = gram[order], root[order]
        lead = np.ones(len(order), bool)
        lead[1:] = (gram[1:] != gram[:-1]) | (root[1:] != root[:-1])
        run = np.cumsum(lead) - 1
        many = (np.bincount(run, minlength=1) > _APART)[run] if len(run) else lead
        keep = lead | ~many
        order = order[keep]
        columns = [gram[keep], root[keep], n[order], name[order], pos[order].astype(np.int32), many[keep]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "root", *_ITEM, "many"])


def met(similarity: float):
    """Sorted by gram, root, n and set: the rows of each shingle that has two roots. The first row of each root but the
    first one also has in ``a`` the first set, if they can have the similarity. Of a shingle with combined rows, or more
    than a task holds, only the first row of each root comes, with ``many``."""
    names, kinds = ["gram", "root", *_ITEM, "many", "a"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.int64()]

    def run(batches):
        gram, held, many, out = None, [], False, []

        def close():
            if not held or held[0][1] == held[-1][1]:
                return
            first, root = held[0], held[0][1]
            for row in held:
                new, root = row[1] != root, row[1]
                if new or not many or row is first:
                    near = new and can_reach(first[2], first[4], row[2], row[4], similarity)
                    out.append((*row[:5], many, first[3] if near else None))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != gram:
                    close()
                    gram, held, many = row[0], [row], row[5]
                elif row[3] != held[-1][3] or row[5] > many:
                    many |= row[5]
                    if not many and len(held) >= _HELD:
                        many = True
                        held = [x for i, x in enumerate(held) if not i or x[1] != held[i - 1][1]]
                    if row[3] != held[-1][3] and (not many or row[1] != held[-1][1]):
                        held.append(row)
            if len(out) > 20_000:
                yield _batch(out, names, kinds)
                out.clear()
        close()
        yield _batch(out, names, kinds)

    return run


def cells():
    """Column: the cells of a shingle's square of ``nb`` blocks by ``nb`` that a row goes to, with its role there: 0 both
    sides (one block), 1 left, 2 right. Rows of the main group are on no left side."""
    at, every = F.pmod(F.hash("set"), "nb"), F.sequence(F.lit(0), F.col("nb") - 1)
    cell = lambda h, v, role: F.struct(h.alias("h"), v.alias("v"), F.lit(role).alias("role"))
    left, right = F.transform(every, lambda v: cell(at, v, 1)), F.transform(every, lambda h: cell(h, at, 2))
    return F.when(F.col("nb") == 1, F.array(cell(F.lit(0), F.lit(0), 0))).when(F.col("main"), right).otherwise(F.concat(left, right))


def _cells_of(batches):
    """Tables of whole cells from a sorted stream."""
    held = []
    for batch in batches:
        held.append(batch)
        key = [batch.column(k).to_numpy() for k in ("gram", "h", "v")]
        last = np.logical_and.reduce([k == k[-1] for k in key]) if batch.num_rows else np.ones(0, bool)
        cut = int(np.argmin(last[::-1])) if not last.all() else 0
        if cut:
            done = pa.Table.from_batches([*held[:-1], batch.slice(0, batch.num_rows - cut)])
            tail, held = batch.slice(batch.num_rows - cut), []
            if done.num_rows:
                yield done
            held = [tail]
    if held:
        yield pa.Table.from_batches(held)


def _able_pairs(t: pa.Table, similarity: float, most: int = 1_000_000):
    """Rows (i, j) of whole cells that can have the similarity by size and place: different groups, each pair once."""
    gram, h, v, role, root, n, name, pos = (t.column(k).to_numpy() for k in ("gram", "h", "v", "role", "root", *_ITEM))
    main = t.column("main").to_numpy()
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (h[1:] != h[:-1]) | (v[1:] != v[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(gram)))
    cell = np.cumsum(new) - 1
    left = np.flatnonzero((role != 2) & ~main & (size[cell] > 1))
    ends = np.cumsum(size[cell[left]])
    at = 0
    while at < len(left):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        i = left[at:to]
        many = size[cell[i]]
        j = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - start[cell[i]], many)
        i = np.repeat(i, many)
        near = (np.minimum(n[i], n[j]) >= np.maximum(n[i], n[j]) * similarity - 1e-6) & ((pos[i].astype(np.int64) + pos[j]) * (1 + similarity) <= (n[i].astype(np.int64) + n[j]) * (1 - similarity) + 1e-6)
        once = main[j] | (n[j] < n[i]) | ((n[j] == n[i]) & (name[j] < name[i]))
        ok = near & once & (role[j] != 1) & (root[i] != root[j])
        yield i[ok], j[ok]
        at = to


def partnered(similarity: float):
    """Of the rows of each cell, those with a partner."""

    def run(batches):
        for t in _cells_of(batches):
            keep = np.zeros(t.num_rows, bool)
            for i, j in _able_pairs(t, similarity):
                keep[i] = keep[j] = True
            yield from t.filter(pa.array(keep)).combine_chunks().to_batches()

    return run


def bounded_pairs(similarity: float):
    """Pairs of sets of each cell that the bound by counts leaves."""

    def run(batches):
        for t in _cells_of(batches):
            name, n = t.column("set").to_numpy(), t.column("n").to_numpy().astype(np.int64)
            counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8).reshape(-1, 1 << _COUNTS)
            for i, j in _able_pairs(t, similarity, 100_000):
                ok = may_reach(n[i], n[j], counts[i], counts[j], similarity)
                yield pa.RecordBatch.from_arrays([pa.array(name[i[ok]]), pa.array(name[j[ok]])], names=["a", "b"])

    return run


@tidy
def similar_documents(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, seed: int = 42, threshold: int = 3, home_size: int = 128, anchor_rows: int = 100_000, sample_docs: int | None = None) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text) and root, which names the component over all pairs of ``similarity``. The order
    of shingles comes of all documents; only a caller that sets ``sample_docs``, as a test of other orders does, has it come
    of about so many, with the same result."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_key"))
    sample = max(1, slim.count() // sample_docs) if sample_docs else 1
    ranks = docs.sparkSession.sparkContext.broadcast(bucket_counts(slim, sample, shingle, seed))

    def scan(batches):
        for batch in small_parts(batches):
            keys, sizes, firsts, prints, counts = [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                hashes = np.array(shingle_hashes(text, shingle, seed), "<u8")
                grams = np.unique(hashes)
                keys.append(xxhash.xxh3_64_intdigest(grams.tobytes()))
                sizes.append(len(grams))
                firsts.append(prefix(grams, ranks.value, 64 - _BITS, similarity).view(np.int64))
                prints.append(majority(hashes))
                counts.append(counts_of(grams))
            made = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (keys, prints)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made, pa.array(sizes, pa.int32()), pa.array(firsts, pa.list_(pa.int64())), pa.array(counts, pa.binary())], names=["doc_id", "text_key", "set", "fp", "n", "firsts", "counts"])

    rows = materialize(slim.mapInArrow(scan, "doc_id long, text_key long, set long, fp long, n int, firsts array<long>, counts binary"), "jaccard")
    members = rows.select("doc_id", "text_key", "set")
    sets = rows.groupBy("set").agg(F.min(F.struct("n", "text_key", "doc_id", "counts")).alias("x")).select("set", "x.*")
    sets = materialize(sets, "jaccard")  # each set with a text that has it
    # equal sets of texts that repeat shingles unequally have prints of their own
    prints = materialize(rows.select("fp", "set").distinct(), "jaccard")
    leads = materialize(prints.groupBy("fp").agg(F.min("set").alias("lead")), "jaccard")

    def whole(batches):
        for batch in small_parts(batches):
            grams = [shingle_set(t, shingle, seed).view(np.int64) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grams, pa.list_(pa.int64()))], names=["set", "grams"])

    def verify(batches):
        for batch in small_parts(batches, 500):
            x, y = batch.column(2), batch.column(3)
            ok = []
            for i in range(batch.num_rows):
                p, q = x[i].values.to_numpy(), y[i].values.to_numpy()
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(both >= similarity * (len(p) + len(q) - both) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def bounded(batches):
        for batch in small_parts(batches, 10_000):
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, 1 << _COUNTS) for i in (4, 5))
                ok = may_reach(batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy(), x, y, similarity)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    @tidy
    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs of sets that have the similarity."""
        side = lambda k: sets.select(F.col("set").alias(k), F.col("n").alias(f"n_{k}"), F.col("counts").alias(f"c_{k}"))
        pairs = pairs.where("a <> b").distinct().join(side("a"), "a").join(side("b"), "b")
        return verified(materialize(pairs.select("a", "b", "n_a", "n_b", "c_a", "c_b").mapInArrow(bounded, "a long, b long"), "jaccard"))

    @tidy
    def verified(pairs: DataFrame) -> DataFrame:
        """The same, of pairs that the bound leaves."""
        if pairs.isEmpty():
            return pairs
        ids = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
        wanted = sets.join(ids, "set", "left_semi").select(F.col("doc_id").alias("k_doc"), F.col("text_key").alias("k_text"), "set")
        wanted = broadcast_if_small(materialize(wanted, "jaccard"))
        held = slim.join(wanted, F.col("doc_id").eqNullSafe(F.col("k_doc")) & (F.col("text_key") == F.col("k_text"))).select("set", "text")
        full = materialize(held.mapInArrow(whole, "set long, grams array<long>").dropDuplicates(["set"]), "jaccard")
        sides = pairs.join(full.select(F.col("set").alias("a"), F.col("grams").alias("x")), "a").join(full.select(F.col("set").alias("b"), F.col("grams").alias("y")), "b")
        return materialize(sides.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), "jaccard")

    def grouped(links: DataFrame) -> DataFrame:
        return materialize(components(links, "jaccard"), "jaccard")

    # of each print's links the least and the greatest: what they leave apart is completed below
    near = anchor_links(leads, threshold, home_size, anchor_rows, true_links=True)
    near = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.array_distinct(F.array(F.min("b"), F.max("b"))).alias("b"))
    near = near.select("a", F.explode("b").alias("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    a, b = leads.select(F.col("fp").alias("a"), F.col("lead").alias("x")), leads.select(F.col("fp").alias("b"), F.col("lead").alias("y"))
    near = near.join(a, "a").join(b, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
    same = prints.join(leads, "fp").select(F.col("lead").alias("a"), F.col("set").alias("b"))
    links = linked(near.unionByName(same))
    roots = grouped(links)

    def emitting(roots: DataFrame) -> DataFrame:
        """Each text's set with its group; equal rows go where they are sorted."""
        some = rows.select("set", "n", "firsts").join(broadcast_if_small(roots), F.col("set") == F.col("node"), "left")
        return some.select("set", "n", F.coalesce("root", "set").alias("root"), "firsts")

    emitted = emitting(roots).mapInArrow(emit, "gram long, root long, n int, set long, pos int, many boolean").repartition("gram").sortWithinPartitions("gram", "root", *_ITEM[:2])
    between = materialize(emitted.mapInArrow(met(similarity), "gram long, root long, n int, set long, pos int, many boolean, a long"), "jaccard")
    release(docs.sparkSession)
    links = links.unionByName(linked(between.where("a is not null").select("a", F.col("set").alias("b"))))
    new = grouped(links)

    named = between.join(new, between.set == new.node, "left").select("gram", F.coalesce(new.root, between.root).alias("root"), *_ITEM, "many")
    named = materialize(named, "jaccard")
    open_ = named.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_or("many").alias("many")).where("low <> high").select("gram", "many")
    open_ = materialize(open_, "jaccard")
    drop(between)
    if not open_.isEmpty():
        again = named.join(open_.where("not many"), "gram", "left_semi").select("gram", "root", *_ITEM)
        hot = materialize(open_.where("many").select("gram"), "jaccard")
        if not hot.isEmpty():
            more = emitting(new).select("set", "n", "root", F.posexplode("firsts").alias("pos", "gram"))
            again = again.unionByName(more.join(broadcast_if_small(hot), "gram", "left_semi").select("gram", "root", *_ITEM).distinct())
        again = materialize(again, "jaccard")
        drop(named)
        counts = again.groupBy("gram", "root").agg(F.count("*").alias("c"))
        counts = counts.groupBy("gram").agg(F.max(F.struct("c", "root")).alias("most"), F.ceil(F.sum("c") / _HELD).cast("int").alias("nb"))
        marked = again.join(counts, "gram").select("gram", "root", *_ITEM, (F.col("root") == F.col("most.root")).alias("main"), "nb")
        dealt = marked.select("gram", "root", *_ITEM, "main", F.explode(cells()).alias("cell")).select("gram", "cell.*", "root", *_ITEM, "main")
        kinds = "gram long, h int, v int, role int, root long, n int, set long, pos int, main boolean"
        sort = lambda df: df.repartition("gram", "h", "v").sortWithinPartitions("gram", "h", "v")
        able = materialize(sort(dealt).mapInArrow(partnered(similarity), kinds), "jaccard")
        drop(again)
        able = able.join(sets.select("set", "counts"), "set").select("gram", "h", "v", "role", "root", *_ITEM, "main", "counts")
        pairs = sort(able).mapInArrow(bounded_pairs(similarity), "a long, b long")
        links = links.unionByName(verified(materialize(pairs.distinct(), "jaccard")))
        new = components(links, "jaccard")
    return members.join(new, members.set == new.node, "left").select("doc_id", "text_key", F.coalesce("root", "set").alias("root"))
