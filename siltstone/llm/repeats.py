"""Finding repeated fixed-length windows of a corpus: shared by operators 5 and 7.

A text is a sequence of symbols (words or bytes). Every window of ``window`` symbols has an anchor: the ``gram`` of it
with the least rolling hash, so equal windows have equal anchors at the same place in them. Anchors that occur once in
the corpus rule out all their windows; this leaves few. Windows with the same anchor follow each other, and the stretch
that they cover is a piece. Pieces are sorted by anchor, equal ones counted before they are shuffled, and each anchor is
solved by the operator's own method, which returns the windows that are NOT repeated. An anchor with over ``group_rows``
different pieces is not gathered; its windows are counted one by one by their hash.

Scans never keep more than a batch; whatever a text needs to know of the corpus is joined to it by doc_id.
"""

from __future__ import annotations

import gc
from dataclasses import dataclass
from typing import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, materialize, small_parts, tidy

#: A null doc_id in these steps: after all others.
LAST = (1 << 63) - 1
_P = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_PLACE = 24
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n of each."""
    size = max(1 << 16, 1 << (n - 1).bit_length())
    if size not in _POWERS:
        def series(base: int) -> np.ndarray:
            out = np.full(size, base, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        _POWERS.clear()
        _POWERS[size] = series(_P), series(pow(_P, -1, 1 << 64))
    return _POWERS[size]


def rolling(symbols: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` symbols (uint64 each), mixed."""
    n = len(symbols)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((symbols + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[length:] - sums[:-length]) * down[: n - length + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, in a few passes whatever the width."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.uint64(_MASK))
    padded[:n] = x
    cells = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(cells, axis=1).ravel()
    behind = np.minimum.accumulate(cells[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(symbols: np.ndarray, window: int, gram: int, step: int = 1 << 22) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, one past the last window, anchor hash as int64) of every run of windows with one anchor."""
    first, last, keys = [], [], []
    for at in range(0, max(0, len(symbols) - window + 1), step):
        h = rolling(symbols[at : at + step + window - 1], gram)
        order = (h & np.uint64(_MASK ^ ((1 << _PLACE) - 1))) | np.arange(len(h), dtype=np.uint64)
        place = (sliding_min(order, window - gram + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(place)) + 1
        starts = np.concatenate([[0], cut])
        first.append(starts + at)
        last.append(np.concatenate([cut, [len(place)]]) + at)
        keys.append(h[place[starts]].view(np.int64))
    empty = np.empty(0, np.int64)
    return tuple(np.concatenate(x) if x else empty for x in (first, last, keys))


@dataclass
class Kind:
    """What differs between the operators."""

    window: int
    gram: int
    #: text bytes -> (symbols as uint64, slice(first, end) -> bytes of those symbols)
    read: Callable[[bytes], tuple[np.ndarray, Callable[[int, int], bytes]]]
    #: windows of a piece's bytes, each as bytes
    windows: Callable[[bytes], list[bytes]]
    #: [(piece, doc, count)] of one anchor -> [(doc, piece, first, end)]: ranges of windows that are not repeated
    solve: Callable[[list[tuple[bytes, int, int]]], list[tuple[int, bytes, int, int]]]
    #: keys count as shared if they come from two documents, not merely from two places
    by_document: bool


def digest(piece: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(piece)
    return h - (1 << 64) if h >> 63 else h


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.col("text").cast("string").alias("txt"))


def unrepeated(docs: DataFrame, kind: Kind, tag: str, group_rows: int = 20_000) -> DataFrame:
    """For each doc: ``keys``, the anchors whose windows may be repeated, and ``keep``, the (digest, first, end) of pieces
    and their windows that are not. Documents without a shared anchor have no row."""
    spark = docs.sparkSession

    def scan(batches):
        for batch in small_parts(batches):
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                k = runs(kind.read(text or b"")[0], kind.window, kind.gram)[2]
                k = np.unique(k) if kind.by_document else k
                ids.append(np.full(len(k), doc, np.int64))
                keys.append(k)
            if keys:
                k, d = np.concatenate(keys), np.concatenate(ids)
                _, lead, at, counts = np.unique(k, return_index=True, return_inverse=True, return_counts=True)
                known = counts[at] > 1  # shared within the batch: one row tells the other batches, and no key is hot
                one = ~known
                one[lead] = True
                k, d = np.concatenate([k[known], k[one]]), np.concatenate([d[known], d[one]])
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(d), pa.array(np.arange(len(k)) < known.sum())], names=["key", "doc", "known"])

    def shared(batches):
        """Rows sorted by key and doc: those whose key occurs again (by_document: in another document), and the known."""
        key = doc = held = None
        many = False
        for batch in batches:
            known = batch.column(2).to_numpy(zero_copy_only=False)
            if known.any():
                yield pa.RecordBatch.from_arrays([pa.array(c.to_numpy()[known]) for c in batch.columns[:2]], names=["key", "doc"])
            if known.all():
                continue
            batch = batch.filter(pa.array(~known))
            keys, docs_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.concatenate([[True], (keys[1:] != keys[:-1])])
            step = new | np.concatenate([[True], docs_[1:] != docs_[:-1]])
            new[0] = key is None or keys[0] != key
            step[0] = new[0] or docs_[0] != doc
            again = ~new & step if kind.by_document else ~new
            group = np.cumsum(new)
            hot = np.zeros(group[-1] + 1, bool)
            hot[group[again]] = True
            if not new[0]:
                hot[0] |= many
            if held is not None and not new[0] and hot[0]:
                yield _batch([held], ["key", "doc"], [pa.int64()] * 2)
                held = None
            keep = hot[group] & step
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(docs_[keep])], names=["key", "doc"])
            end = group[-1]
            many = bool(hot[end])
            if not many and (end or new[0]):
                held = (int(keys[-1]), int(docs_[group == end][0]))
            elif many:
                held = None
            key, doc = keys[-1], docs_[-1]

    texts = slim(docs)
    anchors = texts.mapInArrow(scan, "key long, doc long, known boolean")
    anchors = anchors.repartition(F.when(F.col("known"), F.xxhash64("doc", "key")).otherwise(F.col("key"))).sortWithinPartitions("known", "key", "doc")
    found = anchors.mapInArrow(shared, "key long, doc long").groupBy("doc").agg(F.collect_set("key").alias("keys"))
    found = materialize(found, tag)
    release(spark)

    def cut(batches):
        for batch in small_parts(batches):
            counts: dict[tuple[int, bytes], list[int]] = {}
            size = 0
            for doc, text, keys in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), strict=True):
                symbols, part = kind.read(text or b"")
                first, last, k = runs(symbols, kind.window, kind.gram)
                at = np.flatnonzero(np.isin(k, keys.values.to_numpy()))
                for key, a, b in zip(k[at].tolist(), first[at].tolist(), last[at].tolist(), strict=True):
                    piece = part(a, b + kind.window - 1)
                    seen = counts.get((key, piece))
                    if seen is None:
                        counts[key, piece] = [doc, 1]
                        size += len(piece)
                    else:
                        seen[0], seen[1] = min(seen[0], doc), seen[1] + 1
                if size > 4_000_000:
                    yield _batch([(*k, *v) for k, v in counts.items()], ["key", "piece", "doc", "n"], [pa.int64(), pa.binary(), pa.int64(), pa.int64()])
                    counts, size = {}, 0
            yield _batch([(*k, *v) for k, v in counts.items()], ["key", "piece", "doc", "n"], [pa.int64(), pa.binary(), pa.int64(), pa.int64()])

    def solve(batches):
        """Rows sorted by key and piece. Holds the different pieces of one key, ``group_rows`` at most."""
        names, kinds = ["hot", "doc", "piece", "first", "end"], [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        key, hot, rows = None, False, []
        group: dict[bytes, list[int]] = {}

        def close():
            if hot:
                rows.extend((True, doc, digest(w), n, 0) for piece, (doc, n) in group.items() for w in kind.windows(piece))
            elif group:
                rows.extend((False, doc, digest(p), a, b) for doc, p, a, b in kind.solve([(p, d, n) for p, (d, n) in group.items()]))
            group.clear()

        for batch in batches:
            for k, piece, doc, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    close()
                    key, hot = k, False
                seen = group.get(piece)
                if seen is None:
                    group[piece] = [doc, n]
                    if len(group) > (100 if hot else group_rows):
                        hot = True
                        close()
                else:
                    seen[0], seen[1] = min(seen[0], doc), seen[1] + n
            if len(rows) > 20_000:
                yield _batch(rows, names, kinds)
                rows.clear()
        close()
        yield _batch(rows, names, kinds)

    pieces = texts.join(found, "doc").select("doc", "txt", "keys").mapInArrow(cut, "key long, piece binary, doc long, n long")
    grouped = pieces.repartition("key").sortWithinPartitions("key", "piece")
    solved = materialize(grouped.mapInArrow(solve, "hot boolean, doc long, piece long, first long, end long"), tag)
    release(spark)
    # the windows of anchors with too many contexts, counted one by one; an equal window has the same anchor
    single = solved.where("hot").groupBy("piece").agg(F.min("doc").alias("doc"), F.sum("first").alias("n"))
    single = (single if kind.by_document else single.where("n = 1")).select("doc", "piece", F.lit(0).alias("first"), F.lit(1).alias("end"))
    left = solved.where("not hot").select("doc", "piece", "first", "end").unionByName(single)
    keep = left.groupBy("doc").agg(F.collect_list(F.struct("piece", "first", "end")).alias("keep"))
    known = materialize(found.join(keep, "doc", "left"), tag)
    for df in (found, solved):
        drop(df)
    release(spark)
    return known


def repeated(symbols: np.ndarray, part: Callable[[int, int], bytes], keys: np.ndarray, keep: dict[int, list[tuple[int, int]]], kind: Kind) -> np.ndarray:
    """Mask of the symbols covered by repeated windows of one text."""
    n = len(symbols)
    starts = np.zeros(max(0, n - kind.window + 1), bool)
    first, last, k = runs(symbols, kind.window, kind.gram)
    for i in np.flatnonzero(np.isin(k, keys)).tolist():
        a, b = int(first[i]), int(last[i])
        starts[a:b] = True
        if keep:
            piece = part(a, b + kind.window - 1)
            ranges = keep.get(digest(piece))
            if ranges is None:
                # a piece of one window, repeated itself, is in ``keep`` with an empty range: it keeps no window here
                ranges = [(j, j + 1) for j, w in enumerate(kind.windows(piece)) if (0, 1) in keep.get(digest(w), ())]
            for x, y in ranges:
                starts[a + x : a + y] = False
    edges = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + kind.window, -1)
    return np.cumsum(edges[:n]) > 0


@tidy
def apply(docs: DataFrame, kind: Kind, schema: str, judge: Callable[[int | None, bytes, np.ndarray, Callable], tuple], tag: str, group_rows: int = 20_000) -> DataFrame:
    """Runs ``judge(doc_id, text, mask of repeated symbols, part)`` on every row; it returns a row of ``schema``."""
    known = unrepeated(docs, kind, tag, group_rows)
    joined = slim(docs).join(known, "doc", "left").select("doc", "txt", "keys", "keep")

    def run(batches):
        for batch in small_parts(batches):
            rows = []
            for doc, text, keys, keep in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2), batch.column(3).to_pylist(), strict=True):
                text = text or b""
                symbols, part = kind.read(text)
                ranges: dict[int, list[tuple[int, int]]] = {}
                for x in keep or ():
                    ranges.setdefault(x["piece"], []).append((x["first"], x["end"]))
                mask = repeated(symbols, part, keys.values.to_numpy(), ranges, kind) if keys.is_valid else np.zeros(len(symbols), bool)
                rows.append(judge(None if doc == LAST else doc, text, mask, part))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=fields)

    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<struct<first:long,end:long>>": pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))}
    fields = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])
    return joined.mapInArrow(run, schema)
