"""Operator 6: packing of documents into fixed windows, best fit decreasing.

Each task tokenizes its own rows, cuts documents over a window into full windows, and packs what remains, longest first,
into the open window with the least room that still holds it; a segment tree indexed by remaining capacity finds it. No
row is shuffled. What stays open at the end of a batch is topped up from the emptiest windows, and the last one is cut
into powers of two, which need no padding.

Nulls: a null text is an empty one (one end token); a null doc_id is carried along. Repeated rows are packed as often as
they occur. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from zlib import crc32

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_parts
from .tokens import default_tokenizer, encoder

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class CapacityTree:
    """Segment tree over capacities 0..size: which remaining capacities have an open window."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1 - 1).bit_length() if size & (size - 1) or size == 0 else size * 2
        self.any = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        node = room + self.leaves
        while node:
            self.any[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (room, window) with the least room >= need."""
        node = need + self.leaves
        if not self.any[node]:
            while node > 1 and (node & 1 or not self.any[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.any[node]
        room = node - self.leaves
        window = self.windows[room].pop()
        while node:
            self.any[node] -= 1
            node >>= 1
        return room, window


def best_fit_decreasing(lengths: list[int], size: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (item, first, length); every length must be in 1..size."""
    tree, windows = CapacityTree(size), []
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[item]
        found = tree.take(need)
        if found is None:
            room, window = size, len(windows)
            windows.append([])
        else:
            room, window = found
        windows[window].append((item, 0, need))
        if room > need:
            tree.add(room - need, window)
    return windows


def top_up(windows: list[list[tuple[int, int, int]]], size: int) -> list[list[tuple[int, int, int]]]:
    """Fills open windows from the emptiest ones by cutting pieces; the last is cut into powers of two."""
    used = [sum(p[2] for p in w) for w in windows]
    out = [w for w, n in zip(windows, used, strict=True) if n == size]
    rest = sorted(((n, w) for w, n in zip(windows, used, strict=True) if n < size), key=lambda x: -x[0])
    low, high = 0, len(rest) - 1
    while low < high:
        n, w = rest[low]
        while n < size and low < high:
            m, donor = rest[high]
            item, first, length = donor.pop()
            take = min(size - n, length)
            w.append((item, first + length - take, take))
            if take < length:
                donor.append((item, first, length - take))
            n, m = n + take, m - take
            rest[high] = (m, donor)
            high -= not m
        rest[low] = (n, w)
        if n == size:
            out.append(w)
            low += 1
    for n, w in rest[low : high + 1]:
        while n:
            part, want = [], 1 << (n.bit_length() - 1)
            n -= want
            while want:
                item, first, length = w.pop()
                take = min(want, length)
                part.append((item, first, take))
                if take < length:
                    w.append((item, first + take, length - take))
                want -= take
            out.append(part)
    return out


def pack_documents(docs: DataFrame, window: int = 4096, end_id: int = 2, tokenizer: str | None = None, batch_tokens: int = 4_000_000, with_ids: bool = False, cache_words: int = 300_000) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in which sequence, and its CRC-32.

    with_ids adds ``ids array<int>``, the piece's tokens. batch_tokens bounds a task's memory: so many tokens of
    remainders are packed together. cache_words bounds the words whose encodings a Python worker keeps.
    """
    path = tokenizer or default_tokenizer()

    def run(batches):
        task = TaskContext.get()
        base, made = (task.partitionId() if task else 0) << 40, 0
        encode, end = encoder(path, cache_words).encode, end_id.to_bytes(4, "little")
        rows: list[tuple] = []
        pending: list[tuple] = []
        waiting = 0

        def piece(doc, start, ids, total, sequence, offset):
            rows.append((doc, start, len(ids) // 4, crc32(ids), total, base + sequence, offset) + ((memoryview(ids).cast("I").tolist(),) if with_ids else ()))

        def flush():
            nonlocal made, waiting
            for w in top_up(best_fit_decreasing([len(p[2]) // 4 for p in pending], window), window):
                offset = 0
                for item, first, length in w:
                    doc, start, ids, total = pending[item]
                    piece(doc, start + first, ids[4 * first : 4 * (first + length)], total, made, offset)
                    offset += length
                made += 1
            pending.clear()
            waiting = 0

        def out():
            columns = list(zip(*rows, strict=True)) if rows else [()] * (7 + with_ids)
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
            rows.clear()
            return batch

        for batch in small_parts(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                ids = encode(text) + end
                total = len(ids) // 4
                whole = total // window
                for i in range(whole):
                    piece(doc, i * window, ids[4 * i * window : 4 * (i + 1) * window], total, made, 0)
                    made += 1
                if total % window:
                    pending.append((doc, whole * window, ids[4 * whole * window :], total))
                    waiting += total % window
                    if waiting >= batch_tokens:
                        flush()
                if len(rows) >= (200 if with_ids else 20_000):
                    yield out()
        flush()
        yield out()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(run, SCHEMA + (", ids array<int>" if with_ids else ""))
