"""Packing of whole episodes into blocks, and what belongs to it: windows, positions, masks.

Sequential packers keep an order, so each packs ``parts`` streams by itself: rows go to the part of their id modulo
``parts``, each part is packed in order of id, and blocks are numbered within it. The result depends on ``parts`` alone, not
on the cluster; one part is the plain sequential packing. A task holds its open blocks only.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "part long, block long, id long, segment long, offset long, tokens long"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def _streams(rows: DataFrame, parts: int) -> DataFrame:
    """(part, id, tokens), each part's rows together and in order of id."""
    slim = rows.select(F.pmod(F.col("id"), F.lit(parts)).cast("long").alias("part"), "id", F.col("tokens").cast("long").alias("tokens"))
    return slim.repartition("part").sortWithinPartitions("part", "id")


def next_fit(episodes: DataFrame, size: int, segments: int = 255, parts: int = 64) -> DataFrame:
    """Episodes (id, tokens) in order of id; one that no longer fits, or a full count of segments, opens a new block.
    An episode over the block keeps ``size`` tokens."""

    def run(batches):
        part, block, used, segment = None, 0, 0, 0
        for batch in batches:
            rows = []
            for p, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    part, block, used, segment = p, 0, 0, 0
                n = min(n, size)
                if used + n > size or segment >= segments:
                    block, used, segment = block + (segment > 0), 0, 0
                segment += 1
                rows.append((part, block, key, segment, used, n))
                used += n
            yield _batch(rows)

    return _streams(episodes, parts).mapInArrow(run, SCHEMA)


def best_fit(episodes: DataFrame, size: int, segments: int = 255, open_blocks: int = 256, parts: int = 64) -> DataFrame:
    """Episodes in order of id, each into the open block it leaves least room in; past ``open_blocks`` the fullest closes."""

    def run(batches):
        part, made = None, 0
        blocks: dict[int, list[int]] = {}
        for batch in batches:
            rows = []
            for p, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    part, made = p, 0
                    blocks.clear()
                n = min(n, size)
                if not n:
                    continue
                fits = [(size - used - n, b) for b, (used, _) in blocks.items() if used + n <= size]
                block = min(fits)[1] if fits else made
                if not fits:
                    blocks[made] = [0, 0]
                    made += 1
                state = blocks[block]
                rows.append((part, block, key, state[1] + 1, state[0], n))
                state[0], state[1] = state[0] + n, state[1] + 1
                if state[0] >= size or state[1] >= segments:
                    del blocks[block]
                elif len(blocks) > open_blocks:
                    del blocks[max(blocks, key=lambda b: blocks[b][0])]
            yield _batch(rows)

    return _streams(episodes, parts).mapInArrow(run, SCHEMA)


def packing_stats(packed: DataFrame, size: int) -> DataFrame:
    """Blocks, fill and gain of a packing."""
    blocks = packed.groupBy("part", "block").agg(F.sum("tokens").alias("n"), F.count("*").alias("episodes"))
    return blocks.agg(
        F.count("*").alias("blocks"), F.sum("episodes").alias("episodes"), F.sum("n").alias("tokens"), F.min("episodes").alias("least"), F.max("episodes").alias("most"),
        F.round(F.sum("n") / (F.count("*") * size), 6).alias("fill"), F.round(F.sum("episodes") / F.count("*"), 6).alias("gain"),
    )


def xy_windows(ids: Column, block: int, pad: int) -> Column:
    """Struct of x and y, shifted by one, padded, the end kept where an episode is too long."""
    kept = F.when(F.size(ids) > block + 1, F.slice(ids, -(block + 1), block + 1)).otherwise(ids)
    full = F.concat(kept, F.array_repeat(F.lit(pad), F.greatest(F.lit(block + 1) - F.size(ids), F.lit(0))))
    return F.transform(F.array(full), lambda s: F.struct(F.slice(s, 1, block).alias("x"), F.slice(s, 2, block).alias("y")))[0]


def mega_episodes(documents: DataFrame, size: int, least: int = 65, fill: float = 0.75, parts: int = 64) -> DataFrame:
    """Short documents in order (id, tokens) joined until the next no longer fits; kept if filled to ``fill``. Documents
    under ``least`` tokens are dropped, those of a whole block or more are cut to one and stand alone."""

    def run(batches):
        part, block, held, used = None, 0, [], 0

        def close():
            nonlocal block, used
            rows = []
            if used >= int(size * fill):
                at = 0
                for i, (key, n) in enumerate(held):
                    rows.append((part, block, key, i + 1, at, n))
                    at += n
                block += 1
            held.clear()
            used = 0
            return rows

        for batch in batches:
            rows = []
            for p, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    rows += close()
                    part, block = p, 0
                if n < least:
                    continue
                if n >= size or used + n > size:
                    rows += close()
                if n >= size:
                    rows.append((part, block, key, 1, 0, size))
                    block += 1
                else:
                    held.append((key, n))
                    used += n
            yield _batch(rows)
        yield _batch(close())

    return _streams(documents, parts).mapInArrow(run, SCHEMA)
