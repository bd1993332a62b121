"""Episode shards: which shard each whole episode goes to, and the files of the shards.

A shard folder holds tokens.bin (uint32), mask.bin (one byte a token, 1 where the weight is above 0), episodes.idx (pairs
of uint64: start and length within the shard). Like the packers, ``parts`` streams are filled by themselves, so the layout
depends on ``parts`` and not on the cluster.
"""

from __future__ import annotations

import os
import shutil
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage_cut import checkpointed
from .packing import _streams


def shard_plan(episodes: DataFrame, per_shard: int, parts: int = 64) -> DataFrame:
    """(shard, id, start, tokens) of episodes (id, tokens: a count). An episode that no longer fits opens a new shard; one over
    ``per_shard`` has a shard of its own; none is split. A null or negative count is 0. Shards are numbered over all parts."""

    def run(batches):
        part, shard, used, held = None, 0, 0, 0
        for batch in batches:
            rows = []
            for p, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    part, shard, used, held = p, 0, 0, 0
                if held and used + n > per_shard:
                    shard, used, held = shard + 1, 0, 0
                rows.append((p, shard, key, used, n))
                used, held = used + n, held + 1
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "block", "id", "start", "tokens"])

    sized = episodes.select("id", F.greatest(F.coalesce(F.col("tokens"), F.lit(0)), F.lit(0)).alias("tokens"))
    placed = checkpointed(_streams(sized, parts).mapInArrow(run, "part long, block long, id long, start long, tokens long"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each part
    firsts = placed.groupBy("part").agg((F.max("block") + 1).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.join(F.broadcast(firsts), "part").select((F.col("first") + F.col("block")).alias("shard"), "id", "start", "tokens")


def write_episode_shards(episodes: DataFrame, path: str, per_shard: int, parts: int = 64) -> DataFrame:
    """Writes episodes (id, unique and not null; tokens, mask: arrays of one length) below ``path``, a new folder that all executors share,
    as shard_00000 and so on; returns the manifest (shard, episodes, tokens).

    Rows are appended as they come, so a task holds one batch. Each attempt writes a folder of its own and renames it
    when the shard is whole, so that a lost executor leaves no half shard; the manifest is computed once, by this call.
    """
    url = urlparse(path)
    if url.scheme not in ("", "file"):
        raise ValueError(f"shard files need a mounted folder, not {url.scheme}://")
    root = unquote(url.path)
    os.makedirs(root)
    plan = shard_plan(episodes.select("id", F.size("tokens").alias("tokens")), per_shard, parts)
    whole = plan.select("shard", "id", "start").join(episodes.select("id", "tokens", "mask"), "id").select("shard", "start", "tokens", "mask", "id")

    def write(batches):
        shard, files, folder, n, total, done = None, [], "", 0, 0, []

        def close():
            if shard is not None:
                for f in files:
                    f.close()
                target = os.path.join(root, f"shard_{shard:05d}")
                try:
                    os.rename(folder, target)
                except OSError:  # another attempt has written the same shard
                    shutil.rmtree(folder)
                    if not os.path.isdir(target):
                        raise
                done.append((shard, n, total))

        for batch in batches:
            for s, start, tokens, mask in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if s != shard:
                    close()
                    folder = os.path.join(root, f".{uuid.uuid4().hex}")
                    os.mkdir(folder)
                    shard, n, total = s, 0, 0
                    files = [open(os.path.join(folder, name), "wb") for name in ("tokens.bin", "mask.bin", "episodes.idx")]
                ids = np.array(tokens.as_py() or [], "<u4")
                weights = np.array(mask.as_py() or [], float)
                if len(weights) != len(ids):
                    raise ValueError(f"{len(ids)} tokens and {len(weights)} mask values")
                for f, x in zip(files, (ids, (weights > 0).astype(np.uint8), np.array([start, len(ids)], "<u8")), strict=True):
                    f.write(x.tobytes())
                n, total = n + 1, total + len(ids)
        close()
        columns = list(zip(*done, strict=True)) if done else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["shard", "episodes", "tokens"])

    dealt = whole.repartition("shard").sortWithinPartitions("shard", "id")  # empty episodes share a start
    return checkpointed(dealt.mapInArrow(write, "shard long, episodes long, tokens long"))
