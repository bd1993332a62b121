"""Operator 10: token ids in flat files of unsigned integers with 64-bit document offsets.

Rows are range-partitioned by doc_id and sorted, each task writes one shard (``.bin`` ids, ``.idx`` uint64 offsets,
``.doc`` int64 doc ids), and a shard's base is the prefix sum of the token counts before it. A shard is written under an
attempt's own name and then renamed, so a retried task replaces it whole. Files are read back by memory map. Ids are
uint16 where the vocabulary and the end token fit in 16 bits, else uint32.

Nulls: a null text is an empty one (its end token alone); a null doc_id sorts first and is stored as the least int64.
Repeated doc_ids are stored as often as they occur, in the order of their texts' hash. An empty table gives an empty
manifest. Other columns are not read. ``folder`` must be a mounted path that all executors share.
"""

from __future__ import annotations

import json
import os
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_parts
from .tokens import default_tokenizer, encoder

NULL_ID = -(2**63)
MANIFEST = "shard long, docs long, tokens long"


def write_token_files(docs: DataFrame, folder: str, end_id: int = 1, tokenizer: str | None = None) -> list[dict]:
    """Writes the shards and ``manifest.json``; returns the manifest: shard, docs, tokens and base of each."""
    path = tokenizer or default_tokenizer()
    dtype = "<u2" if max(encoder(path).tokenizer.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = slim.withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def run(batches):
        task = TaskContext.get()
        shard, attempt = (task.partitionId(), task.taskAttemptId()) if task else (0, 0)
        encode, end = encoder(path).encode, end_id.to_bytes(4, "little")
        stem = os.path.join(folder, f"shard-{shard:06d}")
        offsets, ids = [0], []
        with open(f"{stem}.bin.{attempt}", "wb") as out:
            for batch in small_parts(batches):
                ids += [NULL_ID if x is None else x for x in batch.column(0).to_pylist()]
                data = [encode(text) + end for text in batch.column(1).cast(pa.binary()).to_pylist()]
                offsets += accumulate((len(x) // 4 for x in data[1:]), initial=offsets[-1] + len(data[0]) // 4)
                out.write(np.frombuffer(b"".join(data), "<u4").astype(dtype))
        np.array(offsets, "<u8").tofile(f"{stem}.idx.{attempt}")
        np.array(ids, "<i8").tofile(f"{stem}.doc.{attempt}")
        for kind in ("bin", "idx", "doc"):
            os.replace(f"{stem}.{kind}.{attempt}", f"{stem}.{kind}")
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (shard, len(ids), offsets[-1])], names=["shard", "docs", "tokens"])

    rows = sorted(ordered.mapInArrow(run, MANIFEST).collect())  # one row per shard
    bases = [0, *accumulate(r.tokens for r in rows)]
    manifest = [{**r.asDict(), "base": b} for r, b in zip(rows, bases, strict=False)]
    with open(os.path.join(folder, "manifest.json"), "w") as f:
        json.dump({"dtype": dtype, "end_id": end_id, "shards": manifest}, f)
    return manifest


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per stored document: doc_id, start (tokens before it in the whole set), n_tokens, ids_crc32 and ids."""
    with open(os.path.join(folder, "manifest.json")) as f:
        manifest = json.load(f)
    dtype, shards = manifest["dtype"], [(s["shard"], s["base"]) for s in manifest["shards"] if s["docs"]]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches):
        for batch in batches:
            for shard, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                stem = os.path.join(folder, f"shard-{shard:06d}")
                offsets, docs = np.memmap(f"{stem}.idx", "<u8", "r").astype(np.int64), np.memmap(f"{stem}.doc", "<i8", "r")
                ids = np.asarray(np.memmap(f"{stem}.bin", dtype, "r"))
                step = 500 if with_ids else 2_000
                for i in range(0, len(docs), step):
                    j = min(i + step, len(docs))
                    block = memoryview(ids[offsets[i] : offsets[j]].astype("<u4"))
                    edges = (offsets[i : j + 1] - offsets[i]).tolist()
                    parts = [block[a:b] for a, b in zip(edges, edges[1:], strict=False)]
                    columns = [pa.array([None if x == NULL_ID else x for x in docs[i:j].tolist()], pa.int64()), pa.array(offsets[i:j] + base), pa.array(np.diff(offsets[i : j + 1])), pa.array(map(crc32, parts), pa.int64())]
                    columns += [pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))] * with_ids
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    todo = spark.createDataFrame(shards, "shard long, base long")
    return todo.repartition(max(1, len(shards))).mapInArrow(run, schema)
