"""Writers. Shards follow a global order by prefix sums over range partitions, so nothing is gathered to number them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_total


def with_shard(docs: DataFrame, order: str, size: Column, per_shard: int) -> DataFrame:
    """Adds ``shard``: which stretch of ``per_shard`` a row starts in. A row is never split, so shards may run over."""
    total = running_total(docs.withColumn("__n", size.cast("long")), [order], F.col("__n"), "__b")
    return total.withColumn("shard", F.floor(F.col("__b") / per_shard)).drop("__b", "__n")


def text_shards(docs: DataFrame, path: str, order: str = "doc_id", per_shard: int = 100_000_000) -> DataFrame:
    """Documents between marks in text files, one folder per shard; returns the manifest (source, path, sha256, bytes)."""
    body = F.concat(F.lit("==== DOC START ====\nSOURCE: "), "source", F.lit(" | PATH: "), F.col(order).cast("string"), F.lit("\n====\n"), "text", F.lit("\n==== DOC END ====\n"))
    shards = with_shard(docs.withColumn("__t", body), order, F.octet_length("__t"), per_shard)
    shards.repartition("shard").sortWithinPartitions("shard", order).select("shard", F.col("__t").alias("value")).write.partitionBy("shard").text(path)
    return docs.select("source", F.col(order).cast("string").alias("path"), F.sha2("text", 256).alias("sha256"), F.octet_length("text").alias("bytes"))


def token_shards(tokens: DataFrame, path: str, order: str, per_shard: int, first: int = 0) -> None:
    """Parquet of (shard, place, token), cut at exactly ``per_shard`` tokens over the whole order; ``first`` continues a set."""
    n = F.size("tokens")
    placed = running_total(tokens.withColumn("__n", n.cast("long")), [order], F.col("__n"), "__b")
    flat = placed.select((F.col("__b")).alias("b"), F.posexplode("tokens").alias("i", "token"))
    at = F.col("b") + F.col("i")
    flat.select((F.floor(at / per_shard) + first).alias("shard"), (at % per_shard).alias("place"), "token").write.mode("append").partitionBy("shard").parquet(path)


def next_shard(existing: DataFrame) -> int:
    """The number after the last shard of a set."""
    last = existing.agg(F.max("shard")).first()[0]
    return 0 if last is None else last + 1


def split_shards(shards: DataFrame, share: float) -> DataFrame:
    """train or val for each shard number: the last ones are val, one shard at least is train."""
    n = shards.select("shard").distinct().count()
    vals = min(max(1, round(n * share)), n - 1)
    last = shards.agg(F.max("shard")).first()[0]
    return shards.withColumn("split", F.when(F.col("shard") > F.lit(last) - vals, "val").otherwise("train"))


def jsonl(df: DataFrame, path: str) -> None:
    df.write.json(path)


def tsv_pairs(pairs: DataFrame, path: str, left: str, right: str) -> None:
    """Two columns as tab-separated text; tabs and breaks inside become blanks."""
    flat = lambda c: F.regexp_replace(c, r"[\t\n\r]+", " ")
    pairs.select(F.concat_ws("\t", flat(left), flat(right)).alias("value")).write.text(path)


def index(chunks: DataFrame, path: str, options: dict) -> None:
    """Chunks with their embeddings as one table, and its options beside it."""
    chunks.write.parquet(f"{path}/chunks")
    sidecar(chunks, f"{path}/config", options)


def sidecar(df: DataFrame, path: str, content: dict) -> None:
    """A small JSON document in a folder of its own, written through Spark so that any store will do."""
    df.sparkSession.createDataFrame([(json.dumps(content, sort_keys=True, ensure_ascii=False),)], "value string").coalesce(1).write.text(path)


def audit(lines: DataFrame, path: str) -> None:
    """Audit lines by category and day."""
    lines.write.mode("append").partitionBy("category", "date").text(path)
