"""Totals over a global order, without moving all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .lineage_cut import checkpointed


def running_total(df: DataFrame, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over all rows before this one in the order, which must be unique.

    Rows are range-partitioned and checkpointed; partition totals (one row per partition) give each partition its start,
    and a window within partitions does the rest.
    """
    ranged = checkpointed(df.withColumn("__v", value).repartitionByRange(*order).withColumn("__p", F.spark_partition_id()))
    starts = ranged.groupBy("__p").agg(F.sum("__v").alias("__t"))
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    starts = starts.select("__p", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__s"))
    inner = W.partitionBy("__p").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(starts), "__p")  # as many rows as partitions
    return out.withColumn(name, F.col("__s") + F.coalesce(F.sum("__v").over(inner), F.lit(0))).drop("__p", "__v", "__s")


def seeded(seed: int, *keys: str) -> Column:
    """A pseudo-random order key that any engine can reproduce."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def shuffled_rank(df: DataFrame, seed: int, key: str, name: str = "rank") -> DataFrame:
    """Adds the 0-based position in the seeded order."""
    keyed = df.withColumn("__h", seeded(seed, key))
    return running_total(keyed, ["__h", key], F.lit(1), name).drop("__h")


def rank_within(df: DataFrame, group: list[str], order: list[str], name: str = "rank", size: str = "size") -> DataFrame:
    """Adds the 0-based place within the group and the group's size. A hot group is ranked over many tasks: its rows lie in
    one stretch of the global order, from which its start is taken off."""
    total = running_total(df, [*group, *order], F.lit(1), "__g")
    starts = total.groupBy(*group).agg(F.min("__g").alias("__s"), F.count("*").alias(size))
    keys = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    on = keys[0]
    for k in keys[1:]:
        on = on & k
    joined = total.alias("l").join(starts.alias("r"), on)
    return joined.select("l.*", (F.col("__g") - F.col("__s")).alias(name), f"r.{size}").drop("__g")
