"""Sampling, mixing and budgets. Randomness is an order by a seeded hash, so any engine reproduces it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import rank_within, running_total, seeded, shuffled_rank


def normalized_weights(sources: DataFrame, weight: str = "weight") -> DataFrame:
    """Weights over their sum; a missing weight is 1. ``sources`` is a table of sources, not of rows."""
    return sources.withColumn(weight, F.coalesce(weight, F.lit(1.0)) / F.sum(F.coalesce(weight, F.lit(1.0))).over(W.partitionBy(F.lit(1))))


def target_tokens(counts: DataFrame, total: int, repeat: bool = False) -> DataFrame:
    """Tokens to take from each source (name, tokens, weight normalised) and how often to repeat it.

    Clipped by what is there, unless sources may be repeated; if more than the total remains, scaled down, the last
    source (by name) taking the rest.
    """
    ideal = F.bround(F.col("weight") * total, 0).cast("long")
    if repeat:
        times = F.when(F.col("tokens") <= 0, 0).when(F.col("tokens") >= ideal, 1).otherwise(F.ceil(ideal / F.col("tokens"))).cast("long")
        return counts.select("name", "tokens", F.when(F.col("tokens") <= 0, 0).otherwise(ideal).cast("long").alias("target"), times.alias("repeats"))
    one = W.partitionBy(F.lit(1))
    clipped = counts.select("name", "tokens", F.least("tokens", ideal).alias("clipped"))
    clipped = clipped.withColumn("all", F.sum("clipped").over(one)).withColumn("last", F.max("name").over(one) == F.col("name"))
    scaled = F.least(F.bround(F.col("clipped") * F.lit(total) / F.col("all"), 0).cast("long"), F.col("clipped"))
    clipped = clipped.withColumn("v", F.when(F.col("all") < total, F.col("clipped")).otherwise(scaled))
    rest = F.least(F.lit(total) - (F.sum("v").over(one) - F.col("v")), F.col("clipped"))
    return clipped.select("name", "tokens", F.when((F.col("all") >= total) & F.col("last"), rest).otherwise(F.col("v")).cast("long").alias("target"), F.lit(1).cast("long").alias("repeats"))


def budget_cut(rows: DataFrame, source: str, order: str, n: Column, budget: int) -> DataFrame:
    """Rows of each source until its token budget is met; ``take`` cuts the last one."""
    totals = running_total(rows.withColumn("n", n), [source, order], F.col("n"), "__b")
    starts = totals.groupBy(source).agg(F.min("__b").alias("__s")).withColumnRenamed(source, "__source")
    out = totals.join(starts, F.col(source).eqNullSafe(F.col("__source"))).withColumn("before", F.col("__b") - F.col("__s")).where(F.col("before") < budget)
    return out.select(source, order, "n", "before", F.least(F.col("n"), F.lit(budget) - F.col("before")).alias("take"))


def char_budget(rows: DataFrame, order: str, n: Column, budget: int) -> DataFrame:
    """Rows in order until the total reaches the budget; the row that crosses it stays."""
    return running_total(rows.withColumn("n", n), [order], F.col("n"), "before").where(F.col("before") < budget).select(order, "n", "before")


def largest_remainder(sources: DataFrame, total: int) -> DataFrame:
    """Counts in proportion to ``weight`` that add up to ``total``: floors, then one more to the largest fractions."""
    one = W.partitionBy(F.lit(1))
    raw = sources.withColumn("raw", F.lit(total) * F.col("weight") / F.sum("weight").over(one)).withColumn("base", F.floor("raw"))
    raw = raw.withColumn("drift", F.lit(total) - F.sum("base").over(one)).withColumn("place", F.row_number().over(one.orderBy(F.desc(F.round(F.col("raw") - F.col("base"), 9)), "name")))
    return raw.select("name", (F.col("base") + F.when(F.col("place") <= F.col("drift"), 1).otherwise(0)).cast("long").alias("rows"))


def exact_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows: the first n of a seeded order, cycling through it where there are fewer. ``copy`` counts cycles."""
    total = rows.count()
    if not total:
        return shuffled_rank(rows.limit(0), seed, key).withColumn("copy", F.lit(0))
    ranked = shuffled_rank(rows, seed, key)
    times = F.greatest(F.floor((F.lit(n) - F.col("rank") - 1) / total) + 1, F.lit(0)).cast("int")
    return ranked.where(F.col("rank") < n).withColumn("copy", F.explode(F.sequence(F.lit(0), times - 1)))


def ratio_sample(rows: DataFrame, key: str, ratio: float, seed: int) -> DataFrame:
    """At least one row below ratio 1; whole copies and a sampled rest above it."""
    total = rows.count()
    whole = int(ratio)
    extra = max(1, int(total * ratio)) if ratio < 1 else int(total * (ratio - whole))
    ranked = shuffled_rank(rows, seed, key)
    copies = F.lit(whole) + F.when(F.col("rank") < extra, 1).otherwise(0)
    return ranked.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))


def turn_cap(rows: DataFrame, key: str, multi: Column, ratio: float, seed: int) -> DataFrame:
    """All single-turn rows and at most ``int(total * ratio)`` of the others."""
    cap = int(rows.count() * ratio)
    flagged = rows.withColumn("multi", multi)
    few = shuffled_rank(flagged.where("multi"), seed, key).where(F.col("rank") < cap).drop("rank")
    return flagged.where("not multi").unionByName(few)


def split_by_order(rows: DataFrame, key: str, share: float, seed: int) -> DataFrame:
    """train or val for each row: the first ``int(n * share)`` of a seeded order are val."""
    n = int(rows.count() * share)
    return shuffled_rank(rows, seed, key).withColumn("split", F.when(F.col("rank") < n, "val").otherwise("train"))


def shard_split(shards: DataFrame, share: float) -> DataFrame:
    """The last shards of each source are val, one at least, and one at least is train."""
    ranked = rank_within(shards, ["name"], ["shard"])
    vals = F.least(F.greatest(F.lit(1), F.bround(F.col("size") * share, 0)), F.col("size") - 1)
    return ranked.select("name", "shard", F.when(F.col("size") - F.col("rank") <= vals, "val").otherwise("train").alias("split"))


def shard_plan(sources: DataFrame, per_shard: int) -> DataFrame:
    """How many train and val shards of each source (name, target, train, val) to take, and by what method."""
    need = F.greatest(F.lit(1), F.floor(F.floor(F.col("target") * 0.95) / per_shard)).cast("long")
    val = F.greatest(F.lit(1), F.floor(F.floor(F.col("target") * 0.05) / per_shard)).cast("long")
    method = F.when(need < F.col("train"), "subsample").when(need == F.col("train"), "use_all").otherwise("upsample")
    return sources.select("name", "target", "train", "val", need.alias("train_needed"), F.least(val, F.col("val")).alias("val_needed"), method.alias("method"))


def shard_plan_rows(shards: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Train shards to write: whole copies and a seeded sample of the rest."""
    ranked = rank_within(shards.withColumn("__h", seeded(seed, "name", "shard")), ["name"], ["__h", "shard"])
    both = ranked.join(plan.select("name", "train", "train_needed"), "name")
    copies = (F.floor(F.col("train_needed") / F.col("train")) + F.when(F.col("rank") < F.col("train_needed") % F.col("train"), 1).otherwise(0)).cast("int")
    return both.withColumn("copies", copies).where("copies > 0").select("name", "shard", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
