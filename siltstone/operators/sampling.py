"""Sampling towards a target: replay passages, paraphrase slots, token windows, and the arithmetic of mixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .ordered import rank_within, seeded, shuffled_rank


def unit(seed: int, *keys: str) -> Column:
    """A pseudo-random number in [0, 1) of a row's keys that any engine can reproduce."""
    return F.conv(F.substring(seeded(seed, *keys), 1, 13), 16, 10).cast("double") / float(1 << 52)


def replay(passages: DataFrame, weights: DataFrame, wanted: int, seed: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``wanted`` passages that are long enough (20 characters) and made of letters (0.3), the share of each source by its
    weight (source, weight). Rounded quotas; a source with too few passages gives all it has. Adds rank and quota."""
    body = T.strip(F.col(text))
    letters = F.length(F.regexp_replace(body, r"[^\p{L}]", "")) / F.greatest(F.length(body), F.lit(1))
    good = passages.where((F.length(body) >= 20) & (letters >= 0.3))
    total = weights.agg(F.sum("weight").alias("all"))
    quota = weights.join(F.broadcast(total)).select("source", F.round(F.lit(wanted) * F.col("weight") / F.col("all")).cast("long").alias("quota"))  # one row
    ranked = rank_within(good.withColumn("__h", seeded(seed, key)), ["source"], ["__h", key])
    return ranked.join(quota, "source").where("rank < quota").drop("__h", "size")


def augment(rows: DataFrame, target: int, seed: int, key: str) -> DataFrame:
    """Slots ``aug_00000`` on for as many rows as ``target`` is short of, each with the row it is drawn from; draws are
    uniform and with replacement. Only numbers are joined, so a slot may be paraphrased where it lies."""
    n = rows.count()
    if not 0 < n < target:
        return rows.limit(0).select(F.lit("").alias("id"), key)
    slots = rows.sparkSession.range(target - n).select(F.col("id").alias("slot"), F.floor(unit(seed, "id") * n).alias("rank"))
    drawn = slots.join(shuffled_rank(rows.select(key), seed, key), "rank")
    return drawn.select(F.concat(F.lit("aug_"), F.lpad(F.col("slot").cast("string"), 5, "0")).alias("id"), key)


def random_windows(shards: DataFrame, block: int, per_shard: int, seed: int, key: str = "shard") -> DataFrame:
    """``per_shard`` windows of each token shard (key, tokens): start, x and its targets y, one further. Starts are
    uniform, with replacement; a shard of fewer starts than asked for gives each once, from the first on."""
    most = F.size("tokens") - block - 1
    starts = F.when(most >= per_shard, F.transform(F.sequence(F.lit(0), F.lit(per_shard - 1)), lambda i: F.floor(F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), i.cast("string"))), 1, 13), 16, 10).cast("double") / float(1 << 52) * most).cast("int")))
    some = F.when(most > 0, F.coalesce(starts, F.sequence(F.lit(0), F.greatest(most, F.lit(1)) - 1)))
    rows = shards.select(key, "tokens", F.posexplode(some).alias("draw", "start"))
    return rows.select(key, "draw", "start", F.slice("tokens", F.col("start") + 1, block).alias("x"), F.slice("tokens", F.col("start") + 2, block).alias("y"))


def general_tokens(sft: Column, available: Column, ratio: float, chunk: int) -> Column:
    """Tokens of general text beside ``sft`` tokens so that they are ``ratio`` of the mix, in whole chunks."""
    wanted = F.floor(sft * ratio / (1 - ratio))
    return F.floor(F.least(wanted, available) / chunk) * chunk


def ratios(parts: dict[str, float], present: set[str]) -> dict[str, float]:
    """Shares of the sources that are there, scaled to 1; equal ones if theirs are all 0."""
    left = {k: v for k, v in parts.items() if k in present}
    total = sum(left.values())
    return {k: (left[k] / total if total > 0 else 1 / len(left)) if k in left else 0.0 for k in parts}


def eta_minutes(steps_done: Column, steps_left: Column, seconds: Column) -> Column:
    """Minutes left at the pace so far; null before the first step."""
    return F.when(steps_done > 0, F.round(steps_left * seconds / steps_done / 60))


def loss_by_class(tokens: DataFrame, kind: Column, loss: str = "loss") -> DataFrame:
    """Count and mean loss of each class of tokens, with its share of the whole loss."""
    per = tokens.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum(loss).alias("sum"))
    whole = per.agg(F.sum("sum").alias("all"))
    return per.join(F.broadcast(whole)).select("kind", "n", (F.col("sum") / F.col("n")).alias("mean"), (F.col("sum") / F.col("all")).alias("share"))  # one row
