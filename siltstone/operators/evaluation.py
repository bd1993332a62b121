"""Training logs, checks of responses and selection of checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

# Phrases of an abstention.
ABSTAIN = ["don't have enough information", "do not have enough information", "not enough information", "unknown", "cannot determine"]


def response(c: Column) -> Column:
    """The response up to its closing tag or end mark."""
    return T.strip(F.regexp_replace(T.strip(c), r"(?s)(</assistant>|<eot>).*\z", ""))


def echo(c: Column, expected: Column) -> Column:
    bare = lambda x: F.lower(F.regexp_replace(x, r"[.!?,;:]+\z", ""))
    return bare(response(c)).startswith(bare(expected))


def exact_only(c: Column, expected: Column) -> Column:
    return ~response(c).rlike(r"`|\*\*|__") & (response(c) == expected)


def lacks(c: Column, forbidden: Column) -> Column:
    return ~F.contains(F.lower(response(c)), F.lower(forbidden))


def abstains(c: Column) -> Column:
    out = F.lit(False)
    for a in ABSTAIN:
        out = out | F.contains(F.lower(response(c)), F.lit(a))
    return out


def saturation(log: DataFrame, step: str, train: str, val: str, window: int = 5, min_delta: float = 0.001, gap_limit: float = 0.05) -> DataFrame:
    """Signals over the last ``window`` evaluations of one run: plateau, memorization, widening gap. The log has one row
    per evaluation, so one ordered task is what it needs."""
    w = W.orderBy(step)
    then = lambda c: F.lag(c, window - 1).over(w)
    gain = lambda c: (F.col(c) - then(c)) / (window - 1)
    gap = F.col(train) - F.col(val)
    out = log.withColumn("gap", gap).withColumn("train_gain", gain(train)).withColumn("val_gain", gain(val)).withColumn("gap_growth", F.col("gap") - F.lag("gap", window - 1).over(w))
    d = F.lit(min_delta)
    return out.select(
        step, F.round("train_gain", 6).alias("train_gain"), F.round("val_gain", 6).alias("val_gain"), F.round("gap_growth", 6).alias("gap_growth"),
        ((F.col("train_gain") < d) & (F.col("val_gain") < d)).alias("plateau"), ((F.col("val_gain") < d) & (F.col("train_gain") > d) & (F.col("gap_growth") > 0)).alias("memorization"), (F.col("gap_growth") > gap_limit).alias("widening"),
    ).where("train_gain is not null")


def best_so_far(log: DataFrame, step: str, loss: str) -> DataFrame:
    w = W.orderBy(step).rowsBetween(W.unboundedPreceding, -1)
    return log.withColumn("best_before", F.min(loss).over(w)).select(step, loss, "best_before", (F.col("best_before").isNull() | (F.col(loss) < F.col("best_before"))).alias("is_best"))


def regression(log: DataFrame, step: str, loss: str, threshold: float = 0.05) -> DataFrame:
    """Relative change against the first evaluation."""
    base = F.first(loss).over(W.orderBy(step).rowsBetween(W.unboundedPreceding, 0))
    change = F.when(base > 1e-6, (F.col(loss) - base) / base)
    return log.select(step, F.round(change, 6).alias("change"), (change > threshold).alias("regressed"))


def gold(log: DataFrame, step: str, train: str, val: str, overfit: float = 1.5, rises: int = 3) -> DataFrame:
    """Which evaluations become the best checkpoint: blocked when validation is far over training loss or fell only after
    ``rises`` rises in a row; else better than every unblocked one before."""
    w = W.orderBy(step)
    up = F.coalesce((F.col(val) > F.lag(val).over(w)).cast("int"), F.lit(0))
    rows = log.withColumn("up", up)
    streak = F.lit(True)
    for i in range(1, rises + 1):
        streak = streak & (F.coalesce(F.lag("up", i).over(w), F.lit(0)) == 1)
    rows = rows.withColumn("blocked", F.when(F.col(val) > F.col(train) * overfit, "overfit").when(streak, "flapping"))
    before = F.min(F.when(F.col("blocked").isNull(), F.col(val))).over(w.rowsBetween(W.unboundedPreceding, -1))
    return rows.select(step, train, val, "blocked", (F.col("blocked").isNull() & (before.isNull() | (F.col(val) < before))).alias("gold"))


def phase_at(steps: DataFrame, schedule: DataFrame, step: str) -> DataFrame:
    """The phase whose start is the last one not after the step. The schedule is a handful of rows."""
    joined = steps.join(F.broadcast(schedule), F.col("start") <= F.col(step))
    return joined.groupBy(step).agg(F.max_by("phase", "start").alias("phase"))


def human_size(c: Column) -> Column:
    """A whole number of bytes as text, null for null. Halves go to the even digit, as C's printf rounds quotients by powers
    of two, where ``format_string`` would round them up; digits are made of whole numbers, so nothing is rounded before."""

    def scaled(bits: int, digits: int, unit: str) -> Column:
        mask, tens = F.lit((1 << bits) - 1).cast("long"), 10**digits
        shifted = c.bitwiseAND(mask) * tens
        low, twice = F.shiftright(shifted, bits), shifted.bitwiseAND(mask) * 2
        up = (twice > 1 << bits) | ((twice == 1 << bits) & (low % 2 == 1))
        low = low + up.cast("long")
        return F.format_string(f"%d.%0{digits}d {unit}", F.shiftright(c, bits) + (low == tens).cast("long"), low % tens)

    k = 1024
    c = c.cast("long")
    return F.when(c < k, F.format_string("%d B", c)).when(c < k**2, scaled(10, 1, "KB")).when(c < k**3, scaled(20, 1, "MB")).when(c.isNotNull(), scaled(30, 2, "GB"))
