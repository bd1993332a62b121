"""Structured Streaming over append-only logs. Watermarks and late-data rules are additions: plain logs have neither."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def audit_stream(spark: SparkSession, path: str) -> DataFrame:
    """Parsed audit lines as they are appended."""
    return spark.readStream.text(path).select(audit.parse(F.col("value")).alias("p")).select("p.*")


def daily_counts(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Events per day and category; a day closes ``delay`` after the latest event seen."""
    windows = events.withWatermark("ts", delay).groupBy(F.window("ts", "1 day"), "category").count()
    return windows.select(F.col("window.start").alias("day"), "category", "count")


def training_log(spark: SparkSession, path: str, schema: str = "event string, iter int, train_loss double, val_loss double") -> DataFrame:
    """Evaluations of a JSON training log as they are appended."""
    return spark.readStream.schema(schema).json(path).where("event = 'eval' or event is null")


def first_seen(rows: DataFrame, key: str, delay: str = "1 day") -> DataFrame:
    """Rows whose key was not seen within the watermark: deduplication across runs with bounded state."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Everything that is there now, into a table in memory; later calls go on from the checkpoint."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
