"""Audit lines: formatting, parsing, filtering, retention; lineage of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage_cut import checkpointed


def value(c: Column) -> Column:
    """A field's value: pipes and quotes escaped, quoted if it holds a blank, an equals sign or a pipe."""
    c = F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit('"'), F.lit('\\"'))
    return F.when(c.rlike(r"[ =|]"), F.concat(F.lit('"'), c, F.lit('"'))).otherwise(c)


def timestamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def line(ts: Column, category: Column, level: Column, known: dict[str, Column], fields: dict[str, Column], details: Column | None = None) -> Column:
    """One line: time, category, level, known fields in order, other fields sorted by name, details last. Null fields and
    empty ones are left out."""
    named = [F.when(v != "", F.concat(F.lit(f"{k}="), value(v))) for k, v in [*known.items(), *sorted(fields.items())]]
    last = [F.when(details != "", F.concat(F.lit('details="'), details, F.lit('"')))] if details is not None else []
    return F.concat_ws(" | ", timestamp(ts), category, level, *named, *last)


def parse(c: Column) -> Column:
    """Struct of a line's parts: time, category, level, action, user, all fields as a map, details."""
    details = F.regexp_extract(c, r'(?s) \| details="(.*)"\z', 1)
    head = F.regexp_replace(c, r'(?s) \| details=".*"\z', "")
    parts = F.split(head, r" \| ")
    pairs = F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0)))
    plain = lambda v: F.replace(F.replace(F.regexp_replace(v, r'(?s)\A"(.*)"\z', "$1"), F.lit("\\|"), F.lit("|")), F.lit('\\"'), F.lit('"'))
    fields = F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), plain(F.substr(p, F.locate("=", p) + 1)).alias("v"))))
    return F.struct(F.to_timestamp(parts[0]).alias("ts"), parts[1].alias("category"), parts[2].alias("level"), fields.alias("fields"), F.when(details != "", details).alias("details"))


def expired(day: Column, now: Column, days: int) -> Column:
    """Older than ``days`` days; the time of day of ``now`` counts, so exactly that old is expired. 0 keeps all."""
    return F.lit(False) if days <= 0 else day.cast("timestamp") < now - F.expr(f"INTERVAL {days} DAYS")


def flatten_lineage(edges: DataFrame, root: str, most: int = 50) -> DataFrame:
    """Share of each leaf in ``root``: edges (dataset, input, ratio) followed to inputs that have none, ratios multiplied.

    One join per level of the graph, each level summed by node and checkpointed; a cycle ends with an error.
    """
    level = edges.where(F.col("dataset") == root).select(F.col("input").alias("node"), F.col("ratio").alias("share"))
    leaves = None
    inner = edges.select("dataset").distinct()
    for _ in range(most):
        level = checkpointed(level.groupBy("node").agg(F.sum("share").alias("share")))
        done = level.join(inner, level.node == inner.dataset, "left_anti")
        leaves = done if leaves is None else leaves.unionByName(done)
        level = level.join(edges, level.node == edges.dataset).select(F.col("input").alias("node"), (F.col("share") * F.col("ratio")).alias("share"))
        if level.isEmpty():
            return leaves.groupBy("node").agg(F.sum("share").alias("share"))
    raise ValueError("lineage is deeper than allowed or has a cycle")


def with_context(fields: dict[str, Column], context: dict[str, Column]) -> dict[str, Column]:
    """Explicit user, ip and session over the request's own; an empty explicit value falls back too."""
    blank = lambda c: F.when(c != "", c)
    known = {k: F.coalesce(*[blank(d[k]) for d in (fields, context) if k in d]) for k in ("user", "ip", "session") if k in fields or k in context}
    return {**known, **{k: v for k, v in fields.items() if k not in known}}
