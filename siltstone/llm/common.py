"""Shared plumbing: table access, shared scratch tables, size-checked broadcasts and graph components."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import functools
import os
import shutil
import tempfile
import uuid
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..registry import table as table

#: Words of the contracts: runs of anything but the six ASCII white-space characters.
SPACE_CLASS = r"[\x20\x09-\x0D]+"

#: Tables of up to so many bytes of files are broadcast.
BROADCAST_BYTES = 8 << 20

_LOCAL_SCRATCH: dict[str, str] = {}
#: Tables that the running operator (see tidy) has made and not yet deleted.
_MADE: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("made", default=None)


def words_of(text):
    """Column: array of words of ``text`` (null text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def let(value, body):
    """Bind a column once for use inside higher-order functions (a lambda re-evaluates free expressions per element)."""
    return F.transform(F.array(value), body)[0]


def small_parts(batches, rows: int = 2000):
    """Arrow batches in pieces of a few rows, so that what a task makes of one stays small. At the end of the task its
    worker, which Spark keeps for later ones, gives the memory back."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    give_back()


def give_back() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library may be another
        ctypes.CDLL(None).malloc_trim(0)


def scratch_root(spark: SparkSession) -> str:
    """Folder that driver and executors share: the session's checkpoint directory.

    Only where none is set (single-machine tests) a temporary one is made; on a cluster that is an error.
    """
    sc = spark.sparkContext
    root = sc._jsc.sc().getCheckpointDir()
    if root.isDefined():
        return root.get()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = _LOCAL_SCRATCH.get(sc.applicationId)
        if conf is None:
            conf = _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="siltstone-")
            atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return sc._jsc.sc().getCheckpointDir().get()


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder under the shared root as a plain path, for files that are memory-mapped.

    Memory mapping needs a mounted file system, so any scheme but ``file`` is refused.
    """
    url = urlparse(scratch_root(spark))
    if url.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted shared folder, not {url.scheme}://")
    path = os.path.join(unquote(url.path), f"{tag}-{uuid.uuid4().hex}")
    os.makedirs(path)
    return path


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and the table survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._siltstone_path = path
    made = _MADE.get()
    if made is not None:
        made.append(out)
    return out


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def drop(df: DataFrame) -> None:
    """Delete a table made by materialize() that no later step reads."""
    path = getattr(df, "_siltstone_path", None)
    if path:
        made = _MADE.get()
        if made is not None:
            made[:] = [x for x in made if x is not df]
        files, jpath = _file_system(df.sparkSession, path)
        files.delete(jpath, True)


def reads(df: DataFrame) -> list[str]:
    """Root paths of the files that a plan reads; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            out += [roots.apply(j).toString() for j in range(roots.size())]
    return out


def tidy(operator):
    """An operator whose scratch tables are its own: when it returns, those that its result doesn't read are deleted. The
    others pass to the operator that called it, if any, and else stay as long as the shared folder: the result is lazy."""

    @functools.wraps(operator)
    def run(*args, **kwargs):
        outer, made = _MADE.get(), []
        token, out = _MADE.set(made), None
        try:
            out = operator(*args, **kwargs)
        finally:
            _MADE.reset(token)
            used = {p.rstrip("/").rsplit("/", 1)[-1] for p in reads(out)} if isinstance(out, DataFrame) else set()
            for df in made:
                if df._siltstone_path.rsplit("/", 1)[-1] not in used:
                    drop(df)
                elif outer is not None:
                    outer.append(df)
        return out

    return run


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcast if all files it is read from have ``max_bytes`` at most; beyond the bound the join
    shuffles. The size is that on disk, so a column of arrays counts with what it holds."""
    size, roots = 0, set(reads(df))
    for root in roots:
        files, path = _file_system(df.sparkSession, root)
        size += files.getContentSummary(path).getLength()
    return F.broadcast(df) if roots and size <= max_bytes else df


@tidy
def components(links: DataFrame, tag: str = "components") -> DataFrame:
    """Connected components of ``links(a long, b long)``: one row (node, root) per node, root the smallest node.

    Alternating large-star and small-star rounds: each is one aggregation and one join on the node, so no neighbour
    list is ever gathered; a hub's rows are split by adaptive skew joins. Every round is a table in the shared folder.
    """
    edges = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag
    )

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        big = materialize(large.where("a <> b"), tag)
        low = big.groupBy("a").agg(F.min("b").alias("m"))
        small = big.join(low, "a").select(F.col("b").alias("x"), "m", "a")
        small = (
            small.select(F.col("x").alias("a"), F.col("m").alias("b"))
            .unionByName(small.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        new = materialize(small, tag)
        drop(big)
        drop(edges)
        edges, last, seen = new, seen, mark(new)
        if seen == last:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
