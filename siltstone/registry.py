"""Registry of named queries."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_ROOT = Path(__file__).resolve().parent.parent
_SHIPPED: set[str] = set()


def query(oracle: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its DuckDB SQL if there is one."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once per application, unless their Python path already holds it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED or str(_ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    _SHIPPED.add(sc.applicationId)
    folder = tempfile.mkdtemp(prefix="siltstone-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "siltstone.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in [*(_ROOT / "siltstone").rglob("*.py"), *_ROOT.glob("corpus_pipeline.py")]:
            z.write(f, f.relative_to(_ROOT))
    sc.addPyFile(archive)


#: Tables of whole texts, and the setting for how many partitions to deal them out to when they are read. It is for single
#: machines with one small file; without it tables are read as they lie.
_TEXTS, READ_PARTITIONS = frozenset({"documents", "pages"}), "spark.siltstone.readPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of a folder."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(READ_PARTITIONS, None)
    return df.repartition(int(parts)) if parts and name in _TEXTS else df
