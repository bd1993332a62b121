"""Reliable checkpoints in the folder that the session's ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage by a checkpoint that survives lost executors. A folder is made only where none is set (tests)."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="siltstone-"))
    return df.checkpoint()
