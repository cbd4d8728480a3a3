"""Session settings the library relies on, and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even where that costs a later shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "leaksafe", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder.

    The cluster names the folder in `spark.checkpoint.dir`. Only a local session that
    names none gets a temporary one, because no other machine has to read it.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can read")
            folder = tempfile.mkdtemp(prefix="leaksafe-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
