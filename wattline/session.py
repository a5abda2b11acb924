"""Session settings the operators rely on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "wattline", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; on a cluster, pass no master and submit as usual."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")  # 007 is a vehicle, not a number
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a local one is made only where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    import tempfile

    fresh = os.path.join(tempfile.mkdtemp(prefix="wattline-"), "checkpoints")
    spark.sparkContext.setCheckpointDir(fresh)
    return fresh


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own in the checkpoint folder: it cuts the plan and is read by column."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
