"""Session settings and the shared folder used for checkpoints, models and tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Settings every job of this library wants; cluster sizing stays with the submitter."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session without it."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="run-")
        spark.sparkContext.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def run_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run, below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialized(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back, for results that several passes read.

    Unlike a checkpoint it keeps column pruning, pushed filters and sizes for later plans.
    """
    path = run_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
