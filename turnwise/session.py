"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Dates are compared as written and ids are ordered by hash, so one zone must hold everywhere.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Filters reach sources that are written in Python (SQLite files).
    "spark.sql.python.filterPushdown.enabled": "true",
}


def local_session(app: str, cpus: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass SETTINGS to spark-submit."""
    builder = SparkSession.builder.appName(app).master(f"local[{cpus}]")
    options = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        # Small tables still spread over all cores after a shuffle.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        **extra,
    }
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster. Only a session in one process may do without one:
    it gets a temporary folder. Elsewhere executors would not see each other's files."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="turnwise-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def answer_log(spark: SparkSession) -> str | None:
    """A fresh folder for the answers of a service, where the shared folder is a path that
    tasks can open; else None, and a job that wants a log must name one."""
    path = scratch_path(spark, "answers")
    return path if re.match(r"(file:|/)", path) else None


def store(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table once to the shared folder and read it from there.

    For a result that several later steps read. Unlike ``checkpoint()`` this works the rows
    out once, keeps columns apart and tells the planner the size; like it, it cuts the
    lineage, so a lost executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
