"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "stayrate", master: str | None = None) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Only pass ``master`` for local work; on a cluster the submit command names it. Shuffle
    partitions and memory are set for local masters alone: a cluster's own values (sized so that
    one partition fits an executor) are left untouched, and AQE merges what turns out small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column takes longer than a small query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", "8").config(
                "spark.driver.memory", "12g"
            )
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read and write, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is used in local mode only; on a cluster
    a machine-local folder would be lost with its executor, so that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="stayrate-"))
    return context.getCheckpointDir()


def run_folder(spark: SparkSession, purpose: str) -> str:
    """A new, not yet existing path below the shared folder. Removing it is up to the caller."""
    return os.path.join(shared_folder(spark), f"stayrate-{purpose}-{uuid.uuid4().hex}")
