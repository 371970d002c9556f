"""Session helpers.

The library never creates a session behind the caller's back; these helpers
are for scripts, tests and the bench.  ``scratch_dir`` returns the shared
folder named by ``spark.checkpoint.dir`` and only sets one when the session has
none (local runs and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "adfunnel", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging tables.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system); a session with another master than
    ``local`` that has none is refused, as its executors would write to their own disks.  A local session
    without one, as in tests, gets a temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir is not set and {master} needs a shared folder")
        current = tempfile.mkdtemp(prefix="adfunnel-ckpt-")
        spark.sparkContext.setCheckpointDir(current)
    return current


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused sub-path of the scratch folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "scratch_dir", "new_scratch_path", "local_path"]
