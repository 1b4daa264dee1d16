"""Session helpers. Library code never creates a session; jobs and tests do."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

APP_NAME = "blotter"


def open_session(app_name: str = APP_NAME, master: str | None = None, extra: dict | None = None) -> SparkSession:
    """Get or create a session. ``master`` only for local runs: on a cluster
    the launcher supplies it. Shuffle width is left to AQE, which coalesces
    small partitions and splits skewed ones."""
    b = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # AQE merges shuffle partitions up to this size; with a generous
        # spark.sql.shuffle.partitions it yields partitions that fit memory.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        b = b.master(master)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is read from the session.
    Only when it is unset and the master is local (tests, a laptop) is a
    local one created; on a cluster an unset value is an error, as a
    machine-local folder would not be visible to other executors.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is unset; point it at a shared folder")
        base = tempfile.mkdtemp(prefix="blotter-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a folder (see ``shared_dir``)."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        shared_dir(spark, "init")
    return sc.getCheckpointDir()
