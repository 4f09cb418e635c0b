"""Session helpers: a local session for tests/bench and the shared work folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "orderlens") -> SparkSession:
    """Local session used by tests and bench; a cluster passes its own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("ORDERLENS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # local runs only (tests, bench): a folder of our own only where the session names none
    # (spark.checkpoint.dir is a core setting, fixed once the context runs; the context's
    # checkpoint folder is what shared_dir() falls back to)
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlens-ckpt-"))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables and checkpoints.

    Uses the cluster's ``spark.checkpoint.dir`` (a shared file system).  Only a local-mode
    session without one gets a fresh folder under the system temp dir; on a cluster a missing
    setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        path = tempfile.mkdtemp(prefix="orderlens-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")
