"""Session set-up and the shared folder streams and checkpoints write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "siftwork", master: str | None = None, cores: int | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """A session with the settings every operator here assumes.

    ``master`` stays unset on a cluster; tests and the bench pass ``local[n]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("SIFTWORK_DRIVER_MEMORY", "8g"))
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if checkpoint_dir:
        b = b.config("spark.checkpoint.dir", checkpoint_dir)
    if cores:
        b = b.config("spark.sql.shuffle.partitions", str(cores))
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    return b.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the run-time settings results depend on (day boundaries, skew handling)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Per-key row limits above the default 1000 are also cut on the map side.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "20000")
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is used only in local mode.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="siftwork-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
