"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cores: str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own master and sizes."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("snapmart")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="snapmart-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
