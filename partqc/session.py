"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "partqc") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none (tests) is a folder of our own set; on a
    cluster a folder of one machine would lose data, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="partqc-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = f"{root}/partqc/{name}-{uuid.uuid4().hex[:12]}"
    if spark.sparkContext.master.split("[")[0] == "local" and ("://" not in path or path.startswith("file:")):
        os.makedirs(path.replace("file:", "", 1), exist_ok=True)
    return path


def stable_path(spark: SparkSession, name: str) -> str:
    """A fixed path under the shared checkpoint folder, for data that is
    rewritten (mode overwrite) on every run rather than accumulated."""
    return f"{checkpoint_root(spark)}/partqc/{name}"


def materialize(df):
    """Reliable checkpoint into the shared checkpoint folder: cuts the lineage
    (later branches read the written data instead of recomputing it) and
    survives lost executors. Never a machine-local checkpoint."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
