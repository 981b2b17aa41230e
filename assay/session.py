"""Session helpers for local runs (tests, bench).  On a cluster, use the
cluster's session: nothing in the library sets executor or shuffle sizes."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "assay") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("ASSAY_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir`` if set,
    else (local masters only) a fresh temporary folder."""
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    require_shared_folder(spark.sparkContext.master, current)
    path = tempfile.mkdtemp(prefix="assay-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def require_shared_folder(master: str, folder: str | None) -> None:
    """On any but a local master, a shared folder must be set: executors do not see the driver's disk."""
    if not folder and not master.startswith("local[") and master != "local":
        raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): name a folder that all hosts share")


def cluster_session(app: str = "assay") -> SparkSession:
    """The submitted application's session: master, sizes and folders are the cluster's."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName(app).getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def job_label(spark: SparkSession, text: str):
    """Label the Spark jobs started inside the block (shown in logs and event logs)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: tag the operations instead
        spark.addTag(text.replace(",", " "))
        try:
            yield
        finally:
            spark.removeTag(text.replace(",", " "))
        return
    previous = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(text)
    try:
        yield
    finally:
        sc.setJobDescription(previous)
