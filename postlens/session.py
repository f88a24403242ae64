"""SparkSession construction and shared-storage helpers.

On a cluster the session is created by the platform; ``get_spark`` only
fills in settings that are still unset, so a cluster's own choices
(shuffle partitions, checkpoint directory, broadcast threshold) win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults applied only where the running session leaves a setting unset.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "postlens") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if os.environ.get("POSTLENS_DRIVER_MEMORY"):
        builder = builder.config("spark.driver.memory", os.environ["POSTLENS_DRIVER_MEMORY"])
    if SparkContext._active_spark_context is None:
        given = SparkConf()  # spark-defaults and --conf
        for key, value in SESSION_DEFAULTS.items():
            if not given.contains(key):
                builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session, else the directory
    set on the context is taken. Only a local master (tests, the bench) gets
    a fresh scratch folder; a cluster without a shared folder is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir names no shared folder; on a cluster intermediate data needs one")
        folder = tempfile.mkdtemp(prefix="postlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint directory (never machine-local
    on a cluster, since that directory is the cluster's shared one)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for one run of
    a job that writes and reads back (unique per call, never reused)."""
    import uuid
    return shared_path(spark, "postlens-runs", f"{name}-{uuid.uuid4().hex[:12]}")


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint directory and read
    from there, so that many passes over it compute it once."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
