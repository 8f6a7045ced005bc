"""Session helpers: settings the library relies on, applied only where unset."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume.  They are applied to a session the caller
# builds with ``get_spark``; a session handed in by a cluster keeps its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files of DataFrames that are no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "lexitrend") -> SparkSession:
    """Build (or reuse) a session for local runs and tests."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEXITREND_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared (distributed) folder and is
    read as is.  Only when it is unset in a local run (tests) a private scratch
    folder is created so that ``DataFrame.checkpoint()`` works; on a cluster
    executors could not share it, so that is an error.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lexitrend-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for a written intermediate table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
