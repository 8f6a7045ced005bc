"""Sinks (A6-A8): CSV with quote-all + header, partitioned multi-sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """Quote-all CSV with a header per part file (no single-file merge)."""
    w = df.write.mode(mode).option("header", True).option("quoteAll", True).option("escape", '"')
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    """One folder per partition value (a paper lands in each of its domains).

    Mode ``replace_partitions``: a rerun replaces the folders that it has rows for and no others.  The rows
    are rebalanced by the partition columns first, so a folder gets few files, and a hot value's rows, which
    adaptive execution splits by size, get several."""
    if not partition_by:
        df.write.mode("overwrite" if mode == "replace_partitions" else mode).parquet(path)
        return
    if mode == "replace_partitions":
        w = df.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = df.write.mode(mode)
    w.partitionBy(*partition_by).parquet(path)


def write_split(df: DataFrame, keep: Column, output: str, rejects: str) -> None:
    """One pass over ``df``, two tables: rows that ``keep`` holds for go to ``output``, the others
    (null included) to ``rejects``, each replacing what was there.

    Both are written as folders of one staging table beside ``output`` and moved into place when the
    write has been committed, so a job that breaks off leaves the old tables as they were."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(output).getFileSystem(spark._jsc.hadoopConfiguration())
    staging = f"{output.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.withColumn("_keep", F.coalesce(keep, F.lit(False))).write.partitionBy("_keep").parquet(staging)
    for kept, to in (("true", output), ("false", rejects)):
        if fs.exists(path(f"{staging}/_keep={kept}")):
            fs.delete(path(to), True)
            fs.mkdirs(path(to).getParent())
            fs.rename(path(f"{staging}/_keep={kept}"), path(to))
        else:
            spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(to)
    fs.delete(path(staging), True)
