"""Folders of CSV files that differ from one another (A3-A5): one catalogue, one scan per layout, one outcome per file.

``catalogue`` reads a folder's lines once and keeps one row per file: its first line (the header) and
whether quoted texts run over line ends.  Files of one layout (header, and whether they need
``multiLine``) are then scanned together, so only files with line breaks inside texts become one task
each; all others are split like any text.  ``outcomes`` says of every file whether it was read, is
empty or cannot be read, and why; a bad file costs only itself.

A file cannot be read if it has no header, lacks an asked column, or holds a row with more fields than
its header (an empty, unquoted field beyond it does not count); rows with fewer fields are filled with
nulls.  Empty fields are null.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_small
from ..session import checkpoint_path

FILES = "path string, file string, bytes long, header string, lines long, multi boolean"


@contextmanager
def _one_file_a_task(spark: SparkSession):
    """While plans are run in here, no two files share a task: a file's first row is then a task's first."""
    keys = {"spark.sql.files.openCostInBytes": spark.conf.get("spark.sql.files.maxPartitionBytes")}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def catalogue(spark: SparkSession, path: str, pattern: str = "*.csv", ignore_corrupt: bool = True) -> DataFrame:
    """One row per file below ``path`` (FILES): header is its first line, null if it has none.

    One pass over the lines: a hash aggregate whose key is (file, first line or null), so no line
    but the first of a file is kept.  Compressed files that break off or cannot be opened give the
    lines before the break."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": pattern, "ignoreCorruptFiles": ignore_corrupt}
    found = spark.read.format("binaryFile").options(**options).load(path)
    sizes = found.select(_plain("path").alias("path"), F.col("length").alias("bytes"))
    # scans skip files of no bytes, the listing (on the driver, as for any scan) has them
    listed = (spark.createDataFrame([(f,) for f in found.inputFiles()], "path string").select(_decoded("path").alias("path"))
              .join(sizes, "path", "left").select("path", F.coalesce("bytes", F.lit(0).cast("long")).alias("bytes")))
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's number in its task
    line = F.regexp_replace("value", "^﻿", "")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = (spark.read.options(**options).text(path)
             .select(F.col("_metadata.file_path").alias("path"),
                     F.when((row == 0) & (F.col("_metadata.file_block_start") == 0), line).alias("header"),
                     (quotes % 2 == 1).alias("odd"), (F.trim("value") != "").alias("filled")))
    with _one_file_a_task(spark):
        parts = (lines.groupBy("path", "header").agg(F.count_if("filled").alias("lines"), F.max("odd").alias("odd"))
                 .groupBy("path").agg(F.max("header").alias("header"), F.sum("lines").alias("lines"), F.max("odd").alias("multi")))
        parts = parts.withColumn("path", _decoded("path"))
        found = (listed.join(parts, "path", "left")
                 .select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "bytes",
                         F.when(F.trim("header") != "", F.col("header")).alias("header"),
                         F.coalesce("lines", F.lit(0).cast("long")).alias("lines"),
                         F.coalesce("multi", F.lit(False)).alias("multi")))
        out = checkpoint_path(spark, f"csv-files-{uuid.uuid4().hex}")
        found.write.parquet(out)
    return spark.read.schema(FILES).parquet(out)


def _plain(c: str | Column) -> Column:
    """A path without the local file system's scheme, which listings and scans spell differently."""
    return F.regexp_replace(c, "^file:/+", "/")


def _decoded(c: str | Column) -> Column:
    """The path behind a scan's ``_metadata.file_path``, which is a URL."""
    return _plain(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def header_names(header: str) -> list[str]:
    """Column names of a header line, trimmed and in lower case."""
    return [c.strip().strip('"').strip().lower() for c in next(csv.reader([header]), [])]


def layouts(files: DataFrame, columns: Sequence[str]) -> tuple[list[tuple[str, bool, list[str]]], list[str]]:
    """(header, multi, paths) of the layouts that hold all ``columns``, and the headers that do not.

    Headers are collected one per layout, paths one per file (a reader lists its files on the driver too)."""
    fit, unfit = [], []
    distinct = files.where(F.col("header").isNotNull()).groupBy("header", "multi").agg(F.collect_list("path").alias("paths"))
    for r in distinct.collect():
        names = header_names(r["header"])
        if all(c.lower() in names for c in columns):
            fit.append((r["header"], r["multi"], r["paths"]))
        else:
            unfit.append(r["header"])
    return fit, unfit


def scan(spark: SparkSession, files: DataFrame, columns: Sequence[str], optional: Sequence[str] = (),
         ignore_corrupt: bool = True) -> DataFrame:
    """(path, columns..., extra) of all files that hold ``columns``: strings, found by name whatever their
    order; ``optional`` ones are null where absent.  ``extra`` marks rows with more fields than the header."""
    parts = []
    for header, multi, paths in layouts(files, columns)[0]:
        names = header_names(header)
        # a further column takes what stands beyond the header
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("multiLine", multi)
              .option("escape", '"').option("emptyValue", "").option("ignoreCorruptFiles", ignore_corrupt).csv(paths))
        found = {c.lower(): F.nullif(F.col(f"c{names.index(c.lower())}"), F.lit("")) if c.lower() in names
                 else F.lit(None).cast("string") for c in (*columns, *optional)}
        parts.append(df.select(_decoded(F.col("_metadata.file_path")).alias("path"),
                               *[found[c.lower()].alias(c) for c in (*columns, *optional)],
                               F.col(f"c{len(names)}").isNotNull().alias("extra")))
    if not parts:
        empty = ["path", *columns, *optional]
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in empty) + ", extra boolean")
    return reduce(DataFrame.unionByName, parts)


def outcomes(files: DataFrame, rows: DataFrame, columns: Sequence[str], rejected: Column | None = None) -> DataFrame:
    """(path, file, status, reason, n_rows, n_rejected) of every file: `read`, `empty` (a header, no rows)
    or `unreadable`.  ``rejected`` marks rows of ``rows`` that the caller drops; only readable files have counts."""
    unfit = layouts(files, columns)[1]
    bad = F.coalesce(rejected, F.lit(False)) if rejected is not None else F.lit(False)
    counted = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count_if("extra").alias("extra"),
                                       F.count_if(bad).alias("rejected"))
    # most files have the headers that fit; the others are compared with a list of whole header lines
    lacks = F.col("header").isin(unfit) if unfit else F.lit(False)
    reason = (F.when(F.col("header").isNull(), F.lit("no header")).when(lacks, F.lit("column missing"))
              .when(F.col("extra") > 0, F.lit("row with more fields than the header")))
    out = files.join(counted, "path", "left").withColumn("reason", reason)
    status = (F.when(F.col("reason").isNotNull(), F.lit("unreadable"))
              .when(F.coalesce("n", F.lit(0)) == 0, F.lit("empty")).otherwise(F.lit("read")))
    readable = F.col("status") != "unreadable"
    return out.withColumn("status", status).select(
        "path", "file", "status", "reason",
        *[F.when(readable, F.coalesce(c, F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long")).alias(a)
          for c, a in (("n", "n_rows"), ("rejected", "n_rejected"))])


def whole_file(path: str | Column) -> Column:
    """The file that a path belongs to: a folder named like a CSV file is one file in parts."""
    return F.regexp_replace(path, r"(\.csv)/[^/]+$", "$1")


def of_whole_files(found: DataFrame) -> DataFrame:
    """Outcomes with one row per ``whole_file``: a part that cannot be read makes its file unreadable."""
    bad = F.max(F.col("status") == "unreadable")
    n = F.sum("n_rows")
    zero = F.lit(0).cast("long")
    return (found.withColumn("path", whole_file("path")).groupBy("path")
            .agg(F.when(bad, F.lit("unreadable")).when(n == 0, F.lit("empty")).otherwise(F.lit("read")).alias("status"),
                 F.min("reason").alias("reason"), F.when(bad, zero).otherwise(n).alias("n_rows"),
                 F.when(bad, zero).otherwise(F.sum("n_rejected")).alias("n_rejected"))
            .select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "status", "reason", "n_rows", "n_rejected"))


def of_read_files(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of files whose outcome is `read` (``found``: outcomes; one small row per file)."""
    return join_small(rows, found.where("status = 'read'").select("path"), ["path"], "left_semi").drop("extra")


def category_of(file: str | Column) -> Column:
    """A5: `arxiv_X.csv` -> X: the file name without that prefix and its ending."""
    return F.replace(F.replace(F.col(file) if isinstance(file, str) else file, F.lit("arxiv_"), F.lit("")), F.lit(".csv"), F.lit(""))
