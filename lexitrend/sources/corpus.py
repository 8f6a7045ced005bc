"""Corpus readers with explicit schemas (A1-A5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import csv_files as CF

CORRUPT = "_corrupt"

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("update_date", T.StringType()),
    T.StructField("versions", T.ArrayType(T.StructType([T.StructField("created", T.StringType())]))),
    T.StructField("authors_parsed", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField(CORRUPT, T.StringType()),
])

_NAME = T.StructType([T.StructField("display_name", T.StringType())])
WORKS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("publication_date", T.StringType()),
    T.StructField("authorships", T.ArrayType(T.StructType([T.StructField("author", _NAME)]))),
    T.StructField("primary_topic", _NAME),
    T.StructField("concepts", T.ArrayType(_NAME)),
    # must be a map: inference would make one struct field per word
    T.StructField("abstract_inverted_index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType()))),
    T.StructField(CORRUPT, T.StringType()),
])

PAPERS_CSV_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("published_date", T.StringType()),
    T.StructField("authors", T.StringType()),
    T.StructField("primary_category", T.StringType()),
    T.StructField("all_categories", T.StringType()),
])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, spread: bool = False,
                    file_column: str | None = None) -> DataFrame:
    """A1/A2: JSON-lines scan, malformed lines kept in ``_corrupt`` (PERMISSIVE).

    gzip files are not splittable (one task per file); ``spread`` deals the parsed rows out anew
    before the heavy work, in partitions whose size adaptive execution sets from the data.
    ``file_column`` adds the path of each row's file."""
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    if file_column:
        df = df.withColumn(file_column, F.col("_metadata.file_path"))
    return df.hint("rebalance") if spread else df


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows and malformed lines (counted as a side output).  The bad
    side keeps all columns: Spark rejects queries on the corrupt column alone."""
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), df.where(F.col(CORRUPT).isNotNull())


def read_csv(spark: SparkSession, path: str, columns: list[str], optional: tuple[str, ...] = (),
             multi_line: bool | None = False) -> DataFrame:
    """A3: columns of header CSV files, as strings, found by name (trimmed, without a byte order mark).

    Files may order their columns as they like, but all files of a path alike: a header that differs
    from the first one fails the read.  An absent column is an error, or null if ``optional``.
    ``multi_line`` (quoted line breaks) makes each file one task; None looks at the files first
    (``csv_files.catalogue``, one pass over their lines), so that only those with line breaks inside
    texts are, and the files' headers may differ in order and number."""
    if multi_line is None:
        files = CF.catalogue(spark, path, "*.csv*", ignore_corrupt=False).where(F.col("bytes") > 0)
        unfit = CF.layouts(files, [c for c in columns if c not in optional])[1]
        if unfit:
            raise ValueError(f"{path}: a column of {', '.join(columns)} is missing in {unfit[0]}")
        must = [c for c in columns if c not in optional]
        rows = CF.scan(spark, files, must, [c for c in columns if c in optional], ignore_corrupt=False)
        return rows.select(*columns)
    df = (spark.read.option("header", True).option("enforceSchema", False).option("multiLine", multi_line)
          .option("escape", '"').csv(path))
    names = {c.lstrip("\ufeff").strip().strip('"').lower(): c for c in df.columns}
    absent = [c for c in columns if c.lower() not in names and c not in optional]
    if absent:
        raise ValueError(f"{path}: no column {', '.join(absent)} in {df.columns}")
    return df.select(*[F.col(f"`{names[c.lower()]}`").alias(c) if c.lower() in names
                       else F.lit(None).cast("string").alias(c) for c in columns])


def read_papers_csv(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Clean papers of six or seven CSV columns in any order; without ``all_categories`` the primary
    category stands in for it."""
    df = read_csv(spark, path, PAPERS_CSV_SCHEMA.names, ("authors", "primary_category", "all_categories"), multi_line)
    return df.withColumn("all_categories", F.coalesce("all_categories", "primary_category"))


def topic_files(spark: SparkSession, path: str, suffix: str = "_quarterly_counts") -> tuple[DataFrame, DataFrame]:
    """A4: a folder of per-topic CSV files as (rows, outcomes).

    rows: (topic, period, count), the topic from the file's `topic=<stem>` folder or its own name.  Columns
    are found by each file's own header, in any order; files of one header are one split-able scan.
    outcomes: one row per file (``csv_files.outcomes``); `unreadable` files, those without ``period`` or
    ``count`` among them, give no rows, and n_rejected counts rows without a period or a numeric count."""
    from ..functions.text import slug_to_title
    asked = ["period", "count"]
    files = CF.catalogue(spark, path)
    number = F.round(F.col("count").try_cast("double")).cast("bigint")
    raw = CF.scan(spark, files, asked).select("path", "extra", F.nullif(F.trim("period"), F.lit("")).alias("period"),
                                              number.alias("count"))
    bad = F.col("period").isNull() | F.col("count").isNull()
    found = CF.outcomes(files, raw, asked, bad)
    stem = F.coalesce(F.nullif(F.regexp_extract("path", r"topic=([^/]+)/", 1), F.lit("")),
                      F.regexp_extract("path", r"([^/]+)\.csv$", 1))
    rows = CF.of_read_files(raw, found).where(~bad).select(slug_to_title(stem, suffix).alias("topic"), "period", "count")
    return rows, found


def read_topic_folder(spark: SparkSession, path: str, suffix: str = "_quarterly_counts") -> DataFrame:
    """A4: the rows of ``topic_files``."""
    return topic_files(spark, path, suffix)[0]


def category_files(spark: SparkSession, path: str, columns: list[str], date: str = "published_date") -> tuple[DataFrame, DataFrame]:
    """A5: a folder of `arxiv_X.csv` files as (rows, outcomes); the category X comes from the file's name.
    A file may be a folder of part files, as Spark writes it: a text with line breaks is one task a part.

    rows: category, ``columns`` (strings) and ``date`` as a timestamp; rows whose date cannot be read are
    dropped, as n_rejected of the outcomes says."""
    from ..functions.dates import parse_timestamp
    files = CF.catalogue(spark, path)
    raw = CF.scan(spark, files, [*columns, date]).withColumn(date, parse_timestamp(date))
    bad = F.col(date).isNull()
    found = CF.of_whole_files(CF.outcomes(files, raw, [*columns, date], bad))
    rows = CF.of_read_files(raw.withColumn("path", CF.whole_file("path")), found).where(~bad)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    return rows.select(CF.category_of(name).alias("category"), *columns, date), found
