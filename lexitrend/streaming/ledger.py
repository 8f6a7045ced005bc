"""Ingest period by period, with a ledger of the completed ones.

A period is read, split into good and bad rows, and written under a fresh batch name in one job;
only then does an entry (period, status, batch, row counts) go into the ledger.  What the ledger
does not name as completed does not exist: readers take batches from it alone, so the files of a
failed or killed attempt are never seen, and its period stays pending and is taken up again by
the next run.  Of two runs that complete one period, the earlier entry counts.

Every entry is a folder of its own holding one small Parquet file, which the commit of the write
moves into place as a whole; runs never rewrite each other's entries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..operators import aggregates as AG

ENTRY = "period string, status string, batch string, n_good long, n_bad long, error string, at timestamp"
#: Characters of an error that its entry keeps.
ERROR_CHARS = 500


def _enter(spark: SparkSession, base: str, period: str, status: str, batch: str, n_good: int, n_bad: int,
           error: str | None) -> None:
    row = spark.createDataFrame([(period, status, batch, n_good, n_bad, error, None)], ENTRY)
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.parquet(f"{base}/ledger/{batch}")


def entries(spark: SparkSession, base: str) -> DataFrame:
    """All entries, failed attempts included (none before the first run)."""
    try:
        return spark.read.schema(ENTRY).option("recursiveFileLookup", True).parquet(f"{base}/ledger")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRY)


def completed(spark: SparkSession, base: str) -> DataFrame:
    """The one entry of each completed period that counts: the earliest, whatever came later."""
    first = F.row_number().over(W.partitionBy("period").orderBy("at", "batch"))
    return (entries(spark, base).where(F.col("status") == "completed")
            .withColumn("_k", first).where("_k = 1").drop("_k"))


def pending(spark: SparkSession, base: str, calendar: DataFrame, as_of) -> DataFrame:
    """A10 on the ledger: months of the calendar, not after ``as_of``, without a completed entry."""
    done = completed(spark, base).select(F.to_date("period", "yyyy-MM").alias("month"))
    return AG.pending_periods(calendar, as_of, done)


def ingest_periods(spark: SparkSession, base: str, calendar: DataFrame, as_of, read: Callable[[Row], DataFrame],
                   is_good: Column, at_once: int = 4) -> dict[str, str]:
    """Ingest every pending month of the calendar (A10: month, start_date, end_date); {period: status}.

    ``read`` gives the rows of one calendar row's month, all with the same columns.  A month whose
    reading or writing fails gets a `failed` entry with the error and stays pending; the others go
    on, ``at_once`` side by side.  A month without rows is completed too."""
    def one(month: Row) -> tuple[str, str]:
        period, batch = month["month"].strftime("%Y-%m"), uuid.uuid4().hex
        try:
            seen = Observation()
            ok = F.coalesce(is_good, F.lit(False))
            rows = read(month).withColumn("_ok", ok).observe(
                seen, F.count_if("_ok").alias("good"), F.count_if(~F.col("_ok")).alias("bad"))
            rows.withColumn("_period", F.lit(period)).write.partitionBy("_ok").parquet(f"{base}/data/{batch}")
            n = seen.get
            _enter(spark, base, period, "completed", batch, n["good"], n["bad"], None)
            return period, "completed"
        except Exception as e:  # noqa: BLE001 - one period's failure is its own
            _enter(spark, base, period, "failed", batch, 0, 0, f"{type(e).__name__}: {e}"[:ERROR_CHARS])
            return period, "failed"

    months = sorted(pending(spark, base, calendar, as_of).collect(), key=lambda r: r["month"])  # bounded: a calendar
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return dict(pool.map(one, months))


def read_ingested(spark: SparkSession, base: str, schema: T.StructType, good: bool = True) -> DataFrame:
    """The good (or bad) rows of all completed periods, with their ``period``."""
    rows = F.col("n_good" if good else "n_bad") > 0
    paths = [f"{base}/data/{r['batch']}/_ok={str(good).lower()}"
             for r in completed(spark, base).where(rows).select("batch").collect()]  # bounded: one for a period
    full = T.StructType([*schema.fields, T.StructField("_period", T.StringType())])
    df = spark.read.schema(full).parquet(*paths) if paths else spark.createDataFrame([], full)
    return df.withColumnRenamed("_period", "period")
