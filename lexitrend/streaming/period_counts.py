"""Period counts kept current from a stream.

Two forms.  ``run_window_counts`` is a watermarked streaming aggregate in update mode: each
micro-batch's changed rows go to the log, the newest version of each (window, key) counts, and rows
later than the watermark are dropped by Spark and reported.  ``run_day_counts`` loses none: each
micro-batch is counted by itself, without state, its counts go to the log as increments, and rows
of days that an earlier batch had closed also go to a late table and are marked as corrections.
Both logs are compacted by ``delta_log``.  Calendar months are not fixed-length windows, so months
roll up from days.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from . import delta_log as DL
from .ingest import FOREVER

#: Seconds to wait for the last events of a query that has ended.
_EVENTS_S = 60


class _LateRows(StreamingQueryListener):
    """Rows dropped by the watermark, over all progress events of one query, by its name."""

    def __init__(self, name: str):
        self.name, self.run, self.rows, self.ended = name, None, 0, threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event):
        if event.progress.runId == self.run:
            self.rows += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()


def _source(spark: SparkSession, landing: str, schema: StructType, ts_col: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet").option("maxFileAge", FOREVER)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # event time must be TIMESTAMP (zoned); timestamp_ntz is read in the session zone
    return reader.load(landing).withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def run_window_counts(spark: SparkSession, landing: str, schema: StructType, ts_col: str, key: str,
                      value: str, changelog: str, checkpoint: str, window: str = "1 day",
                      watermark: str = "1 day", max_files_per_trigger: int | None = None) -> int:
    """Process every new file and stop; returns the rows that came later than the watermark allows
    (they are not counted, so a caller should look at this number; ``run_day_counts`` counts them)."""
    src = _source(spark, landing, schema, ts_col, max_files_per_trigger)
    agg = (src.withWatermark(ts_col, watermark)
           .groupBy(F.window(ts_col, window).alias("w"), F.col(key))
           .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total_value")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        DL.append(batch.select(F.col("w.start").alias("window_start"), key, "n", "total_value"), changelog, batch_id)

    late = _LateRows(f"window-counts-{uuid.uuid4().hex}")
    spark.streams.addListener(late)
    try:
        q = (agg.writeStream.queryName(late.name).outputMode("update").foreachBatch(sink)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        late.ended.wait(_EVENTS_S)  # events come in order, after the fact
    finally:
        spark.streams.removeListener(late)
    return late.rows


def window_merge(key: str) -> DL.Merge:
    """How the rows of ``run_window_counts`` merge: the newest version of a window."""
    return DL.latest(["window_start", key], ["n", "total_value"])


def current_counts(spark: SparkSession, changelog: str, key: str) -> DataFrame:
    """Latest version of every (window, key): the log's snapshot and its open batches."""
    return DL.read(spark, changelog, window_merge(key)).select("window_start", key, "n", "total_value")


def roll_up(days: DataFrame, key: str, unit: str = "month") -> DataFrame:
    """Day windows -> calendar periods (month by default)."""
    return (days.groupBy(F.date_trunc(unit, "window_start").alias("period_start"), key)
            .agg(F.sum("n").alias("n"), F.sum("total_value").alias("total_value")))


def day_merge(key: str) -> DL.Merge:
    """How the rows of ``run_day_counts`` merge: increments add up, corrections are told apart."""
    return DL.summed(["window_start", key], ["n", "total_value", "n_late", "late_value"])


def closed_before(spark: SparkSession, base: str, batch_id: int):
    """The first instant that is still open for batch ``batch_id``: days before it were closed by earlier
    batches (None before the first)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path(f"{base}/frontier")):
        return None
    log = spark.read.schema("closed timestamp, batch_id long").parquet(f"{base}/frontier")
    return log.where(F.col("batch_id") < batch_id).agg(F.max("closed")).first()[0]


def run_day_counts(spark: SparkSession, landing: str, schema: StructType, ts_col: str, key: str, value: str,
                   base: str, checkpoint: str, delay: str = "1 day", max_files_per_trigger: int | None = None) -> int:
    """Process every new file and stop; returns the number of micro-batches.

    A batch closes the days that end ``delay`` or more before its newest event; the frontier is kept by
    batch under ``base``, so a replayed batch meets the days that earlier ones closed and nothing else.
    Below ``base``: `counts`, the log of increments (n and total_value of all rows, n_late and late_value
    of those of closed days); `late`, the late rows themselves; `unplaced`, rows without a time."""
    src = _source(spark, landing, schema, ts_col, max_files_per_trigger)
    done = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        closed = closed_before(spark, base, batch_id)
        day = F.date_trunc("day", ts_col)
        late = F.coalesce(day < F.lit(closed), F.lit(False)) if closed is not None else F.lit(False)
        rows = batch.withColumn("window_start", day).withColumn("_late", late).persist()  # read four times
        placed = rows.where(F.col("window_start").isNotNull())
        placed.where("_late").drop("_late").write.mode("overwrite").parquet(f"{base}/late/batch_id={batch_id}")
        rows.where(F.col("window_start").isNull()).drop("_late").write.mode("overwrite").parquet(f"{base}/unplaced/batch_id={batch_id}")
        if_late = F.when(F.col("_late"), F.col(value)).otherwise(F.lit(0).cast(rows.schema[value].dataType))
        DL.append(placed.groupBy("window_start", key).agg(
            F.count(F.lit(1)).alias("n"), F.sum(value).alias("total_value"),
            F.count_if("_late").alias("n_late"), F.sum(if_late).alias("late_value")), f"{base}/counts", batch_id)
        # last: a batch that breaks off before has closed nothing
        newest = F.date_trunc("day", F.max(ts_col) - F.expr(f"INTERVAL {delay}"))
        (placed.agg(newest.alias("closed")).select(F.greatest("closed", F.lit(closed).cast("timestamp")).alias("closed"))
         .coalesce(1).write.mode("overwrite").parquet(f"{base}/frontier/batch_id={batch_id}"))
        rows.unpersist()
        done.append(batch_id)

    q = (src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(done)


def day_counts(spark: SparkSession, base: str, key: str, as_of: int | None = None) -> DataFrame:
    """(window_start, key, n, total_value, n_late, late_value, batch_id) now, or as of a batch: what a closed
    day showed then and what corrections have added since can both be read."""
    return DL.read(spark, f"{base}/counts", day_merge(key), as_of)


def late_rows(spark: SparkSession, base: str) -> DataFrame:
    """All rows that came after their day was closed, with the batch that brought them."""
    return spark.read.parquet(f"{base}/late")
