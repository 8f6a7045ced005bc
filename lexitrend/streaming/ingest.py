"""Resumable incremental ingest of a landing folder.

A file-source stream with ``trigger(availableNow=True)`` and a checkpoint
location: every run appends only files it has not seen, a failed batch is
retried from the checkpoint, and running twice over the same files adds
nothing.  Bad rows go to a side table; both sinks are written per batch id
with overwrite, so a replayed batch rewrites its own folder (idempotent).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: A file counts as new however old it is against the newest one seen (the default ignores it after a week).
FOREVER = "36500d"


def ingest_available(spark: SparkSession, landing: str, schema: StructType, good_path: str, bad_path: str,
                     checkpoint: str, is_good: Column, fmt: str = "parquet",
                     max_files_per_trigger: int | None = None) -> int:
    """Process every new file under ``landing`` and stop; returns the number
    of micro-batches run."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFileAge", FOREVER)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(landing)
    batches = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        flagged = batch.withColumn("_good", F.coalesce(is_good, F.lit(False))).persist()  # read by both sinks
        (flagged.where("_good").drop("_good").write.mode("overwrite")
         .parquet(f"{good_path}/batch_id={batch_id}"))
        (flagged.where(~F.col("_good")).drop("_good").write.mode("overwrite")
         .parquet(f"{bad_path}/batch_id={batch_id}"))
        flagged.unpersist()
        batches.append(batch_id)

    q = (src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(batches)


def read_sink(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Everything ingested so far (empty frame before the first batch)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)  # no batch written yet
