"""A table kept as a snapshot and the micro-batches since.

Every micro-batch writes its rows to `batch_id=<n>` below the log, with overwrite, so a replayed
batch replaces itself.  ``compact`` merges the snapshot and all batches below a frontier into a new
snapshot and then enters (frontier, snapshot) into the manifest; that entry, one small file moved
into place, is the swap.  Readers take the entry with the largest frontier and the batches from it
on, so they read one snapshot and the open batches, however long the history, and a compaction that
breaks off leaves files that no entry names.  Two that run at once both leave right entries.
``vacuum`` removes what no reader needs any more.

How rows of one key merge is the caller's: ``latest`` keeps the newest version of a row, ``summed``
adds up increments.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame], DataFrame]
#: Spark's listings skip names that begin with an underscore, so these lie below the log itself.
_SNAPSHOTS, _MANIFEST = "_snapshots", "_manifest"
_ENTRY = "frontier long, snapshot string, at timestamp"


def latest(keys: Sequence[str], values: Sequence[str]) -> Merge:
    """Of each key the values of the newest batch."""
    def merge(rows: DataFrame) -> DataFrame:
        newest = F.max_by(F.struct(*values, "batch_id"), "batch_id").alias("_v")
        return rows.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in (*values, "batch_id")])
    return merge


def summed(keys: Sequence[str], values: Sequence[str]) -> Merge:
    """The sums of each key's values, and the newest batch that added to it."""
    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values], F.max("batch_id").alias("batch_id"))
    return merge


def append(batch: DataFrame, log: str, batch_id: int) -> None:
    """Write one micro-batch (again)."""
    batch.drop("batch_id").write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def manifest(spark: SparkSession, log: str) -> tuple[int, str] | None:
    """(frontier, snapshot) that readers use; None before the first compaction."""
    try:
        found = spark.read.schema(_ENTRY).option("recursiveFileLookup", True).parquet(f"{log}/{_MANIFEST}")
        r = found.orderBy(F.desc("frontier"), F.desc("at"), "snapshot").first()
    except AnalysisException as e:
        if not _missing(e):
            raise
        return None
    return (r["frontier"], r["snapshot"]) if r else None


def _batches(spark: SparkSession, log: str) -> DataFrame:
    """All batches that are there; the batch number comes from the folder, so a bound on it prunes files."""
    df = spark.read.parquet(log)
    return df.withColumn("batch_id", F.col("batch_id").cast("long"))


def parts(spark: SparkSession, log: str) -> list[DataFrame]:
    """What a reader reads: the open batches, and the snapshot if there is one."""
    entry = manifest(spark, log)
    if entry is None:
        return [_batches(spark, log)]
    frontier, snapshot = entry
    open_batches = _batches(spark, log).where(F.col("batch_id") >= frontier)
    columns = open_batches.columns
    return [open_batches, spark.read.schema(open_batches.schema).parquet(f"{log}/{_SNAPSHOTS}/{snapshot}").select(*columns)]


def read(spark: SparkSession, log: str, merge: Merge, as_of: int | None = None) -> DataFrame:
    """The table now, or as of a batch not older than the last compaction (all batches up to ``as_of``)."""
    found = parts(spark, log)
    if as_of is not None:
        entry = manifest(spark, log)
        if entry and as_of < entry[0] - 1:
            raise ValueError(f"batches up to {entry[0] - 1} are merged; {as_of} can no longer be told apart")
        found = [p.where(F.col("batch_id") <= as_of) for p in found]
    rows = found[0]
    for p in found[1:]:
        rows = rows.unionByName(p)
    return merge(rows)


def compact(spark: SparkSession, log: str, merge: Merge, keep_open: int = 1) -> int | None:
    """Merge all batches but the newest ``keep_open``; the new frontier, or None if there is nothing to merge.

    The newest batch may still be replayed by its stream, so at least one should stay open."""
    entry = manifest(spark, log)
    newest = _batches(spark, log).agg(F.max("batch_id")).first()[0]
    if newest is None or newest + 1 - keep_open <= (entry[0] if entry else 0):
        return None
    frontier = newest + 1 - keep_open
    found = parts(spark, log)
    rows = found[0].where(F.col("batch_id") < frontier)
    for p in found[1:]:
        rows = rows.unionByName(p)
    snapshot = uuid.uuid4().hex
    merge(rows).select(*found[0].columns).write.parquet(f"{log}/{_SNAPSHOTS}/{snapshot}")
    row = spark.createDataFrame([(frontier, snapshot, None)], _ENTRY).withColumn("at", F.current_timestamp())
    row.coalesce(1).write.parquet(f"{log}/{_MANIFEST}/{snapshot}")
    return frontier


def vacuum(spark: SparkSession, log: str) -> list[str]:
    """Delete the batches and snapshots that the newest manifest entry replaces; their names.

    Call it when no reader that began before the last compaction is still at work."""
    entry = manifest(spark, log)
    if entry is None:
        return []
    frontier, snapshot = entry
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(log).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for f in fs.listStatus(path(log)):
        name = f.getPath().getName()
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) < frontier:
            # the newest merged batch stays while it is the only one: a log keeps its columns
            gone.append(name)
    if len(gone) and not any(f.getPath().getName().startswith("batch_id=") and f.getPath().getName() not in gone
                             for f in fs.listStatus(path(log))):
        gone.remove(max(gone, key=lambda n: int(n.removeprefix("batch_id="))))
    for folder in (_SNAPSHOTS, _MANIFEST):
        gone += [f"{folder}/{f.getPath().getName()}" for f in fs.listStatus(path(f"{log}/{folder}"))
                 if f.getPath().getName() != snapshot]
    for name in gone:
        fs.delete(path(f"{log}/{name}"), True)
    return gone
