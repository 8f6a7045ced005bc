"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_path

#: Rows per Arrow batch: bounds a Python worker's memory when texts are long.
BATCH_ROWS = 256


def ready(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Before Python runs in tasks: keep Arrow batches to ``rows`` rows (texts may be very long)
    unless the session asks for fewer; functions of this package travel with the tasks, so that
    executors need no copy of it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    cloudpickle.register_pickle_by_value(sys.modules[__package__])


_made: list[str] | None = None


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back:
    the lineage ends there, and a lost executor costs nothing but a reread.  What is written inside
    ``scratch`` is removed at its end."""
    path = checkpoint_path(spark, f"llm-{name}-{uuid.uuid4().hex}")
    if _made is not None:
        _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, whatever file system holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession):
    """Folders that ``written`` makes in here are removed at the end; a result that reads them is to be
    written elsewhere before that."""
    global _made
    outer, _made = _made, []
    try:
        yield
    finally:
        mine, _made = _made, outer
        for path in mine:
            remove(spark, path)


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The UTF-8 bytes of a string column; null reads as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def schema(first: tuple[str, T.DataType], rest: str) -> T.StructType:
    """A schema of one column of a given type and further ones in DDL."""
    return T.StructType([T.StructField(*first), *T.StructType.fromDDL(rest).fields])


def whole_row(df: DataFrame) -> Column:
    """All columns of a row as one struct named ``row``: functions carry it along unread."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a string's UTF-8 bytes: bit by bit, the polynomial reversed."""
    hexed = f"hex({text})"
    octets = f"list_transform(range(1, length({hexed}) + 1, 2), lambda i: CAST('0x' || substr({hexed}, i, 2) AS BIGINT))"
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a % 2) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: {bits}), 4294967295)"
