import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from lexitrend.llm import warc_bundle as W
from lexitrend.session import checkpoint_path

PAGES = "page_id long, url string, html string, payload string, bundle int"


def build(spark, rows):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGES)
    index = W.write_archives(pages, checkpoint_path(spark, f"warc-{uuid.uuid4().hex}"))
    return index, W.read_archives(index).collect()


def test_round_trip_with_revisits(spark, monkeypatch):
    monkeypatch.setattr(W, "FRAME_BYTES", 4000)
    monkeypatch.setattr(W, "BUNDLE_BYTES", 3000)
    same, other = "é<p>" * 60, "WARC/1.1\r\n\r\n" * 20
    rows = [(5, "u", same), (3, "u\r\nX: y", same), (9, None, same), (1, "a", "short"), (2, "b", "short"), (7, "c", None),
            (8, "d", ""), (None, "e", same), (4, "f", other), (6, "g", "x" * 300_000), (3, "again", same)]
    rows += [(100 + k, "h", f"{k}" * 500) for k in range(40)]
    index, got = build(spark, rows)
    body = lambda h: (h or "").encode()
    want = []
    for p, _, h in rows:
        b = body(h)
        revisit = h == same and p is not None and p > 3
        want.append((str(p), len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None))
    assert sorted(map(str, want)) == sorted(str((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got)
    texts = {(str(p), body(h)) for p, _, h in rows}
    assert all((str(r.page_id), bytes(r.payload)) in texts for r in got if r.record_type == "response")
    for r in index.collect():  # every index row alone leads to its record
        head, _ = W.read_record(r.bundle, r.frame_start, r.frame_bytes, r.record_start)
        assert head["WARC-Record-ID"] == r.record_id
    assert index.count() == len(rows) and index.select("bundle").distinct().count() > 1


@pytest.mark.parametrize("bundles", [2, 4, 7])
def test_one_task_reads_one_bundle(spark, monkeypatch, bundles):
    """Fewer bundles than shuffle partitions, as many, and more."""
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4
    rows = spark.range(bundles * 30).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                            F.concat(F.lit("<p>"), F.sha2(F.col("id").cast("string"), 512)).alias("html"))
    index = W.write_archives(rows.repartitionByRange(bundles, "page_id"), checkpoint_path(spark, f"warc-{uuid.uuid4().hex}"))
    assert index.select("bundle").distinct().count() == bundles
    read = W.read_archives(index).withColumn("task", F.spark_partition_id())
    of = index.select("record_id", "bundle")
    tasks = read.join(of, "record_id").groupBy("bundle").agg(F.count_distinct("task").alias("t"), F.max("task").alias("task")).collect()
    assert [r.t for r in tasks] == [1] * bundles and len({r.task for r in tasks}) == bundles
    assert read.count() == bundles * 30
    monkeypatch.setattr(W, "MOST_TASKS", 2)
    assert W.read_archives(index).count() == bundles * 30


def test_empty_table(spark):
    index, got = build(spark, [])
    assert got == [] and index.count() == 0


def test_sql(spark):
    import duckdb

    from tools.check_oracle import digest
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    res = con.execute(W.ORACLE)
    cols = [d[0] for d in res.description]
    df = W.op4(spark, sf)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, res.fetchall())[0]
