"""S1 ingest twice = once; S2 streamed day counts = batch counts."""

from pyspark.sql import functions as F

from lexitrend.plans import q_streaming as QS
from lexitrend.sources.tables import table

from .conftest import SF_SMALL


def test_ingest_exactly_once(spark):
    out = QS.s1_incremental_ingest(spark, SF_SMALL)
    ev = table(spark, SF_SMALL, "events")
    assert out.count() == ev.count()
    assert out.select("event_id").distinct().count() == ev.count()


def test_window_counts_match_batch(spark):
    got = {(r.window_start, r.event_type): r.n for r in QS.s2_window_counts(spark, SF_SMALL).collect()}
    ev = table(spark, SF_SMALL, "events")
    exp = {(r.d, r.event_type): r.n for r in
           ev.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("d"), "event_type").agg(F.count("*").alias("n")).collect()}
    assert got == exp


def test_out_of_order_within_watermark_is_counted(spark):
    """Spark's guarantee: events later than the watermark delay may be
    dropped, events within it never are (here: 12 h out of order, 1 day delay)."""
    import datetime as dt

    from lexitrend.session import checkpoint_path
    from lexitrend.streaming import period_counts as PC

    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = checkpoint_path(spark, "test-watermark")
    schema = "ts timestamp_ntz, kind string, value double"
    first = spark.createDataFrame([(dt.datetime(2024, 1, 10, h), "a", 1.0) for h in range(3)], schema)
    second = spark.createDataFrame([(dt.datetime(2024, 1, 9, 15), "a", 2.0), (dt.datetime(2024, 1, 10, 9), "a", 1.0)], schema)
    first.coalesce(1).write.mode("append").parquet(f"{base}/landing")
    second.coalesce(1).write.mode("append").parquet(f"{base}/landing")
    PC.run_window_counts(spark, f"{base}/landing", first.schema, "ts", "kind", "value",
                         f"{base}/log", f"{base}/ckpt", watermark="1 day", max_files_per_trigger=1)
    got = {r.window_start.day: (r.n, r.total_value) for r in PC.current_counts(spark, f"{base}/log", "kind").collect()}
    assert got == {9: (1, 2.0), 10: (4, 4.0)}
    months = PC.roll_up(PC.current_counts(spark, f"{base}/log", "kind"), "kind").collect()
    assert [(r.n, r.total_value) for r in months] == [(5, 6.0)]


def test_ingest_bad_rows_side_table_and_rerun(spark):
    import datetime as dt

    from lexitrend.session import checkpoint_path
    from lexitrend.streaming import ingest as IG

    base = checkpoint_path(spark, "test-ingest-bad")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "view"), (2, None, "view"), (3, dt.datetime(2024, 1, 2), None)],
                               "event_id long, ts timestamp_ntz, event_type string")
    df.coalesce(1).write.parquet(f"{base}/landing")
    rule = F.col("ts").isNotNull() & F.col("event_type").isNotNull()
    for _ in range(2):
        IG.ingest_available(spark, f"{base}/landing", df.schema, f"{base}/good", f"{base}/bad", f"{base}/ck", rule)
    good = sorted(r.event_id for r in IG.read_sink(spark, f"{base}/good", df.schema).collect())
    bad = sorted(r.event_id for r in IG.read_sink(spark, f"{base}/bad", df.schema).collect())
    assert (good, bad) == ([1], [2, 3])
