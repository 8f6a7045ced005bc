"""The ledger of completed periods.  S2: the delta log, its compaction, and corrections by late rows."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import aggregates as AG
from lexitrend.session import checkpoint_path
from lexitrend.streaming import delta_log as DL
from lexitrend.streaming import ledger as LE
from lexitrend.streaming import period_counts as PC

ROWS = "id long, ok boolean"


@pytest.fixture
def base(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return checkpoint_path(spark, f"test-{uuid.uuid4().hex}")


def months(spark):
    return AG.month_calendar(2023, 2023, spark)


def run(spark, base, read, as_of="2023-06-01"):
    return LE.ingest_periods(spark, base, months(spark), F.lit(as_of).cast("date"), read, F.col("ok"), at_once=3)


def test_failed_period_is_not_marked_and_is_retried(spark, base):
    fail = {4}

    def read(m):
        k = m["month"].month
        df = spark.createDataFrame([(100 * k + i, i % 3 > 0) for i in range(k)], ROWS)
        # the failure comes while the rows are written
        return df.withColumn("id", F.when(F.lit(k in fail), F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))

    got = run(spark, base, read)
    assert got == {f"2023-0{k}": "failed" if k == 4 else "completed" for k in range(1, 7)}
    schema = spark.createDataFrame([], ROWS).schema
    assert "2023-04" not in {r["period"] for r in LE.read_ingested(spark, base, schema).collect()}
    assert [r["month"].month for r in LE.pending(spark, base, months(spark), F.lit("2023-06-01").cast("date")).collect()] == [4]
    fail.clear()
    assert run(spark, base, read) == {"2023-04": "completed"}
    assert run(spark, base, read) == {}
    assert run(spark, base, read, "2023-07-01") == {"2023-07": "completed"}
    good = LE.read_ingested(spark, base, schema).collect()
    bad = LE.read_ingested(spark, base, schema, good=False).collect()
    assert sorted(r["id"] for r in [*good, *bad]) == sorted(100 * k + i for k in range(1, 8) for i in range(k))
    done = {r["period"]: (r["n_good"], r["n_bad"]) for r in LE.completed(spark, base).collect()}
    assert done["2023-01"] == (0, 1) and done["2023-07"] == (4, 3)
    failed = LE.entries(spark, base).where("status = 'failed'").collect()
    assert [r["period"] for r in failed] == ["2023-04"] and "broken" in failed[0]["error"]


def test_two_runs_at_once_count_a_period_once(spark, base):
    read = lambda m: spark.createDataFrame([(1, True)], ROWS)
    run(spark, base, read, "2023-01-01")
    e = LE.completed(spark, base).first()
    data = spark.read.parquet(f"{base}/data/{e['batch']}")
    data.write.partitionBy("_ok").parquet(f"{base}/data/second")
    LE._enter(spark, base, "2023-01", "completed", "second", 1, 0, None)
    assert LE.entries(spark, base).count() == 2
    schema = spark.createDataFrame([], ROWS).schema
    assert LE.read_ingested(spark, base, schema).count() == 1
    assert LE.completed(spark, base).first()["batch"] == e["batch"]


def test_files_without_an_entry_are_not_seen(spark, base):
    read = lambda m: spark.createDataFrame([(1, True)], ROWS)
    run(spark, base, read, "2023-01-01")
    spark.createDataFrame([(9, True)], ROWS).withColumn("_period", F.lit("2023-02")).withColumn("_ok", F.lit(True)) \
        .write.partitionBy("_ok").parquet(f"{base}/data/orphan")  # a run that died before its entry
    schema = spark.createDataFrame([], ROWS).schema
    assert [r["id"] for r in LE.read_ingested(spark, base, schema).collect()] == [1]


def batch(spark, rows):
    return spark.createDataFrame(rows, "k string, v long")


@pytest.mark.parametrize("kind", ["latest", "summed"])
def test_compaction_changes_nothing(spark, base, kind):
    merge = getattr(DL, kind)(["k"], ["v"])
    want = {}
    for n in range(7):
        rows = [(f"k{i}", n * 10 + i) for i in range(n % 4 + 1)]
        for k, v in rows:
            want[k] = v + (want.get(k, 0) if kind == "summed" else 0)
        DL.append(batch(spark, rows), base, n)
        if n in (2, 5):
            assert DL.compact(spark, base, merge) == n
        assert {r["k"]: r["v"] for r in DL.read(spark, base, merge).collect()} == want
    DL.append(batch(spark, rows), base, 6)  # a replay of the newest batch
    assert {r["k"]: r["v"] for r in DL.read(spark, base, merge).collect()} == want
    assert len(DL.vacuum(spark, base)) == 5 + 2  # batches 0 to 4, the first snapshot and its entry
    assert {r["k"]: r["v"] for r in DL.read(spark, base, merge).collect()} == want
    assert DL.compact(spark, base, merge) == 6 and DL.compact(spark, base, merge) is None


def test_readers_open_only_what_is_new(spark, base):
    merge = DL.summed(["k"], ["v"])
    for n in range(30):
        DL.append(batch(spark, [("a", 1)]).coalesce(1), base, n)
    assert len(DL.parts(spark, base)[0].inputFiles()) == 30
    DL.compact(spark, base, merge, keep_open=2)
    files = [f for p in DL.parts(spark, base) for f in p.where("batch_id >= 0").inputFiles()]
    plan = DL.read(spark, base, merge)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len([f for f in files if "_snapshots" in f]) >= 1
    assert DL.parts(spark, base)[0].select("batch_id").distinct().count() == 2
    assert DL.read(spark, base, merge).first()["v"] == 30


def test_broken_compaction_is_not_seen(spark, base):
    merge = DL.summed(["k"], ["v"])
    for n in range(3):
        DL.append(batch(spark, [("a", 1)]), base, n)
    merge(DL._batches(spark, base)).write.parquet(f"{base}/_snapshots/broken")  # no manifest entry
    assert DL.read(spark, base, merge).first()["v"] == 3
    assert DL.read(spark, base, merge, as_of=1).first()["v"] == 2
    DL.compact(spark, base, merge)
    with pytest.raises(ValueError):
        DL.read(spark, base, merge, as_of=0)


def test_late_rows_become_corrections(spark, base):
    schema = "ts timestamp_ntz, kind string, value double"

    def land(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/landing")

    def step():
        df = spark.createDataFrame([], schema)
        return PC.run_day_counts(spark, f"{base}/landing", df.schema, "ts", "kind", "value", base, f"{base}/ck")

    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    land([(day(1, 5), "a", 1.0), (day(3, 1), "a", 2.0), (None, "a", 9.0)])
    assert step() == 1
    land([(day(1, 6), "a", 4.0), (day(2, 6), "b", None), (day(2, 23), "a", 1.5)])  # closed before: day 1 alone
    assert step() == 1 and step() == 0
    got = {(r["window_start"].day, r["kind"]): (r["n"], r["total_value"], r["n_late"], r["late_value"])
           for r in PC.day_counts(spark, base, "kind").collect()}
    assert got == {(1, "a"): (2, 5.0, 1, 4.0), (3, "a"): (1, 2.0, 0, 0.0), (2, "b"): (1, None, 0, 0.0), (2, "a"): (1, 1.5, 0, 0.0)}
    assert [(r["ts"].day, r["batch_id"]) for r in PC.late_rows(spark, base).collect()] == [(1, 1)]
    before = {(r["window_start"].day, r["kind"]): r["n"] for r in PC.day_counts(spark, base, "kind", as_of=0).collect()}
    assert before == {(1, "a"): 1, (3, "a"): 1}
    assert spark.read.parquet(f"{base}/unplaced").count() == 1


def test_dropped_rows_are_all_counted(spark, base):
    """More batches than a query keeps progress reports of."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    schema = "ts timestamp_ntz, kind string, value double"
    old = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        for d in (10, 20, 1, 2, 3):  # the last three are too late
            spark.createDataFrame([(dt.datetime(2024, 1, d), "a", 1.0)], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        late = PC.run_window_counts(spark, f"{base}/in", spark.createDataFrame([], schema).schema, "ts", "kind", "value",
                                    f"{base}/log", f"{base}/ck", max_files_per_trigger=1)
        assert late == 3
    finally:
        spark.conf.set(key, old)
