"""Streaming group (S1 = A9 ingest, S2 period counts) driven by files split from ``events``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates as DT
from ..operators import aggregates as AG
from ..session import checkpoint_path
from ..sources.tables import table
from ..streaming import delta_log as DL
from ..streaming import ingest as IG
from ..streaming import ledger as LE
from ..streaming import period_counts as PC
from .registry import register

CHUNK_DAYS = 7


def _scratch(spark, name):
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _land_chunks(spark, sf, landing, first_chunk=None, last_chunk=None):
    """Write the asked weeks of ``events`` into the landing folder, one file a week, in one pass."""
    ev = table(spark, sf, "events")
    day0 = ev.agg(F.min(F.to_date("ts")).alias("d")).first()["d"]
    ev = ev.withColumn("_chunk", F.floor(F.datediff(F.to_date("ts"), F.lit(day0)) / CHUNK_DAYS).cast("int"))
    n_chunks = ev.agg(F.max("_chunk")).first()[0] + 1
    lo = first_chunk or 0
    hi = n_chunks if last_chunk is None else min(last_chunk, n_chunks)
    part = ev.where(F.col("_chunk").between(lo, hi - 1))
    part.repartitionByRange(max(hi - lo, 1), "_chunk").drop("_chunk").write.mode("append").parquet(landing)
    return ev.drop("_chunk").schema, n_chunks


@register("s1_incremental_ingest", """
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL""")
def s1_incremental_ingest(spark, sf):
    """Ingest the first two weeks, rerun (adds nothing), land the
    rest and rerun: the sink holds every good row exactly once."""
    landing, ck = _scratch(spark, "s1-landing"), _scratch(spark, "s1-ckpt")
    good, bad = _scratch(spark, "s1-good"), _scratch(spark, "s1-bad")
    rule = F.col("ts").isNotNull() & F.col("event_type").isNotNull()
    schema, _ = _land_chunks(spark, sf, landing, 0, 2)
    IG.ingest_available(spark, landing, schema, good, bad, ck, rule)
    IG.ingest_available(spark, landing, schema, good, bad, ck, rule)
    _land_chunks(spark, sf, landing, 2, None)
    IG.ingest_available(spark, landing, schema, good, bad, ck, rule)
    return IG.read_sink(spark, good, schema).select(*schema.fieldNames())


@register("s2_window_counts", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2""")
def s2_window_counts(spark, sf):
    """Day x event_type counts maintained by a watermarked streaming
    aggregate (update mode, changelog sink), read as the current table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, ck, log = _scratch(spark, "s2-landing"), _scratch(spark, "s2-ckpt"), _scratch(spark, "s2-log")
    schema, _ = _land_chunks(spark, sf, landing)
    PC.run_window_counts(spark, landing, schema, "ts", "event_type", "value", log, ck)
    cur = PC.current_counts(spark, log, "event_type")
    return cur.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                      F.col("n").cast("bigint").alias("n"), F.round("total_value", 6).alias("total_value"))


@register("s2_monthly_rollup", """
SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS period_start, event_type,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2""")
def s2_monthly_rollup(spark, sf):
    """S2 roll-up: the streamed day windows summed to calendar months."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, ck, log = _scratch(spark, "s2m-landing"), _scratch(spark, "s2m-ckpt"), _scratch(spark, "s2m-log")
    schema, _ = _land_chunks(spark, sf, landing)
    PC.run_window_counts(spark, landing, schema, "ts", "event_type", "value", log, ck)
    m = PC.roll_up(PC.current_counts(spark, log, "event_type"), "event_type")
    return m.select(F.col("period_start").cast("timestamp_ntz").alias("period_start"), "event_type",
                    F.col("n").cast("bigint").alias("n"), F.round("total_value", 6).alias("total_value"))


@register("a9_period_ledger", """WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS period, o_orderstatus <> 'P' AS ok FROM orders),
  b AS (SELECT year(min(o_orderdate)) AS y0, max(o_orderdate) AS last, min_by(strftime(o_orderdate, '%Y-%m'), o_orderkey) AS planted FROM orders),
  cal AS (SELECT strftime(month, '%Y-%m') AS period FROM (
    SELECT unnest(generate_series(make_date(y0, 1, 1), CAST(date_trunc('month', last) AS DATE), INTERVAL 1 MONTH)) AS month FROM b))
SELECT c.period, 'completed' AS status, CAST(CASE WHEN c.period = b.planted THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS n_good, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS n_bad,
       CAST(count(*) FILTER (WHERE ok) AS BIGINT) AS sink_good, CAST(count(*) FILTER (WHERE NOT ok) AS BIGINT) AS sink_bad,
       CAST(coalesce(sum(CASE WHEN ok THEN o_orderkey END), 0) AS BIGINT) AS key_sum
FROM cal c CROSS JOIN b LEFT JOIN o ON o.period = c.period GROUP BY c.period, b.planted""")
def a9_period_ledger(spark, sf):
    """Orders land by month, one month as a file that cannot be read; a first run completes the
    others and leaves it pending, a second run (the file is mended by then) completes it alone, a
    third has nothing to do.  Each period's entry, and what readers find of it through the ledger."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, base = _scratch(spark, "a9-landing"), _scratch(spark, "a9-ingest")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    b = orders.agg(F.min("o_orderdate"), F.max("o_orderdate"), F.min_by("o_orderdate", "o_orderkey")).first()
    planted = b[2].strftime("%Y-%m")
    label = DT.month_label("o_orderdate")
    orders.where(label != planted).withColumn("period", label).repartition("period").write.partitionBy("period").parquet(landing)
    spark.range(1).select(F.lit("not a table").alias("value")).write.text(f"{landing}/period={planted}")

    landed = {r[0] for r in orders.select(label).distinct().collect()}  # one for each month

    def read(month):
        period = month["month"].strftime("%Y-%m")
        if period not in landed:
            return spark.createDataFrame([], orders.schema)
        return spark.read.schema(orders.schema).parquet(f"{landing}/period={period}")

    calendar = AG.month_calendar(b[0].year, b[1].year, spark)
    as_of = F.lit(b[1].strftime("%Y-%m-01")).cast("date")
    rule = F.col("o_orderstatus") != "P"
    LE.ingest_periods(spark, base, calendar, as_of, read, rule, at_once=8)
    orders.where(label == planted).coalesce(1).write.mode("overwrite").parquet(f"{landing}/period={planted}")
    LE.ingest_periods(spark, base, calendar, as_of, read, rule, at_once=8)
    LE.ingest_periods(spark, base, calendar, as_of, read, rule, at_once=8)
    tried = LE.entries(spark, base).groupBy("period").agg(F.count(F.lit(1)).alias("attempts"))
    found = LE.read_ingested(spark, base, orders.schema).select("period", "o_orderkey", F.lit(True).alias("ok")).unionByName(
        LE.read_ingested(spark, base, orders.schema, good=False).select("period", "o_orderkey", F.lit(False).alias("ok")))
    sink = found.groupBy("period").agg(F.count_if("ok").alias("sink_good"), F.count_if(~F.col("ok")).alias("sink_bad"),
                                       F.sum(F.when(F.col("ok"), F.col("o_orderkey"))).alias("key_sum"))
    zero = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("sink_good", "sink_bad", "key_sum")]
    return (LE.completed(spark, base).join(tried, "period").join(sink, "period", "left")
            .select("period", "status", "attempts", "n_good", "n_bad", *zero))


@register("s2_compacted_counts", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2""")
def s2_compacted_counts(spark, sf):
    """S2 with compaction: the weeks come in four runs; after each one all batches but the newest are
    merged into a snapshot and removed.  The counts are those of all events."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, ck, log = _scratch(spark, "s2c-landing"), _scratch(spark, "s2c-ckpt"), _scratch(spark, "s2c-log")
    ev = table(spark, sf, "events")
    weeks = ev.agg(F.datediff(F.to_date(F.max("ts")), F.to_date(F.min("ts")))).first()[0] // CHUNK_DAYS + 1
    cuts = sorted({weeks * k // 4 for k in range(5)})
    for lo, hi in zip(cuts, cuts[1:]):
        schema, _ = _land_chunks(spark, sf, landing, lo, hi)
        PC.run_window_counts(spark, landing, schema, "ts", "event_type", "value", log, ck)
        DL.compact(spark, log, PC.window_merge("event_type"))
        DL.vacuum(spark, log)
    cur = PC.current_counts(spark, log, "event_type")
    return cur.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                      F.col("n").cast("bigint").alias("n"), F.round("total_value", 6).alias("total_value"))


LATE_EVERY = 50  # of the first two weeks, every 50th event lands after all others


@register("s2_late_corrections", f"""WITH b AS (SELECT CAST(min(ts) AS DATE) AS d0 FROM events),
  e AS (SELECT *, CAST(ts AS DATE) - d0 < {2 * CHUNK_DAYS} AND event_id % {LATE_EVERY} = 0 AS late FROM events, b)
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n,
       round(sum(value), 6) AS total_value, CAST(count(*) FILTER (WHERE late) AS BIGINT) AS n_late,
       round(coalesce(sum(value) FILTER (WHERE late), 0), 6) AS late_value
FROM e GROUP BY 1, 2""")
def s2_late_corrections(spark, sf):
    """S2 with late rows: every 50th event of the first two weeks lands after all others, when its day
    has long been closed; the counts hold every event, and tell how much came as corrections."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    landing, ck, base = _scratch(spark, "s2l-landing"), _scratch(spark, "s2l-ckpt"), _scratch(spark, "s2l-base")
    ev = table(spark, sf, "events")
    day0 = ev.agg(F.min(F.to_date("ts"))).first()[0]
    held = (F.datediff(F.to_date("ts"), F.lit(day0)) < 2 * CHUNK_DAYS) & (F.col("event_id") % LATE_EVERY == 0)
    for rows in (ev.where(~held), ev.where(held)):
        rows.write.mode("append").parquet(landing)
        PC.run_day_counts(spark, landing, ev.schema, "ts", "event_type", "value", base, ck)
        DL.compact(spark, f"{base}/counts", PC.day_merge("event_type"))
    cur = PC.day_counts(spark, base, "event_type")
    return cur.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type",
                      F.col("n").cast("bigint").alias("n"), F.round("total_value", 6).alias("total_value"),
                      F.col("n_late").cast("bigint").alias("n_late"), F.round("late_value", 6).alias("late_value"))
