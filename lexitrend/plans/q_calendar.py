"""Calendar group: dated records and period series."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as DT
from ..operators import aggregates as AG
from ..operators import ranking as RK
from ..operators import trends as T
from ..sources.tables import table
from . import standins as S
from .registry import register


def r6(c):
    return F.round(c, 6)


def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


MONTHLY_SQL = S.with_ctes("""m AS (
  SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month, count(*) AS count
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1)""", """cal AS (
  SELECT CAST(unnest(generate_series((SELECT min(month) FROM m), (SELECT max(month) FROM m), INTERVAL 1 MONTH)) AS DATE) AS month)""",
  """d1 AS (
  SELECT cal.month, strftime(cal.month, '%Y-%m') AS date, CAST(coalesce(m.count, 0) AS BIGINT) AS count
  FROM cal LEFT JOIN m ON cal.month = m.month)""")


def _monthly(spark, sf):
    _utc(spark)
    return AG.monthly_counts(S.order_dates(spark, sf))


@register("d1_monthly_counts", MONTHLY_SQL + "SELECT month, date, count FROM d1")
def d1_monthly_counts(spark, sf):
    """Records per calendar month, zero-filled from the first to the last month."""
    return _monthly(spark, sf)


@register("e8_last_months", MONTHLY_SQL + """
SELECT month, date, count FROM d1 WHERE month > (SELECT max(month) FROM d1) - INTERVAL 5 MONTH""")
def e8_last_months(spark, sf):
    """E8 (tail form): the last five months of the zero-filled monthly counts."""
    m = _monthly(spark, sf)
    last = m.agg(F.max("month")).first()[0]      # one scalar
    return m.where(F.col("month") > F.add_months(F.lit(last), -5)).select("month", "date", "count")


@register("d5_seasonality", MONTHLY_SQL + """, g AS (
  SELECT CAST(month(month) AS INTEGER) AS month, avg(count) AS mean_count FROM d1 GROUP BY 1)
SELECT month, round(mean_count, 6) AS mean_count,
       row_number() OVER (ORDER BY mean_count DESC, month) = 1 AS is_peak,
       row_number() OVER (ORDER BY mean_count, month) = 1 AS is_low
FROM g""")
def d5_seasonality(spark, sf):
    """Mean per month of year, peak and low month."""
    s = AG.seasonality(_monthly(spark, sf))
    return s.select(F.col("month").cast("int").alias("month"), r6("mean_count").alias("mean_count"), "is_peak", "is_low")


TOPIC_SQL = S.with_ctes(S.TOPIC_PERIOD_SQL)


def _topics(spark, sf):
    """Quarterly series (a small aggregate of the line items), materialised
    once in the shared checkpoint folder and read by the later steps."""
    from ..session import ensure_checkpoint_dir
    _utc(spark)
    ensure_checkpoint_dir(spark)
    return S.topic_period(spark, sf).checkpoint(eager=True)


@register("e1_rolling_mean", TOPIC_SQL + f"""
SELECT topic, period, count,
       round(avg(count) OVER (PARTITION BY topic ORDER BY period ROWS BETWEEN {K.ROLLING_PERIODS - 1} PRECEDING AND CURRENT ROW), 6) AS rolling_mean
FROM topic_period""")
def e1_rolling_mean(spark, sf):
    """4-period rolling mean per series (min_periods=1)."""
    r = RK.rolling_mean(_topics(spark, sf), "topic", "period", "count")
    return r.withColumn("rolling_mean", r6("rolling_mean"))


@register("d8_series_stats", TOPIC_SQL + """
SELECT topic, round(avg(count), 6) AS mean, round(coalesce(stddev_samp(count), 0), 6) AS std
FROM topic_period GROUP BY topic""")
def d8_series_stats(spark, sf):
    """Mean and sample std per series, std null -> 0."""
    s = AG.series_stats(_topics(spark, sf))
    return s.select("topic", r6("mean").alias("mean"), r6("std").alias("std"))


@register("d9_grand_mean", TOPIC_SQL + "SELECT round(avg(count), 6) AS grand_mean FROM topic_period")
def d9_grand_mean(spark, sf):
    """Grand mean over all series points."""
    return _topics(spark, sf).agg(r6(F.avg("count")).alias("grand_mean"))


@register("d10_box_summary", TOPIC_SQL + """, q AS (
  SELECT topic, avg(count) AS mean, quantile_cont(count, 0.25) AS q1, quantile_cont(count, 0.5) AS median,
         quantile_cont(count, 0.75) AS q3 FROM topic_period GROUP BY topic),
  f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS fence_lo, q3 + 1.5 * (q3 - q1) AS fence_hi FROM q)
SELECT f.topic, round(mean, 6) AS mean, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(fence_lo, 6) AS fence_lo, round(fence_hi, 6) AS fence_hi,
       CAST(min(CASE WHEN count >= fence_lo AND count <= fence_hi THEN count END) AS BIGINT) AS whisker_lo,
       CAST(max(CASE WHEN count >= fence_lo AND count <= fence_hi THEN count END) AS BIGINT) AS whisker_hi,
       CAST(count(CASE WHEN NOT (count >= fence_lo AND count <= fence_hi) THEN 1 END) AS BIGINT) AS n_outliers,
       CAST(max(count) AS BIGINT) AS max, CAST(sum(count) AS BIGINT) AS sum
FROM f JOIN topic_period t ON f.topic = t.topic
GROUP BY f.topic, mean, q1, median, q3, iqr, fence_lo, fence_hi""")
def d10_box_summary(spark, sf):
    """Box-plot summary per series (quartiles, whiskers, outliers), by mean desc."""
    b = AG.box_summary(_topics(spark, sf))
    dbl = ["mean", "q1", "median", "q3", "iqr", "fence_lo", "fence_hi"]
    return b.select("topic", *[r6(c).alias(c) for c in dbl],
                    *[F.col(c).cast("bigint").alias(c) for c in ["whisker_lo", "whisker_hi", "n_outliers", "max", "sum"]]
                    ).orderBy(F.desc("mean"), "topic")


@register("d10_box_large_groups", """WITH q AS (
  SELECT l_returnflag AS topic, avg(l_extendedprice) AS mean, quantile_cont(l_extendedprice, 0.25) AS q1,
         quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
  f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT topic, round(mean, 4) AS mean, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(min(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi), 4) AS whisker_lo,
       round(max(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi), 4) AS whisker_hi,
       CAST(count(*) FILTER (WHERE l_extendedprice NOT BETWEEN lo AND hi) AS BIGINT) AS n_outliers
FROM f JOIN lineitem ON l_returnflag = topic GROUP BY topic, mean, q1, median, q3""")
def d10_box_large_groups(spark, sf):
    """D10 over three groups that grow with the table: quartiles by rank selection, no group in one buffer."""
    rows = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("topic"), F.col("l_extendedprice").cast("double").alias("count"))
    b = AG.box_summary(rows, unbounded=True)
    r4 = lambda c: F.round(c, 4).alias(c)
    return b.select("topic", *map(r4, ["mean", "q1", "median", "q3", "whisker_lo", "whisker_hi"]), F.col("n_outliers").cast("bigint").alias("n_outliers"))


YEARLY_SQL = TOPIC_SQL + """, yt AS (
  SELECT CAST(substr(period, 1, 4) AS INTEGER) AS year, topic, CAST(sum(count) AS BIGINT) AS count
  FROM topic_period GROUP BY 1, 2)
"""


def _yearly(spark, sf):
    return AG.yearly_totals(_topics(spark, sf))


@register("d11_yearly_totals", YEARLY_SQL + "SELECT year, topic, count FROM yt")
def d11_yearly_totals(spark, sf):
    """Series totals per year."""
    return _yearly(spark, sf)


@register("d12_year_dispersion", YEARLY_SQL + """, mu AS (SELECT year, avg(count) AS year_mean FROM yt GROUP BY year),
  mad AS (SELECT yt.year, avg(abs(count - year_mean)) AS year_mad FROM yt JOIN mu ON yt.year = mu.year GROUP BY yt.year)
SELECT yt.year, topic, count, round(year_mean, 6) AS year_mean, round(year_mad, 6) AS year_mad, count > year_mean AS above_mean
FROM yt JOIN mu ON yt.year = mu.year JOIN mad ON yt.year = mad.year""")
def d12_year_dispersion(spark, sf):
    """Per year mean, mean absolute deviation, above-mean flag."""
    d = AG.year_dispersion(_yearly(spark, sf))
    return d.select("year", "topic", "count", r6("year_mean").alias("year_mean"), r6("year_mad").alias("year_mad"), "above_mean")


@register("e5_bell_yearly", YEARLY_SQL + """
SELECT year, topic, count, rank0,
       CASE WHEN rank0 = 0 THEN 0 WHEN rank0 % 2 = 1 THEN CAST((rank0 + 1) // 2 AS INTEGER)
            ELSE -CAST(rank0 // 2 AS INTEGER) END AS position
FROM (SELECT year, topic, count,
             CAST(row_number() OVER (PARTITION BY year ORDER BY count DESC, topic) - 1 AS INTEGER) AS rank0 FROM yt)""")
def e5_bell_yearly(spark, sf):
    """E5: per year, series arranged as a bell (odd ranks right, even left)."""
    b = RK.bell_arrangement(_yearly(spark, sf), ["year"], "count", None, odd_left=False, tie="topic")
    return b.select("year", "topic", "count", F.col("rank0").cast("int").alias("rank0"), F.col("position").cast("int").alias("position"))


COMP_SQL = TOPIC_SQL + """, pt AS (SELECT period, sum(count) AS period_total FROM topic_period GROUP BY period),
  comp AS (SELECT t.period, topic, count, count * 100.0 / nullif(period_total, 0) AS percentage
           FROM topic_period t JOIN pt ON t.period = pt.period)
"""


@register("d13_composition", COMP_SQL + "SELECT period, topic, count, round(percentage, 6) AS percentage FROM comp")
def d13_composition(spark, sf):
    """Percent of the period total per series."""
    c = AG.composition(_topics(spark, sf))
    return c.withColumn("percentage", r6("percentage"))


@register("d13_composition_wide", COMP_SQL + f"""
SELECT period, {S.pivot_sql("topic", [t.capitalize() for t in S.PART_TYPES], "round(percentage, 6)", "DOUBLE")} FROM comp GROUP BY period""")
def d13_composition_wide(spark, sf):
    """D13 pivot: period x series percentages, 0-filled, columns in a fixed (sorted) order."""
    c = AG.composition(_topics(spark, sf))
    topics = sorted(r[0] for r in c.select("topic").distinct().collect())
    return (c.groupBy("period").pivot("topic", topics).agg(F.first(r6("percentage")))
            .na.fill(0.0, subset=topics))


@register("d18_last_leader", TOPIC_SQL + """
SELECT period, topic, count FROM (
  SELECT *, row_number() OVER (PARTITION BY period ORDER BY count DESC, topic) AS rn
  FROM topic_period WHERE period = (SELECT max(period) FROM topic_period)) WHERE rn = 1""")
def d18_last_leader(spark, sf):
    """Leader of the last period."""
    return AG.last_period_leader(_topics(spark, sf))


@register("a10_pending_periods", """WITH b AS (SELECT year(min(o_orderdate)) AS y0, year(max(o_orderdate)) AS y1,
                    CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS as_of FROM orders),
  cal AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 1), INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
  done AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders WHERE o_orderstatus = 'F')
SELECT CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month_of_year, month,
       strftime(month, '%Y%m%d') || '0000' AS start_date, strftime(last_day(month), '%Y%m%d') || '2359' AS end_date
FROM cal, b WHERE month <= as_of AND month NOT IN (SELECT month FROM done)""")
def a10_pending_periods(spark, sf):
    """A10 + F6: months of the order-year range, not after the newest order's
    month, without the completed months (those holding a finished order)."""
    _utc(spark)
    o = S.order_dates(spark, sf)
    lo, hi = T.year_bounds(o.select(F.year("published_date").alias("year")))
    cal = AG.month_calendar(lo, hi, spark)
    asof = o.agg(F.max(DT.month_start("published_date")).alias("m")).first()["m"]
    done = (table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
            .select(DT.month_start("o_orderdate").alias("month")).distinct())
    return AG.pending_periods(cal, F.lit(asof), done)


@register("a10_after_marker", """WITH b AS (SELECT year(min(o_orderdate)) AS y0, year(max(o_orderdate)) AS y1 FROM orders),
  cal AS (SELECT CAST(unnest(generate_series(make_date(y0, 1, 1), make_date(y1, 12, 1), INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
  mark AS (SELECT CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS month FROM orders WHERE o_orderstatus = 'F')
SELECT CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month_of_year, month,
       strftime(month, '%Y%m%d') || '0000' AS start_date, strftime(last_day(month), '%Y%m%d') || '2359' AS end_date
FROM cal WHERE month > (SELECT month FROM mark)""")
def a10_after_marker(spark, sf):
    """A10 marker rule: the months after the last completed one (the marker), to the calendar's end."""
    _utc(spark)
    o = table(spark, sf, "orders").select("o_orderdate", "o_orderstatus")
    done = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    b = o.agg(F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate")), F.year(F.max(done)), F.month(F.max(done))).first()
    return AG.after_marker(AG.month_calendar(b[0], b[1], spark), b[2], b[3])


def _a11_sql(cap: int) -> str:
    return f"""
SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m') AS period, fetch_rank FROM (
  SELECT o_orderkey, o_orderdate,
         CAST(row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate DESC, o_orderkey) AS INTEGER) AS fetch_rank
  FROM orders) WHERE fetch_rank <= {cap}"""


@register("a11_capped_fetch", _a11_sql(K.FETCH_CAP_PER_PERIOD))
def a11_capped_fetch(spark, sf, cap=K.FETCH_CAP_PER_PERIOD):
    """Newest-first, at most 10,000 records per month."""
    _utc(spark)
    o = S.order_dates(spark, sf).withColumn("period", DT.month_label("published_date"))
    c = AG.capped_fetch(o, "period", "published_date", "id", cap)
    return c.select("id", "period", F.col("fetch_rank").cast("int").alias("fetch_rank"))


@register("a11_capped_fetch_small", _a11_sql(10))
def a11_capped_fetch_small(spark, sf):
    """A11 with a cap of 10 records, which binds in every month."""
    return a11_capped_fetch(spark, sf, 10)


@register("b13_parse_dates", """
SELECT o_orderkey AS id, 'rfc2822' AS form, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS parsed FROM orders
UNION ALL
SELECT o_orderkey AS id, 'iso' AS form, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || ' 00:00:00' AS parsed FROM orders""")
def b13_parse_dates(spark, sf):
    """Tolerant parsing of RFC-2822, ISO and garbage date strings;
    invalid -> null -> dropped.  Inputs are rendered from orders."""
    _utc(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority")
    rfc = o.select("o_orderkey", F.lit("rfc2822").alias("form"),
                   F.concat(F.date_format(F.col("o_orderdate").cast("timestamp"), "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("raw"))
    iso = o.select("o_orderkey", F.lit("iso").alias("form"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("raw"))
    junk = o.select("o_orderkey", F.lit("junk").alias("form"), F.col("o_orderpriority").alias("raw"))
    p = rfc.unionByName(iso).unionByName(junk).withColumn("ts", DT.parse_timestamp("raw")).where(F.col("ts").isNotNull())
    return p.select(F.col("o_orderkey").alias("id"), "form", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@register("b14_period_keys", """
SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
       strftime(o_orderdate, '%Y-%m') AS month_label,
       CAST(make_date(year(o_orderdate), (quarter(o_orderdate) - 1) * 3 + 1, 1) AS DATE) AS quarter_start,
       CAST(year(o_orderdate) AS DOUBLE) + quarter(o_orderdate) / 10.0 AS quarter_key
FROM orders""")
def b14_period_keys(spark, sf):
    """Year, month, 'YYYYQn', 'YYYY-MM', quarter start and 'YYYY.n' keys."""
    _utc(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    q = DT.quarter_label("o_orderdate")
    return o.select(F.col("o_orderkey").alias("id"), DT.year_of("o_orderdate").alias("year"),
                    F.month("o_orderdate").cast("int").alias("month"), q.alias("quarter"),
                    DT.month_label("o_orderdate").alias("month_label"), DT.quarter_label_start(q).alias("quarter_start"),
                    DT.quarter_label_to_float(q).alias("quarter_key"))
