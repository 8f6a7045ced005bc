"""Aggregations over dated records and period series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from ..functions.dates import month_label, month_start
from .joins import join_small
from .quantiles import exact_percentiles


def monthly_counts(df: DataFrame, date_col: str = "published_date") -> DataFrame:
    """Records per calendar month, zero-filled between the first and last month.

    One scan: the monthly counts, at most 12 a year, become one row with their range and a map,
    and the calendar is generated from that row.
    """
    m = (df.where(F.col(date_col).isNotNull())
         .groupBy(month_start(date_col).alias("month")).agg(F.count(F.lit(1)).alias("count")))
    one = m.agg(F.min("month").alias("lo"), F.max("month").alias("hi"),
                F.map_from_entries(F.collect_list(F.struct("month", "count"))).alias("counts")).where(F.col("lo").isNotNull())
    cal = one.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"), "counts")
    return cal.select("month", month_label("month").alias("date"),
                      F.coalesce(F.try_element_at("counts", F.col("month")), F.lit(0)).cast("bigint").alias("count"))


def seasonality(monthly: DataFrame) -> DataFrame:
    """Mean count per month of year; busiest and slowest month flagged
    (ties: the earlier month).  Input: D1 output (12 result rows)."""
    g = monthly.groupBy(F.month("month").alias("month")).agg(F.avg("count").alias("mean_count"))
    hi = W.orderBy(F.desc("mean_count"), F.asc("month"))
    lo = W.orderBy(F.asc("mean_count"), F.asc("month"))
    # at most 12 rows: a global window is safe here
    return (g.withColumn("is_peak", F.row_number().over(hi) == 1)
            .withColumn("is_low", F.row_number().over(lo) == 1))


def series_stats(df: DataFrame, key: str = "topic", value: str = "count") -> DataFrame:
    """Mean and sample std per series (std of one point -> 0)."""
    return df.groupBy(key).agg(F.avg(value).alias("mean"),
                               F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))


def box_summary(df: DataFrame, key: str = "topic", value: str = "count", exact: bool = True,
                accuracy: int = 10000, unbounded: bool = False) -> DataFrame:
    """Quartiles (linear), 1.5 IQR fences, whiskers (extreme values
    inside the fences), outlier count, mean; one row per series.

    ``exact`` uses ``percentile``, whose buffer holds a group's distinct
    values in one task (fine for period series); ``unbounded`` gives the same
    quartiles by ``quantiles.exact_percentiles``, for groups of any size;
    ``exact=False`` uses the bounded-memory ``percentile_approx`` sketch."""
    if unbounded:
        q = (exact_percentiles(df, [key], value, [0.25, 0.5, 0.75]).select(F.col(key).alias("_key"), "q")
             .join(df.groupBy(key).agg(F.avg(value).alias("mean")), F.col("_key").eqNullSafe(F.col(key))))
    else:
        pct = (F.percentile(value, [0.25, 0.5, 0.75]) if exact
               else F.percentile_approx(value, [0.25, 0.5, 0.75], accuracy).cast("array<double>"))
        q = df.groupBy(key).agg(pct.alias("q"), F.avg(value).alias("mean"))
    q = q.select(key, "mean", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = q.withColumn("fence_lo", F.col("q1") - 1.5 * F.col("iqr")).withColumn("fence_hi", F.col("q3") + 1.5 * F.col("iqr"))
    v = F.col(value)
    inside = (v >= F.col("fence_lo")) & (v <= F.col("fence_hi"))
    # one row per series on the small side: broadcast behind a row check
    w = (join_small(df.select(key, value), q.select(key, "fence_lo", "fence_hi"), key)
         .groupBy(key).agg(F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                           F.count(F.when(~inside, v)).alias("n_outliers"),
                           F.max(v).alias("max"), F.sum(v).alias("sum")))
    return q.join(w, key)


def yearly_totals(df: DataFrame, period: str = "period", key: str = "topic", value: str = "count") -> DataFrame:
    """Series totals per year (year = first four characters of the period)."""
    return (df.groupBy(F.substring(period, 1, 4).cast("int").alias("year"), key)
            .agg(F.sum(value).cast("bigint").alias(value)))


def year_dispersion(df: DataFrame, key: str = "topic", value: str = "count") -> DataFrame:
    """Per year mean, mean absolute deviation and the above-mean flag per series."""
    # per-year tables have one row per year: broadcast behind a row check,
    # never a shuffle keyed by the (few) years
    mu = df.groupBy("year").agg(F.avg(value).alias("year_mean"))
    j = join_small(df, mu, "year")
    mad = j.groupBy("year").agg(F.avg(F.abs(F.col(value) - F.col("year_mean"))).alias("year_mad"))
    return (join_small(j, mad, "year")
            .select("year", key, value, "year_mean", "year_mad", (F.col(value) > F.col("year_mean")).alias("above_mean")))


def composition(df: DataFrame, period: str = "period", key: str = "topic", value: str = "count") -> DataFrame:
    """Percent of the period total (aggregate + broadcast join, not
    a window, so a busy period is combined map-side)."""
    tot = df.groupBy(period).agg(F.sum(value).alias("period_total"))
    # one row per period: broadcast behind a row check (a shuffle keyed by
    # the few periods would put a busy period's rows in one task)
    return (join_small(df, tot, period)
            .select(period, key, value, (F.try_divide(F.col(value) * 100.0, F.col("period_total"))).alias("percentage")))


def last_period_leader(df: DataFrame, period: str = "period", key: str = "topic", value: str = "count") -> DataFrame:
    """In the latest period, the series with the largest value (first on ties)."""
    last = df.agg(F.max(period)).first()[0]      # one scalar, then a plain filter
    cur = df.where(F.col(period) == F.lit(last))
    w = W.partitionBy(period).orderBy(F.desc(value), F.asc(key))
    return cur.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def month_calendar(lo_year: int, hi_year: int, spark) -> DataFrame:
    """A10: every month of the year range with its first and last instant."""
    base = spark.range(1).select(F.explode(F.sequence(F.make_date(F.lit(lo_year), F.lit(1), F.lit(1)),
                                                      F.make_date(F.lit(hi_year), F.lit(12), F.lit(1)),
                                                      F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return period_bounds(base)


def period_bounds(months: DataFrame) -> DataFrame:
    """A10: 'yyyyMMdd0000' .. 'yyyyMMdd2359' range strings for each month."""
    return months.select(
        F.year("month").cast("int").alias("year"), F.month("month").cast("int").alias("month_of_year"), "month",
        F.concat(F.date_format("month", "yyyyMMdd"), F.lit("0000")).alias("start_date"),
        F.concat(F.date_format(F.last_day("month"), "yyyyMMdd"), F.lit("2359")).alias("end_date"))


def pending_periods(calendar: DataFrame, as_of_month, completed: DataFrame) -> DataFrame:
    """A10 + F6: months not after ``as_of_month`` that are not completed (anti join)."""
    return (calendar.where(F.col("month") <= as_of_month)
            .join(completed.select("month"), "month", "left_anti"))


def after_marker(calendar: DataFrame, last_year: int, last_month: int) -> DataFrame:
    """A10 marker rule: drop months at or before (last_year, last_month)."""
    y, m = F.col("year"), F.col("month_of_year")
    return calendar.where((y > last_year) | ((y == last_year) & (m > last_month)))


def capped_fetch(df: DataFrame, period: str, date_col: str, id_col: str,
                 cap: int = K.FETCH_CAP_PER_PERIOD) -> DataFrame:
    """At most ``cap`` records per period, newest first (ties by id).

    Planned with a partial WindowGroupLimit, so a period holding most of the
    rows forwards at most ``cap`` rows per map task."""
    w = W.partitionBy(period).orderBy(F.desc(date_col), F.asc(id_col))
    return df.withColumn("fetch_rank", F.row_number().over(w)).where(F.col("fetch_rank") <= cap)


def papers_per_domain_year(rows: DataFrame, domain: str = "category") -> DataFrame:
    """(domain, year, total_papers) from (id, year, domain) rows, nulls in year or domain left out.

    A paper counts once per domain, in its earliest year there, however often its id occurs; rows without
    an id are dropped as the reference's count drops them (their domain's years stay, with 0)."""
    first = (rows.where(F.col("year").isNotNull() & F.col(domain).isNotNull())
             .groupBy("id", domain).agg(F.min("year").alias("year")))
    return first.groupBy(domain, "year").agg(F.count("id").cast("bigint").alias("total_papers"))
