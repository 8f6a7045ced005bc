"""Dates, periods and category codes."""

import datetime as dt

from pyspark.sql import functions as F

from lexitrend.functions import categories as CA
from lexitrend.functions import dates as DT
from lexitrend.operators import aggregates as AG


def test_parse_timestamp(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.createDataFrame([("Mon, 2 Apr 2007 19:18:42 GMT",), ("2020-05-06",), ("garbage",), (None,)], "s string")
    got = [r[0] for r in df.select(F.date_format(DT.parse_timestamp("s"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2007-04-02 19:18:42", "2020-05-06 00:00:00", None, None]


def test_period_keys(spark):
    df = spark.createDataFrame([(dt.date(2021, 5, 17),)], "d date")
    r = df.select(DT.quarter_label("d").alias("q"), DT.month_label("d").alias("m"),
                  DT.quarter_label_start(F.lit("2021Q2")).alias("qs"), DT.quarter_label_to_float(F.lit("2021Q2")).alias("qf"),
                  DT.quarter_label_year(F.lit("2021Q2")).alias("qy")).first()
    assert (r.q, r.m, r.qs, r.qf, r.qy) == ("2021Q2", "2021-05", dt.date(2021, 4, 1), 2021.2, 2021)


def test_target_domains(spark):
    vals = ["cs.AI cs.LG", "cs.AI stat.ML", "math-ph", "xyz.AB", "", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(CA.target_domains("c")).collect()]
    assert got == [["computer_science"], ["computer_science", "statistics"], ["physics"], [], [], []]
    prim = [r[0] for r in df.orderBy("i").select(CA.primary_category("c")).collect()]
    assert prim == ["cs.AI", "cs.AI", "math-ph", "xyz.AB", "", ""]


def test_monthly_counts_zero_fill(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 1, 9),), (dt.date(2020, 4, 1),), (None,)],
                               "published_date date")
    got = [(r.date, r["count"]) for r in AG.monthly_counts(df).orderBy("month").collect()]
    assert got == [("2020-01", 2), ("2020-02", 0), ("2020-03", 0), ("2020-04", 1)]
    assert sum(c for _, c in got) == 3  # sum of D1 = records with a date


def test_pending_periods(spark):
    cal = AG.month_calendar(2020, 2020, spark)
    done = spark.createDataFrame([(dt.date(2020, 1, 1),), (dt.date(2020, 2, 1),)], "month date")
    got = [r.month for r in AG.pending_periods(cal, F.lit(dt.date(2020, 4, 1)), done).orderBy("month").collect()]
    assert got == [dt.date(2020, 3, 1), dt.date(2020, 4, 1)]
    marker = [r.month_of_year for r in AG.after_marker(cal, 2020, 10).collect()]
    assert sorted(marker) == [11, 12]
    b = cal.where("month_of_year = 2").first()
    assert (b.start_date, b.end_date) == ("202002010000", "202002292359")
