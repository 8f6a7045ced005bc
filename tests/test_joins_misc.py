"""join_small bound and fallback, A11 cap, C6 phrase counts, D2 pivot, B22 labels."""

import datetime as dt

from pyspark.sql import functions as F

from lexitrend.operators import aggregates as AG
from lexitrend.operators import joins as J
from lexitrend.operators import reshape as R
from lexitrend.operators import terms as TM
from lexitrend.plans import q_corpus as QC

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_small_broadcasts_under_bound_and_falls_back(spark):
    big = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    small = spark.createDataFrame([(i, f"v{i}") for i in range(7)], "k long, v string")
    under = J.join_small(big, small, "k", max_bytes=1 << 20)
    over = J.join_small(big, small, "k", max_bytes=3)
    assert under.count() == over.count() == 1000
    assert "BroadcastHashJoin" in _plan(under)
    assert sorted(map(tuple, under.select("id", "v").collect())) == sorted(map(tuple, over.select("id", "v").collect()))


def test_capped_fetch_keeps_newest(spark):
    rows = [(i, "2020-01", dt.datetime(2020, 1, 1 + i)) for i in range(5)] + [(9, "2020-02", dt.datetime(2020, 2, 1))]
    df = spark.createDataFrame(rows, "id long, period string, ts timestamp")
    got = sorted((r.period, r.id) for r in AG.capped_fetch(df, "period", "ts", "id", cap=2).collect())
    assert got == [("2020-01", 3), ("2020-01", 4), ("2020-02", 9)]


def test_phrase_period_counts(spark):
    p = spark.createDataFrame([("Electric vehicles and an electric vehicle", "", dt.date(2021, 2, 1)),
                               ("Public-Health", "public health", dt.date(2021, 3, 1)),
                               ("x", None, dt.date(2021, 7, 1))],
                              "title string, summary string, published_date date")
    from lexitrend.functions.dates import quarter_label
    got = {(r.phrase, r.period): r["count"] for r in
           TM.phrase_period_counts(p, ["electric vehicle", "electric vehicles", "public health"], quarter_label("published_date")).collect()}
    assert got[("electric vehicle", "2021Q1")] == 2
    assert got[("electric vehicles", "2021Q1")] == 1
    assert got[("public health", "2021Q1")] == 1      # 'Public-Health' cleans to 'publichealth'
    assert got[("public health", "2021Q3")] == 0      # observed period, zero count


def test_domain_year_pivot(spark):
    p = spark.createDataFrame([("1", "2020-01-01", "cs.AI cs.LG"), ("2", "2020-05-05", "cs.AI stat.ML"),
                               ("3", "2021-01-01", "math-ph"), ("4", "bad", "cs.AI"), ("5", "2021-02-02", "xyz.AB")],
                              "id string, published_date string, all_categories string")
    got = {r.domain: (r["2020"], r["2021"]) for r in QC.domain_year_pivot(p).collect()}
    assert got == {"computer_science": (2, 0), "statistics": (1, 0), "physics": (0, 1)}


def test_labels_roundtrip(spark):
    df = spark.createDataFrame([("cs", "deep learning")], "category string, term string")
    lab = df.select(R.label("category", "term").alias("l"))
    c, t = R.split_label("l")
    assert lab.select("l", c.alias("c"), t.alias("t")).first() == ("cs - deep learning", "cs", "deep learning")


def test_selections_by_parameter(spark):
    """D14 pair form and D15 for the categories and the term that a caller names."""
    from lexitrend.plans import q_trends as QT
    all_rows = {(r.term, r.category): r["count"] for r in QT._base(spark, SF_SMALL, domains=False)[0]
                .groupBy("term", "category").sum("count").withColumnRenamed("sum(count)", "count").collect()}
    got = QT.d14_pair_relation(spark, SF_SMALL, ("SMALL", "PROMO")).collect()
    assert got and all(r.cat1 == all_rows.get((r.term, "SMALL"), 0) and r.cat2 == all_rows.get((r.term, "PROMO"), 0) for r in got)
    term = sorted(t for t, _ in all_rows)[0]
    got = {r.category: r.total for r in QT.d15_term_distribution(spark, SF_SMALL, term).collect()}
    assert got == {c: n for (t, c), n in all_rows.items() if t == term}
