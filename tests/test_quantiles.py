"""Exact quantiles by selection: the same as ``percentile``, whatever the group's size and values."""

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import aggregates as AG
from lexitrend.operators import quantiles as Q
from lexitrend.operators import trends as T

SHARES = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]


def same(df, keys, shares=SHARES):
    a = {tuple(r[k] for k in keys): (r["n"], [x.hex() for x in r["q"]]) for r in Q.exact_percentiles(df, keys, "v", shares).collect()}
    b = {tuple(r[k] for k in keys): (r["n"], [x.hex() for x in r["q"]]) for r in
         df.where("v is not null").groupBy(*keys).agg(F.count("v").alias("n"), F.percentile("v", shares).alias("q")).collect()}
    assert a == b and a


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(Q, "SMALL", 20)
    monkeypatch.setattr(Q, "GRID", 16)


def test_all_kinds_of_values(spark, small):
    """Ties, one value, heavy values beside many others, a very wide range, negative numbers, nulls."""
    kinds = {"spread": "rand(1) * 1000", "ties": "floor(rand(2) * 7)", "one": "5", "two": "id % 2",
             "heavy": "if(id % 3 = 0, 1.5, rand(3))", "wide": "exp(rand(4) * 600 - 300)", "negative": "id - 1500.5",
             "nulls": "if(id % 10 = 0, rand(5), null)", "none": "cast(null as double)"}
    df = None
    for k, e in kinds.items():
        part = spark.range(3000).select(F.lit(k).alias("k"), F.expr(e).cast("double").alias("v"))
        df = part if df is None else df.unionByName(part)
    df = df.unionByName(spark.range(101).select(F.lit(None).cast("string").alias("k"), F.col("id").cast("double").alias("v")))
    df = df.unionByName(spark.createDataFrame([("single", 3.5), ("pair", 1.0), ("pair", 2.0)], "k string, v double"))
    same(df, ["k"])


def test_without_keys_and_by_shuffle(spark, small, monkeypatch):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.rand(7).alias("v"))
    same(df, [])
    monkeypatch.setattr(Q, "MOST_BROADCAST", 0)
    same(df, ["k"])


def test_empty(spark):
    assert Q.exact_percentiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", SHARES).collect() == []


def test_ten_million_rows_in_one_group(spark):
    df = spark.range(10_000_000).select(F.lit("hot").alias("k"), (F.rand(3) * F.rand(4) * 1e6).alias("v"))
    same(df, ["k"], [0.25, 0.5, 0.75])


def test_box_and_median_of_unbounded_groups(spark, small):
    df = spark.range(4000).select((F.col("id") % 2).cast("string").alias("topic"), F.floor(F.rand(9) * 500).alias("count"))
    rows = lambda d: sorted(map(str, d.select(sorted(d.columns)).collect()))
    assert rows(AG.box_summary(df).drop("_key")) == rows(AG.box_summary(df, unbounded=True).drop("_key"))
    g = df.select(F.col("topic").alias("category"), F.col("count").cast("double").alias("growth_percent"))
    assert rows(T.median_growth(g)) == rows(T.median_growth(g, unbounded=True))
