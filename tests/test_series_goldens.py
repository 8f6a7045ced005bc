"""D5, D7-D13, D18, A4, C6 goldens replayed from the reference's committed output files
(read as data; skipped when the files are absent)."""

import pytest
from pyspark.sql import functions as F

from lexitrend.operators import aggregates as AG
from lexitrend.sources.corpus import read_topic_folder

from .conftest import needs_ref, ref_path


@pytest.fixture(scope="module")
def topics(spark):
    return read_topic_folder(spark, ref_path("hw3", "data")).cache()


@needs_ref
def test_topic_folder_labels(topics):
    labels = sorted(r[0] for r in topics.select("topic").distinct().collect())
    assert labels == ["Artificial Intelligence", "Climate Change", "Covid Pandemic", "Electric Vehicle",
                      "Large Language", "Machine Learning", "Public Health", "Renewable Energy", "Social Distancing"]
    assert topics.groupBy("topic").count().where("count != 23").count() == 0


@needs_ref
def test_series_stats_and_box(topics):
    st = {r.topic: r for r in AG.series_stats(topics).collect()}
    assert st["Machine Learning"].mean == pytest.approx(52.347826, abs=1e-6)
    assert st["Machine Learning"].std == pytest.approx(17.358804, abs=1e-6)
    assert st["Large Language"].std == pytest.approx(15.531938, abs=1e-6)
    bx = {r.topic: r for r in AG.box_summary(topics).collect()}
    ml = bx["Machine Learning"]
    assert (ml.q1, ml.median, ml.q3, ml["max"], ml["sum"]) == (39, 48, 68, 90, 1204)
    cv = bx["Covid Pandemic"]
    assert (cv.q1, cv.median, cv.q3, cv["max"], cv["sum"]) == (9.5, 13, 23.5, 44, 390)
    sd = bx["Social Distancing"]
    assert (sd.q1, sd.median, sd.q3) == (0, 2, 4)
    # whiskers are values inside the fences; outliers are the rest
    assert sd.whisker_hi <= sd.fence_hi and sd.n_outliers >= 1


@needs_ref
def test_yearly_dispersion(topics):
    y = AG.yearly_totals(topics)
    d = {r.year: r for r in AG.year_dispersion(y).collect()}
    assert d[2020].year_mean == pytest.approx(53.111111, abs=1e-6)
    assert d[2020].year_mad == pytest.approx(44.567901, abs=1e-6)
    assert d[2025].year_mean == pytest.approx(71.222222, abs=1e-6)
    tot = {r.year: r.s for r in y.groupBy("year").agg(F.sum("count").alias("s")).collect()}
    assert tot == {2020: 478, 2021: 468, 2022: 392, 2023: 447, 2024: 610, 2025: 641}


@needs_ref
def test_composition_and_leader(topics):
    c = {r.topic: r.percentage for r in AG.composition(topics).where("period = '2020Q1'").collect()}
    assert c["Machine Learning"] == pytest.approx(52.307692, abs=1e-6)
    assert c["Climate Change"] == pytest.approx(23.076923, abs=1e-6)
    assert c["Public Health"] == 0
    allc = AG.composition(topics).groupBy("period").agg(F.sum("percentage").alias("s")).collect()
    assert all(r.s == pytest.approx(100.0) for r in allc)
    lead = AG.last_period_leader(topics).first()
    assert (lead.period, lead.topic, lead["count"]) == ("2025Q3", "Machine Learning", 75)


@needs_ref
def test_seasonality_golden(spark):
    m = (spark.read.option("header", True).schema("date string, count long")
         .csv(ref_path("final", "analysis_results", "monthly_article_counts.csv"))
         .select(F.to_date(F.concat("date", F.lit("-01"))).alias("month"), "count"))
    assert m.count() == 477 and m.agg(F.sum("count")).first()[0] == 2918474
    s = {r.month: r for r in AG.seasonality(m).collect()}
    assert s[10].mean_count == pytest.approx(6929.35) and s[10].is_peak
    assert s[1].mean_count == pytest.approx(5462.948718, abs=1e-6) and s[1].is_low


@needs_ref
def test_phrase_substring_semantics(spark):
    """New 'electric vehicle' series = old 'electric vehicle' + old 'electric vehicles'."""
    def rd(name):
        return {r.period: r["count"] for r in spark.read.option("header", True).schema("period string, count long")
                .csv(ref_path("hw3", *name)).collect()}
    new = rd(["data", "climate_change", "electric_vehicle_quarterly_counts.csv"])
    a, b = rd(["old", "electric_vehicle_quarterly_counts.csv"]), rd(["old", "electric_vehicles_quarterly_counts.csv"])
    assert len(new) == 23 and all(new[p] == a[p] + b[p] for p in new)


def test_topic_folder_skips_files_without_columns(spark):
    from lexitrend.session import checkpoint_path
    base = checkpoint_path(spark, "test-topic-folder")
    good = spark.createDataFrame([("2020Q1", 3), ("2020Q2", 4)], "period string, count long")
    bad = spark.createDataFrame([("2020Q1", 9)], "quarter string, n long")
    swapped = spark.createDataFrame([(5, "2020Q1")], "count long, period string")
    good.coalesce(1).write.option("header", True).csv(f"{base}/topic=climate_change_quarterly_counts")
    bad.coalesce(1).write.option("header", True).csv(f"{base}/topic=bad_quarterly_counts")
    swapped.coalesce(1).write.option("header", True).option("quoteAll", True).csv(f"{base}/topic=public_health_quarterly_counts")
    got = sorted(map(tuple, read_topic_folder(spark, base).collect()))
    assert got == [("Climate Change", "2020Q1", 3), ("Climate Change", "2020Q2", 4), ("Public Health", "2020Q1", 5)]
