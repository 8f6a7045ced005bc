"""Trend analytics on tiny long tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexitrend.operators import ranking as RK
from lexitrend.operators import reshape as R
from lexitrend.operators import trends as T


def terms_df(spark, rows):
    return spark.createDataFrame(rows, "category string, term string, year int, count long")


def domains_df(spark, rows):
    return spark.createDataFrame(rows, "category string, year int, total_papers long")


def test_norm_freq_golden_and_zero_total(spark):
    # 150 occurrences among 2994 papers -> 501.0020040080 per 10k (reference summary file)
    t = terms_df(spark, [("economics", "artificial intelligence", 2025, 150), ("economics", "x", 2024, 3),
                         ("economics", "y", 2023, 1)])
    d = domains_df(spark, [("economics", 2025, 2994), ("economics", 2024, 0), ("economics", 2023, None)])
    j = T.join_domain_totals(t, d).withColumn("nf", T.norm_freq())
    got = {r.term: r.nf for r in j.collect()}
    assert got["artificial intelligence"] == pytest.approx(501.0020040080, abs=1e-9)
    assert got["x"] is None           # total 0 -> null (then dropped by the < 50,000 filter)
    assert got["y"] == pytest.approx(10000.0)  # missing total read as 1


def test_normalized_long_zero_fill_and_outliers(spark):
    t = terms_df(spark, [("c", "a", 2020, 5), ("c", "b", 2021, 6), ("c", "huge", 2021, 100)])
    d = domains_df(spark, [("c", 2020, 10), ("c", 2021, 10)])
    m = T.normalized_long(t, d)
    rows = {(r.term, r.year): r.norm_freq for r in m.collect()}
    assert rows[("a", 2021)] == 0.0 and rows[("b", 2020)] == 0.0  # zero-filled years
    assert ("huge", 2021) not in rows                              # 100000 >= 50000 dropped
    assert ("huge", 2020) in rows


def test_training_window():
    assert T.training_window(2025, 1986) == (2020, 2025)
    assert T.training_window(2003, 2000) == (2000, 2003)


def test_trend_rules(spark):
    rows = []
    for y, v in zip(range(2020, 2026), [1, 2, 3, 4, 5, 6]):
        rows.append(("c", "rising", y, v))
    rows += [("c", "flat", y, 5) for y in range(2020, 2026)]
    rows += [("c", "one_point", 2025, 7)]
    rows += [("c", "no_last", y, 3) for y in range(2020, 2025)]
    rows += [("c", "low_last", 2024, 2), ("c", "low_last", 2025, 0.9)]
    rows += [("c", "edge_last", 2024, 2), ("c", "edge_last", 2025, 1.0)]
    rows = [(c, t, y, float(v)) for c, t, y, v in rows]
    df = spark.createDataFrame(rows, "category string, term string, year int, norm_freq double")
    got = {r.term: r for r in T.normalized_trends(df, 2020, 2025).collect()}
    assert set(got) == {"rising", "flat", "edge_last"}
    assert got["rising"].slope == pytest.approx(1.0) and got["rising"].r2 == pytest.approx(1.0)
    assert got["flat"].r2 == 0.0 and got["flat"].slope == pytest.approx(0.0)
    assert got["rising"].current_norm == 6


def test_trend_matches_polyfit(spark):
    rng = np.random.default_rng(7)
    rows = []
    for k in range(20):
        ys = rng.uniform(1, 100, size=6)
        rows += [("c", f"t{k}", 2020 + i, float(y)) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "category string, term string, year int, norm_freq double")
    got = {r.term: r for r in T.normalized_trends(df, 2020, 2025).collect()}
    for k in range(20):
        xs = np.array([r[2] for r in rows if r[1] == f"t{k}"], dtype=float)
        ys = np.array([r[3] for r in rows if r[1] == f"t{k}"])
        slope, icpt = np.polyfit(xs, ys, 1)
        pred = slope * xs + icpt
        r2 = 1 - ((ys - pred) ** 2).sum() / ((ys - ys.mean()) ** 2).sum()
        assert got[f"t{k}"].slope == pytest.approx(slope, rel=1e-6)
        assert got[f"t{k}"].intercept == pytest.approx(icpt, rel=1e-6)
        assert got[f"t{k}"].r2 == pytest.approx(r2, rel=1e-6)


def test_top_trends_ties_and_r2(spark):
    df = spark.createDataFrame([("c", t, s, 0.0, r2, 1.0) for t, s, r2 in
                                [("b", 2.0, 0.9), ("a", 2.0, 0.9), ("z", 9.0, 0.4), ("d", 1.0, 0.6), ("e", 0.5, 0.6),
                                 ("f", 0.1, 0.6), ("g", 0.0, 0.6)]],
                               "category string, term string, slope double, intercept double, r2 double, current_norm double")
    got = [r.term for r in T.top_trends(df).orderBy("rank").collect()]
    assert got == ["a", "b", "d", "e", "f"]


def test_forecast_clamped_and_prediction_not(spark):
    tr = spark.createDataFrame([("c", "down", -10.0, 20300.0)], "category string, term string, slope double, intercept double")
    f = {r.year: r.forecast for r in T.forecast(tr, 2025, 2030).collect()}
    assert sorted(f) == [2026, 2027, 2028, 2029, 2030] and all(v >= 0 for v in f.values())
    t = terms_df(spark, [("c", "fall", 2020, 9), ("c2", "fall", 2021, 6), ("c", "fall", 2022, 3), ("c", "fall", 2023, 0),
                         ("c", "two", 2020, 1), ("c", "two", 2021, 2)])
    p = {(r.term, r.year): r.prediction for r in T.predict_term(t, 2023).collect()}
    assert ("two", 2024) not in p                      # two positive years -> no row
    assert p[("fall", 2026)] == pytest.approx(9 - 3 * 6)  # not clamped: -9


def test_growth_rules(spark):
    rows = [("c", "start0", 2015, 0), ("c", "start0", 2020, 10),
            ("c", "end4", 2015, 1), ("c", "end4", 2020, 4),
            ("c", "end5", 2015, 1), ("c", "end5", 2020, 5),
            ("c", "big", 2015, 1), ("c", "big", 2020, 10 ** 9)]
    g = {r.term: r for r in T.growth(terms_df(spark, rows), 2015, 2020).collect()}
    assert set(g) == {"end5"}
    assert g["end5"].cagr == pytest.approx(5 ** (1 / 5) - 1)
    same = {r.term: r for r in T.growth(terms_df(spark, [("c", "s", 2020, 2), ("c", "s", 2021, 8)]), 2021, 2021).collect()}
    # start = end year: span floored at 1, the value is compared with itself -> 0 %
    assert set(same) == {"s"} and same["s"].cagr == 0.0 and same["s"].volume == 8.0
    exact = T.growth(terms_df(spark, [("c", "e", 2020, 1), ("c", "e", 2021, 51)]), 2020, 2021).collect()
    assert exact == []  # growth exactly 5000 % is not < 5000


def test_bell_positions(spark):
    for n in (1, 2, 5):
        df = spark.createDataFrame([("c", f"t{i}", 100 - i) for i in range(n)], "category string, term string, total long")
        a = {r.term: r.position for r in RK.bell_arrangement(df, ["category"], "total", None, odd_left=True).collect()}
        b = {r.term: r.position for r in RK.bell_arrangement(df, ["category"], "total", None, odd_left=False).collect()}
        exp_a = {0: 0, 1: -1, 2: 1, 3: -2, 4: 2}
        assert a == {f"t{i}": exp_a[i] for i in range(n)}
        assert b == {f"t{i}": -exp_a[i] for i in range(n)}
    eq = spark.createDataFrame([("c", "y", 5), ("c", "x", 5)], "category string, term string, total long")
    assert {r.term: r.position for r in RK.bell_arrangement(eq, ["category"], "total", None, True).collect()} == {"x": 0, "y": -1}


def test_pivot_unpivot_identity(spark):
    t = terms_df(spark, [("c", "a", 2020, 1), ("c", "a", 2022, 3), ("d", "b", 2021, 2)])
    w = R.pivot_years(t, [2020, 2021, 2022])
    assert {(r.category, r.term): r.total for r in w.collect()} == {("c", "a"): 4, ("d", "b"): 2}
    back = R.unpivot_years(w.drop("total"), ["category", "term"], ["2020", "2021", "2022"]).where("count > 0")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))


def test_drop_unrealistic_and_standardize(spark):
    t = terms_df(spark, [("c", "ok", 2020, 5), ("c", "bad", 2020, 300000), ("c", "bad", 2021, 1)])
    assert [r.term for r in R.drop_unrealistic_long(t, ["category", "term"]).collect()] == ["ok"]
    w = spark.createDataFrame([("x", "cs", 1)], "` Bigram ` string, Domain string, `2020` long")
    s = R.standardize_columns(w)
    assert s.columns == ["term", "category", "2020"]
    assert R.year_columns(s) == ["2020"]
    c = R.coerce_numeric(spark.createDataFrame([("1.5",), ("x",), (None,)], "`2020` string"), ["2020"])
    assert [r[0] for r in c.collect()] == [1.5, 0.0, 0.0]


def test_rolling_mean_golden(spark):
    # Climate Change 2020Q1..2021Q2 from the reference's quarterly file
    counts = [30, 10, 11, 7, 6, 18]
    periods = ["2020Q1", "2020Q2", "2020Q3", "2020Q4", "2021Q1", "2021Q2"]
    df = spark.createDataFrame([("Climate Change", p, c) for p, c in zip(periods, counts)], "topic string, period string, count long")
    got = [r.rolling_mean for r in RK.rolling_mean(df, "topic", "period", "count").orderBy("period").collect()]
    assert got == [30, 20, 17, 14.5, 8.5, 10.5]


def test_top_terms_rows_semi(spark):
    rows = [("c", f"t{i}", 2020, i) for i in range(20)] + [("c", "t19", 2021, 1)]
    got = RK.top_terms_rows(terms_df(spark, rows), 3)
    assert sorted({r.term for r in got.collect()}) == ["t17", "t18", "t19"]
    assert got.count() == 4


def test_median_growth(spark):
    g = spark.createDataFrame([("c", 1.0), ("c", 3.0), ("c", 10.0), ("c", 4.0)], "category string, growth_percent double")
    assert T.median_growth(g).first().median_growth == pytest.approx(3.5)
    assert not math.isnan(3.5)


def test_approx_quantiles_close(spark):
    from lexitrend.operators import aggregates as AG
    df = spark.range(1, 1001).select(F.lit("s").alias("topic"), F.col("id").alias("count"))
    ex = AG.box_summary(df).first()
    ap = AG.box_summary(df, exact=False).first()
    assert abs(ex.median - ap.median) <= 2 and abs(ex.q1 - ap.q1) <= 2 and abs(ex.q3 - ap.q3) <= 2
    g = spark.createDataFrame([("c", float(i)) for i in range(101)], "category string, growth_percent double")
    assert T.median_growth(g, exact=False).first().median_growth == pytest.approx(50.0, abs=1.0)


def test_missing_domain_total_drops_row(spark):
    t = terms_df(spark, [("c", "a", 2020, 5), ("c", "a", 2021, 5), ("d", "a", 2020, 5)])
    d = domains_df(spark, [("c", 2020, 10)])
    got = sorted((r.category, r.year) for r in T.join_domain_totals(t, d).collect())
    assert got == [("c", 2020)]   # (c, 2021) and (d, 2020) have no total: inner join drops them


def test_fits_do_not_depend_on_the_order_of_rows(spark):
    """H3 and H5 give the same bits for 1 and 8 partitions and any order of the rows."""
    import random
    r = random.Random(5)
    terms = [("c", f"t{k}", y, r.randint(1, 10 ** 9)) for k in range(30) for y in range(2015, 2026)]
    norm = [("c", f"t{k}", y, r.random() * 10 ** r.randint(0, 4) + 1) for k in range(30) for y in range(2015, 2026)]
    seen = set()
    for n in (1, 8):
        for _ in range(3):
            r.shuffle(terms)
            r.shuffle(norm)
            t = spark.createDataFrame(terms, "category string, term string, year int, count long").repartition(n)
            m = spark.createDataFrame(norm, "category string, term string, year int, norm_freq double").repartition(n)
            a = sorted((x.term, x.year, x.prediction.hex()) for x in T.predict_term(t, 2025).collect())
            b = sorted((x.term, *[x[c].hex() for c in ("slope", "intercept", "r2")]) for x in T.normalized_trends(m, 2019, 2025).collect())
            seen.add(str((a, b)))
    assert len(seen) == 1


def test_prediction_of_zero_has_no_noise(spark):
    """A line through zero at the predicted year: exactly 0.0, positive."""
    import math
    df = spark.createDataFrame([("c", "t", 2020 + k, 30 - 10 * k) for k in range(3)], "category string, term string, year int, count long")
    p = {x.year: x.prediction for x in T.predict_term(df, 2022).collect()}
    assert p == {2023: 0.0, 2024: -10.0, 2025: -20.0} and math.copysign(1, p[2023]) == 1


def test_trends_of_nothing(spark):
    df = spark.createDataFrame([], "category string, term string, year int, norm_freq double")
    assert T.normalized_trends(df, 0, -1).collect() == []


def test_growth_without_any_realistic_term(spark, tmp_path):
    """Every term has a year above the cap: no year columns are left, and no rows."""
    from datetime import date

    from lexitrend.plans import q_trends as QT
    spark.createDataFrame([(1, "PROMO", "a b")], "p_partkey long, p_type string, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    (spark.createDataFrame([(i, 1, date(1996 + i % 2, 1, 1)) for i in range(80)],
                           "l_orderkey long, l_partkey long, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet"))
    got = QT.h2_growth_realistic(spark, str(tmp_path))
    assert got.columns == ["category", "term", "cagr", "growth_percent", "volume"] and got.collect() == []
