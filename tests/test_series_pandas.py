"""E1, D10, D12 against pandas / numpy on random series."""

import numpy as np
import pandas as pd
import pytest

from lexitrend.operators import aggregates as AG
from lexitrend.operators import ranking as RK


def random_series(seed=3, topics=5, periods=17):
    rng = np.random.default_rng(seed)
    rows = []
    for t in range(topics):
        for i in range(periods):
            rows.append((f"T{t}", f"{2018 + i // 4}Q{i % 4 + 1}", int(rng.integers(0, 60))))
    return rows


def test_rolling_mean_matches_pandas(spark):
    rows = random_series()
    df = spark.createDataFrame(rows, "topic string, period string, count long")
    got = {(r.topic, r.period): r.rolling_mean for r in RK.rolling_mean(df, "topic", "period", "count").collect()}
    pdf = pd.DataFrame(rows, columns=["topic", "period", "count"]).sort_values(["topic", "period"])
    pdf["rm"] = pdf.groupby("topic")["count"].transform(lambda s: s.rolling(4, min_periods=1).mean())
    for r in pdf.itertuples():
        assert got[(r.topic, r.period)] == pytest.approx(r.rm)


def test_box_and_dispersion_match_numpy(spark):
    rows = random_series(seed=11)
    df = spark.createDataFrame(rows, "topic string, period string, count long")
    box = {r.topic: r for r in AG.box_summary(df).collect()}
    pdf = pd.DataFrame(rows, columns=["topic", "period", "count"])
    for t, g in pdf.groupby("topic"):
        v = g["count"].to_numpy()
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= lo) & (v <= hi)]
        b = box[t]
        assert (b.q1, b.median, b.q3) == pytest.approx((q1, med, q3))
        assert (b.whisker_lo, b.whisker_hi, b.n_outliers) == (inside.min(), inside.max(), len(v) - len(inside))
    y = AG.yearly_totals(df)
    disp = {(r.year, r.topic): r for r in AG.year_dispersion(y).collect()}
    pdf["year"] = pdf["period"].str[:4].astype(int)
    yt = pdf.groupby(["year", "topic"])["count"].sum().reset_index()
    for yr, g in yt.groupby("year"):
        mu = g["count"].mean()
        mad = np.mean(np.abs(g["count"] - mu))
        for r in g.itertuples():
            d = disp[(yr, r.topic)]
            assert d.year_mean == pytest.approx(mu) and d.year_mad == pytest.approx(mad)
            assert d.above_mean == (r.count > mu)


def test_single_row_series_std_zero(spark):
    df = spark.createDataFrame([("solo", "2020Q1", 7), ("pair", "2020Q1", 1), ("pair", "2020Q2", 3)],
                               "topic string, period string, count long")
    st = {r.topic: (r.mean, r.std) for r in AG.series_stats(df).collect()}
    assert st["solo"] == (7.0, 0.0)
    assert st["pair"][1] == pytest.approx(np.std([1, 3], ddof=1))
