"""Known results as literals, so that they are checked wherever the tests run."""

import pytest

from lexitrend.functions.dates import quarter_label_to_float
from lexitrend.operators import aggregates as AG
from lexitrend.operators import ranking as RK
from lexitrend.operators import trends as T

COUNTS_2020Q1 = {"Artificial Intelligence": 2, "Climate Change": 15, "Covid Pandemic": 2, "Electric Vehicle": 1,
                 "Large Language": 0, "Machine Learning": 34, "Public Health": 0, "Renewable Energy": 5, "Social Distancing": 6}
PERCENT_2020Q1 = {"Artificial Intelligence": 3.076923, "Climate Change": 23.076923, "Covid Pandemic": 3.076923,
                  "Electric Vehicle": 1.538462, "Large Language": 0, "Machine Learning": 52.307692, "Public Health": 0,
                  "Renewable Energy": 7.692308, "Social Distancing": 9.230769}


def test_composition_of_a_period(spark):
    df = spark.createDataFrame([(t, "2020Q1", n) for t, n in COUNTS_2020Q1.items()], "topic string, period string, count long")
    got = {r.topic: r.percentage for r in AG.composition(df).collect()}
    assert got == {t: pytest.approx(p, abs=1e-6) for t, p in PERCENT_2020Q1.items()}


def test_rolling_mean_of_four(spark):
    counts = [30, 10, 11, 7, 6, 18]
    periods = ["2020Q1", "2020Q2", "2020Q3", "2020Q4", "2021Q1", "2021Q2"]
    df = spark.createDataFrame([("Climate Change", p, n) for p, n in zip(periods, counts, strict=True)],
                               "topic string, period string, count long")
    rows = RK.rolling_mean(df, "topic", "period", "count").orderBy("period").collect()
    column = next(c for c in rows[0].asDict() if c not in ("topic", "period", "count"))
    assert [r[column] for r in rows] == [30, 20, 17, 14.5, 8.5, 10.5]


def test_normalised_frequency(spark):
    assert spark.range(1).select(T.norm_freq(T.F.lit(150), T.F.lit(2994))).first()[0] == pytest.approx(501.0020040080)


def test_quarter_order(spark):
    df = spark.createDataFrame([("2025Q3",)], "p string")
    assert df.select(quarter_label_to_float("p")).first()[0] == 2025.3
