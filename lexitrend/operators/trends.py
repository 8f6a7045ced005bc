"""Trend analytics on long term tables.

Inputs are long tables:
  terms   (category, term, year, count)
  domains (category, year, total_papers)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K
from .joins import join_small
from .quantiles import exact_percentiles


def year_bounds(df: DataFrame, col: str = "year") -> tuple[int, int]:
    """Smallest and largest year: one scalar aggregate (bounded metadata)."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if r is None or r["lo"] is None:
        return (0, -1)
    return int(r["lo"]), int(r["hi"])


def year_list(df: DataFrame, col: str = "year", between: tuple[int, int] | None = None) -> list[int]:
    """The distinct years, all of them or those in a range that the caller's chart has."""
    rows = df.where(F.col(col).between(*between)) if between else df.where(F.col(col).isNotNull())
    return sorted(int(r[0]) for r in rows.select(col).distinct().collect())


def training_window(max_year: int, min_year: int, back: int = K.TRAIN_YEARS_BACK) -> tuple[int, int]:
    """H8: (max_year - back floored at min_year, max_year); six years for back=5."""
    return (max_year - back if max_year - back >= min_year else min_year, max_year)


def category_key(c: Column | str) -> Column:
    """Lower-cased, trimmed category name, for tables that spell the same category differently."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def join_domain_totals(terms: DataFrame, domains: DataFrame, materialised: bool = False,
                       loose_keys: bool = False) -> DataFrame:
    """inner equi-join on (category, year); missing totals read as 1 (B18).  ``loose_keys`` matches
    categories by ``category_key`` (the terms' spelling is kept; totals of one key are summed).

    The domain side is an aggregate (categories x years): it is broadcast
    behind a row-count check (``join_small``), because the few distinct
    (category, year) keys would make a shuffle join put a hot cell in one task.
    """
    d = domains.select("category", "year",
                       F.coalesce(F.col("total_papers").cast("double"), F.lit(1.0)).alias("total_papers"))
    if not loose_keys:
        return join_small(terms, d, ["category", "year"], "inner", materialised=materialised)
    d = (d.groupBy(category_key("category").alias("_key"), "year").agg(F.sum("total_papers").alias("total_papers")))
    return join_small(terms.withColumn("_key", category_key("category")), d, ["_key", "year"]).drop("_key")


def norm_freq(count: Column | str = "count", total: Column | str = "total_papers") -> Column:
    """H1: count / total * 10,000; a zero total gives null (not inf)."""
    c = F.col(count) if isinstance(count, str) else count
    t = F.col(total) if isinstance(total, str) else total
    return F.try_divide(c.cast("double"), t.cast("double")) * F.lit(K.NORM_SCALE)


def dense_term_years(terms: DataFrame, years: list[int]) -> DataFrame:
    """Zero-filled (category, term, year, count) over the given year columns.

    One aggregate per (category, term) keeps a year -> count map (at most
    len(years) entries), then a narrow explode over the fixed year list.
    """
    yrs = F.array(*[F.lit(int(y)) for y in years]) if years else F.array().cast("array<int>")
    # rows of one (category, term, year) are summed first: a repeated key would fail the map
    m = (terms.where(F.col("year").isin(years) if years else F.lit(False))
         .groupBy("category", "term", "year").agg(F.sum("count").alias("count"))
         .groupBy("category", "term")
         .agg(F.map_from_entries(F.collect_list(F.struct(F.col("year").cast("int"), F.col("count").cast("double")))).alias("m")))
    return (m.select("category", "term", F.explode(yrs).alias("year"), "m")
            .select("category", "term", "year",
                    F.coalesce(F.try_element_at("m", F.col("year")), F.lit(0.0)).alias("count")))


def normalized_long(terms: DataFrame, domains: DataFrame, materialised: bool = False,
                    cap: float = K.NORM_FREQ_CAP) -> DataFrame:
    """Load-and-normalise: zero-filled long term table joined with domain
    totals, norm_freq added, outliers (>= ``cap``, inf, NaN, null) removed (B25)."""
    years = year_list(terms)
    dense = dense_term_years(terms, years)
    merged = join_domain_totals(dense, domains.where(F.col("year").isin(years) if years else F.lit(False)),
                                materialised=materialised)
    merged = merged.withColumn("norm_freq", norm_freq())
    return merged.where(F.col("norm_freq") < cap)


def normalized_trends(merged: DataFrame, start: int, end: int) -> DataFrame:
    """H3: per (category, term) OLS of norm_freq on year inside [start, end].

    Kept when there are >= 2 points and the end-year value exists and is >= 1.  One partial+final
    aggregate on (category, term), hot keys combined map-side, gives a column per year of the window
    (``merged`` has one row per year); the fit sums them in the order of the years, so it has the same
    bits however the rows were partitioned.
    """
    if end < start:  # no years at all
        names = ("slope", "intercept", "r2", "current_norm")
        return merged.select("category", "term", *[F.lit(None).cast("double").alias(c) for c in names]).where(F.lit(False))
    years = range(start, end + 1)
    y = F.col("norm_freq")
    g = (merged.where(F.col("year").between(start, end)).groupBy("category", "term")
         .agg(*[F.max(F.when(F.col("year") == k, y)).alias(f"y{k}") for k in years]))
    points = [(k - start, F.col(f"y{k}")) for k in years]
    g = g.where(F.col(f"y{end}") >= 1).withColumns({"n": _over(points, lambda x, y: F.lit(1.0)),
                                                    "sx": _over(points, lambda x, y: x),
                                                    "sy": _over(points, lambda x, y: y)})
    g = g.where("n >= 2").withColumns({"mx": F.col("sx") / F.col("n"), "my": F.col("sy") / F.col("n")})
    dx, dy = (lambda x: x - F.col("mx")), (lambda y: y - F.col("my"))
    g = g.withColumns({"sxx": _over(points, lambda x, y: dx(x) * dx(x)), "sxy": _over(points, lambda x, y: dx(x) * dy(y)),
                       "syy": _over(points, lambda x, y: dy(y) * dy(y)),
                       "flat": F.least(*[y for _, y in points], F.lit(None)) == F.greatest(*[y for _, y in points], F.lit(None))})
    slope = F.col("sxy") / F.col("sxx")
    r2 = F.when(F.col("flat") | (F.col("syy") == 0), F.lit(0.0)).otherwise(
        F.col("sxy") * F.col("sxy") / (F.col("sxx") * F.col("syy")))
    return g.select("category", "term", slope.alias("slope"),
                    (F.col("my") - slope * (F.col("mx") + F.lit(float(start)))).alias("intercept"),
                    r2.alias("r2"), F.col(f"y{end}").alias("current_norm"))


def _over(points: list[tuple[int, Column]], term) -> Column:
    """Sum of term(x, y) over the points whose y is there, in their order."""
    out = F.lit(0.0)
    for x, y in points:
        out = out + F.when(y.isNotNull(), term(F.lit(float(x)), y)).otherwise(F.lit(0.0))
    return out


def top_trends(trends: DataFrame, n: int = K.TREND_TOP_N, r2_min: float = K.TREND_R2_MIN) -> DataFrame:
    """Best n terms per category by slope (ties: term) among r2 > r2_min.

    ``row_number() <= n`` is planned with a partial WindowGroupLimit before
    the shuffle, so a huge category sends only n rows per map task.
    """
    w = W.partitionBy("category").orderBy(F.desc("slope"), F.asc("term"))
    return (trends.where(F.col("r2") > r2_min)
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= n))


def term_history(merged: DataFrame) -> DataFrame:
    """H7: full history of each (category, term) as year-sorted arrays
    (bounded by the number of year columns)."""
    h = (merged.groupBy("category", "term")
         .agg(F.array_sort(F.collect_list(F.struct(F.col("year").cast("int").alias("year"),
                                                   F.col("norm_freq").alias("norm_freq")))).alias("h")))
    return h.select("category", "term",
                    F.transform("h", lambda e: e["year"]).alias("history_x"),
                    F.transform("h", lambda e: e["norm_freq"]).alias("history_y"))


def forecast(trends: DataFrame, end: int, target: int = K.FORECAST_TARGET_YEAR) -> DataFrame:
    """H4: slope*year + intercept for years end+1..target, clamped at 0."""
    if target <= end:
        return trends.select("category", "term", F.lit(None).cast("int").alias("year"),
                             F.lit(None).cast("double").alias("forecast")).where(F.lit(False))
    return (trends.select("category", "term", "slope", "intercept",
                          F.explode(F.sequence(F.lit(end + 1), F.lit(target))).alias("year"))
            .select("category", "term", "year",
                    F.greatest(F.lit(0.0), F.col("slope") * F.col("year") + F.col("intercept")).alias("forecast")))


def fitted_line(trends: DataFrame, merged: DataFrame, start: int, end: int) -> DataFrame:
    """H6: the learned line over the training years of each term's history."""
    pts = merged.where(F.col("year").between(start, end)).select("category", "term", "year")
    return (pts.join(trends.select("category", "term", "slope", "intercept"), ["category", "term"])
            .select("category", "term", "year",
                    (F.col("slope") * F.col("year") + F.col("intercept")).alias("fitted")))


def growth_window(years: list[int]) -> tuple[int, int]:
    """H2: (last year - 10 floored at the first, last year) of the year columns; (0, -1) if there are none."""
    if not years:
        return (0, -1)
    return (max(max(years) - 10, min(years)), max(years))


def growth(terms_dense: DataFrame, start: int, end: int) -> DataFrame:
    """H2: CAGR between two year columns per (category, term).

    start > 0 and end >= 5; CAGR = (end/start)^(1/max(1, end-start)) - 1;
    growth_percent = 100*CAGR < 5,000; volume = end value.
    """
    span = max(1, end - start)
    g = (terms_dense.where(F.col("year").isin(start, end))
         .groupBy("category", "term")
         .agg(F.sum(F.when(F.col("year") == start, F.col("count"))).cast("double").alias("start_count"),
              F.sum(F.when(F.col("year") == end, F.col("count"))).cast("double").alias("end_count")))
    g = g.where((F.col("start_count") > 0) & (F.col("end_count") >= K.GROWTH_MIN_END))
    cagr = F.pow(F.col("end_count") / F.col("start_count"), F.lit(1.0 / span)) - F.lit(1.0)
    return (g.select("category", "term", cagr.alias("cagr"), (cagr * 100).alias("growth_percent"),
                     F.col("end_count").alias("volume"))
            .where(F.col("growth_percent") < K.GROWTH_PCT_CAP))


def median_growth(growth_df: DataFrame, exact: bool = True, accuracy: int = 10000, unbounded: bool = False) -> DataFrame:
    """Median growth percent per category.  ``exact`` (linear
    interpolation) suits the bounded per-category term lists (C5 keeps 1000
    per category and n); ``unbounded`` gives the same for lists of any length;
    ``exact=False`` is the bounded-memory sketch."""
    if unbounded:
        return (exact_percentiles(growth_df, ["category"], "growth_percent", [0.5])
                .select("category", F.col("q")[0].alias("median_growth")))
    m = (F.percentile("growth_percent", 0.5) if exact
         else F.percentile_approx("growth_percent", 0.5, accuracy).cast("double"))
    return growth_df.groupBy("category").agg(m.alias("median_growth"))


def exact_moments(x: Column, y: Column) -> list[Column]:
    """n, sx, sy, sxx and sxy of integer points as decimal sums: exact, so their order does not matter."""
    x, y = x.cast("decimal(10,0)"), y.cast("decimal(18,0)")
    return [F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
            F.sum((x * x).cast("decimal(20,0)")).alias("sxx"), F.sum((x * y).cast("decimal(28,0)")).alias("sxy")]


def predict_term(terms: DataFrame, last_year: int, horizon: int = K.PREDICT_HORIZON,
                 min_points: int = K.PREDICT_MIN_POINTS) -> DataFrame:
    """H5: per term, counts summed over categories, years with count > 0,
    >= min_points points, OLS; the next ``horizon`` years after the last year
    column; not clamped.

    Counts and years are integers, so the line's value is one quotient of exact integers (years are
    counted from the last one): the same bits in every run, and no noise around zero."""
    per_year = (terms.groupBy("term", "year").agg(F.sum("count").alias("count"))
                .where(F.col("count") > 0))
    fit = (per_year.groupBy("term").agg(*exact_moments(F.col("year") - F.lit(last_year), F.col("count")))
           .where(F.col("n") >= min_points))
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("n", "sx", "sy", "sxx", "sxy")}
    spread = wide["n"] * wide["sxx"] - wide["sx"] * wide["sx"]
    rise = wide["n"] * wide["sxy"] - wide["sx"] * wide["sy"]
    base = wide["sy"] * wide["sxx"] - wide["sx"] * wide["sxy"]
    ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("ahead")
    return (fit.select("term", spread.alias("spread"), rise.alias("rise"), base.alias("base"), ahead)
            .select("term", (F.lit(last_year) + F.col("ahead")).alias("year"),
                    F.try_divide((F.col("rise") * F.col("ahead") + F.col("base")).cast("double"),
                                 F.col("spread").cast("double")).alias("prediction")))
