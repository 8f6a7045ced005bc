"""Trend group: term-table queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..session import checkpoint_path, ensure_checkpoint_dir
from ..sources import sinks as SK
from ..operators import ranking as RK
from ..operators import reshape as R
from ..operators import trends as T
from . import standins as S
from .registry import register


def r6(c):
    return F.round(c, 6)


def _base(spark: SparkSession, sf: str, domains: bool = True):
    """The long term table and the domain totals, each materialised once in
    the shared checkpoint folder: the trend queries read them several times
    (year list, training window, the query itself), and both are small
    aggregates of the big scans."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    terms = S.term_year(spark, sf).checkpoint(eager=True)
    dom = S.domain_year(spark, sf).checkpoint(eager=True) if domains else None
    return terms, dom


def _domains(spark: SparkSession, sf: str) -> DataFrame:
    """The domain totals alone, materialised once."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return S.domain_year(spark, sf).checkpoint(eager=True)


def _merged(spark, sf):
    terms, domains = _base(spark, sf)
    # the bounds and the query both read it: materialised once
    merged = T.normalized_long(terms, domains, materialised=True).checkpoint(eager=True)
    lo, hi = T.year_bounds(merged)
    start, end = T.training_window(hi, lo)
    return terms, domains, merged, start, end


# ---------------------------------------------------------------- SQL pieces
MERGED_SQL = S.with_ctes(S.TERM_YEAR_SQL, S.DOMAIN_YEAR_SQL, """years AS (
  SELECT DISTINCT year FROM term_year)""", """pairs AS (
  SELECT DISTINCT category, term FROM term_year)""", """dense AS (
  SELECT p.category, p.term, y.year, CAST(coalesce(t.count, 0) AS DOUBLE) AS count
  FROM pairs p CROSS JOIN years y
  LEFT JOIN term_year t ON t.category = p.category AND t.term = p.term AND t.year = y.year)""", """merged0 AS (
  SELECT d.category, d.term, d.year, d.count,
         CAST(coalesce(dy.total_papers, 1) AS DOUBLE) AS total_papers,
         d.count / nullif(CAST(coalesce(dy.total_papers, 1) AS DOUBLE), 0) * 10000 AS norm_freq
  FROM dense d JOIN domain_year dy ON d.category = dy.category AND d.year = dy.year)""", """merged AS (
  SELECT * FROM merged0 WHERE norm_freq < 50000)""", """win AS (
  SELECT CASE WHEN max(year) - 5 >= min(year) THEN max(year) - 5 ELSE min(year) END AS s,
         max(year) AS e FROM merged)""", """trends AS (
  SELECT category, term,
         regr_slope(norm_freq, CAST(year AS DOUBLE)) AS slope,
         regr_intercept(norm_freq, CAST(year AS DOUBLE)) AS intercept,
         CASE WHEN min(norm_freq) = max(norm_freq) THEN 0.0
              ELSE regr_r2(norm_freq, CAST(year AS DOUBLE)) END AS r2,
         max(CASE WHEN year = e THEN norm_freq END) AS current_norm
  FROM merged, win WHERE year BETWEEN s AND e
  GROUP BY category, term
  HAVING count(*) >= 2 AND max(CASE WHEN year = e THEN norm_freq END) >= 1)""", """top AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY slope DESC, term) AS INTEGER) AS rank
    FROM trends WHERE r2 > 0.5) WHERE rank <= 5)""")


# ---------------------------------------------------------------- E6 / H3
def top_trends(spark: SparkSession, sf: str) -> DataFrame:
    _, _, merged, start, end = _merged(spark, sf)
    top = T.top_trends(T.normalized_trends(merged, start, end))
    return top.select("category", "term", r6("slope").alias("slope"), F.round("intercept", 4).alias("intercept"),
                      r6("r2").alias("r2"), r6("current_norm").alias("current_norm"),
                      F.col("rank").cast("int").alias("rank"))


register("e6_top_trends", MERGED_SQL + """
SELECT category, term, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r2, 6) AS r2,
       round(current_norm, 6) AS current_norm, rank FROM top""")(top_trends)


@register("h3_term_trend", MERGED_SQL + """
SELECT category, term, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r2, 6) AS r2,
       round(current_norm, 6) AS current_norm FROM trends""")
def h3_term_trend(spark, sf):
    _, _, merged, start, end = _merged(spark, sf)
    t = T.normalized_trends(merged, start, end)
    return t.select("category", "term", r6("slope").alias("slope"), F.round("intercept", 4).alias("intercept"),
                    r6("r2").alias("r2"), r6("current_norm").alias("current_norm"))


@register("h1_norm_freq", MERGED_SQL + """
SELECT category, term, year, count, total_papers, round(norm_freq, 6) AS norm_freq FROM merged""")
def h1_norm_freq(spark, sf):
    """F1 + H1 + B18 + B25 on the zero-filled long table."""
    _, _, merged, _, _ = _merged(spark, sf)
    return merged.select("category", "term", F.col("year").cast("int").alias("year"), "count",
                         "total_papers", r6("norm_freq").alias("norm_freq"))


@register("h8_training_window", MERGED_SQL + """
SELECT CAST(s AS INTEGER) AS train_start, CAST(e AS INTEGER) AS train_end FROM win""")
def h8_training_window(spark, sf):
    _, _, merged, _, _ = _merged(spark, sf)
    b = merged.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    return b.select(F.when(F.col("hi") - 5 >= F.col("lo"), F.col("hi") - 5).otherwise(F.col("lo"))
                    .cast("int").alias("train_start"), F.col("hi").cast("int").alias("train_end"))


@register("h4_forecast", MERGED_SQL + """
SELECT category, term, CAST(y.year AS INTEGER) AS year,
       round(greatest(0.0, slope * y.year + intercept), 4) AS forecast
FROM top, win, (SELECT unnest(range(CAST((SELECT e FROM win) AS BIGINT) + 1, 2031)) AS year) y""")
def h4_forecast(spark, sf):
    _, _, merged, start, end = _merged(spark, sf)
    top = T.top_trends(T.normalized_trends(merged, start, end))
    f = T.forecast(top, end, K.FORECAST_TARGET_YEAR)
    return f.select("category", "term", F.col("year").cast("int").alias("year"),
                    F.round("forecast", 4).alias("forecast"))


@register("h6_fitted_line", MERGED_SQL + """
SELECT m.category, m.term, CAST(m.year AS INTEGER) AS year, round(t.slope * m.year + t.intercept, 4) AS fitted
FROM merged m JOIN top t ON m.category = t.category AND m.term = t.term, win
WHERE m.year BETWEEN s AND e""")
def h6_fitted_line(spark, sf):
    _, _, merged, start, end = _merged(spark, sf)
    top = T.top_trends(T.normalized_trends(merged, start, end))
    f = T.fitted_line(top, merged, start, end)
    return f.select("category", "term", F.col("year").cast("int").alias("year"), F.round("fitted", 4).alias("fitted"))


@register("h7_term_history", MERGED_SQL + """
SELECT t.category, t.term,
       list(CAST(m.year AS INTEGER) ORDER BY m.year) AS history_x,
       list(round(m.norm_freq, 6) ORDER BY m.year) AS history_y
FROM top t JOIN merged m ON m.category = t.category AND m.term = t.term
GROUP BY t.category, t.term""")
def h7_term_history(spark, sf):
    _, _, merged, start, end = _merged(spark, sf)
    top = T.top_trends(T.normalized_trends(merged, start, end)).select("category", "term")
    h = T.term_history(merged.join(top, ["category", "term"], "left_semi"))
    return h.select("category", "term", "history_x",
                    F.transform("history_y", lambda v: F.round(v, 6)).alias("history_y"))


GROWTH_SQL = MERGED_SQL.replace("WITH ", "WITH ", 1) + """, gwin AS (
  SELECT CASE WHEN max(year) - 10 >= min(year) THEN max(year) - 10 ELSE min(year) END AS gs,
         max(year) AS ge FROM dense),
  g0 AS (
  SELECT category, term,
         sum(CASE WHEN year = gs THEN count END) AS start_count,
         sum(CASE WHEN year = ge THEN count END) AS end_count, max(ge) - max(gs) AS span
  FROM dense, gwin GROUP BY category, term),
  growth AS (
  SELECT category, term, pow(end_count / start_count, 1.0 / greatest(span, 1)) - 1 AS cagr,
         (pow(end_count / start_count, 1.0 / greatest(span, 1)) - 1) * 100 AS growth_percent,
         end_count AS volume
  FROM g0 WHERE start_count > 0 AND end_count >= 5
    AND (pow(end_count / start_count, 1.0 / greatest(span, 1)) - 1) * 100 < 5000)
"""


def _growth(spark, sf):
    terms, _ = _base(spark, sf, domains=False)
    years = T.year_list(terms)
    dense = T.dense_term_years(terms, years)
    start, hi = T.growth_window(years)
    return T.growth(dense, start, hi)


@register("h2_growth", GROWTH_SQL + """
SELECT category, term, round(cagr, 6) AS cagr, round(growth_percent, 6) AS growth_percent, volume FROM growth""")
def h2_growth(spark, sf):
    g = _growth(spark, sf)
    return g.select("category", "term", r6("cagr").alias("cagr"), r6("growth_percent").alias("growth_percent"), "volume")


@register("d19_median_growth", GROWTH_SQL + """
SELECT category, round(quantile_cont(growth_percent, 0.5), 6) AS median_growth FROM growth GROUP BY category""")
def d19_median_growth(spark, sf):
    m = T.median_growth(_growth(spark, sf))
    return m.select("category", r6("median_growth").alias("median_growth"))


@register("h5_predict", S.with_ctes(S.TERM_YEAR_SQL, """py AS (
  SELECT term, year, CAST(sum(count) AS DOUBLE) AS count FROM term_year GROUP BY term, year HAVING sum(count) > 0)""",
  """ly AS (
  SELECT max(year) AS y FROM term_year)""", """fit AS (
  SELECT term, count(*) * sum(x * x) - sum(x) * sum(x) AS spread, count(*) * sum(x * c) - sum(x) * sum(c) AS rise,
         sum(c) * sum(x * x) - sum(x) * sum(x * c) AS base
  FROM (SELECT term, CAST(year - ly.y AS HUGEINT) AS x, CAST(count AS HUGEINT) AS c FROM py, ly) GROUP BY term HAVING count(*) >= 3)""") + """
SELECT term, CAST(ly.y + k AS INTEGER) AS year,
       round(CAST(rise * k + base AS DOUBLE) / CAST(spread AS DOUBLE), 4) + 0.0 AS prediction
FROM fit, ly, (SELECT unnest(range(1, 4)) AS k)""")
def h5_predict(spark, sf):
    terms, _ = _base(spark, sf, domains=False)
    p = T.predict_term(terms, T.year_bounds(terms)[1])
    return p.select("term", F.col("year").cast("int").alias("year"), F.round("prediction", 4).alias("prediction"))


# ------------------------------------------------------- reshape / aggregates

# term rows that a chart's year range leaves: all of them, but for the sunburst
_RANGED = """ranged AS (SELECT * FROM term_year{})"""
DENSE_SQL = S.with_ctes(S.TERM_YEAR_SQL, _RANGED.format(""), """years AS (
  SELECT DISTINCT year FROM ranged)""", """pairs AS (
  SELECT DISTINCT category, term FROM ranged)""", """dense AS (
  SELECT p.category, p.term, CAST(y.year AS INTEGER) AS year, CAST(coalesce(t.count, 0) AS BIGINT) AS count
  FROM pairs p CROSS JOIN years y
  LEFT JOIN ranged t ON t.category = p.category AND t.term = p.term AND t.year = y.year)""", """tot AS (
  SELECT category, term, CAST(sum(count) AS BIGINT) AS total FROM ranged GROUP BY category, term)""")


def _dense(spark, sf, between=None):
    terms, _ = _base(spark, sf, domains=False)
    years = T.year_list(terms, between=between)
    terms = terms.where(F.col("year").isin(years))
    wide = R.pivot_years(terms, years)
    dense = R.unpivot_years(wide.drop("total"), ["category", "term"], [str(y) for y in years])
    return terms, years, wide, dense


@register("g3_pivot_wide", DENSE_SQL + f"""
SELECT d.category, d.term, {S.pivot_sql("d.year", S.SHIP_YEARS, "d.count")}, CAST(sum(d.count) AS BIGINT) AS total
FROM dense d GROUP BY d.category, d.term""")
def g3_pivot_wide(spark, sf):
    """G3 / C5 wide form: term x year matrix, 0-filled, with the row total."""
    return _dense(spark, sf)[2]


@register("g1_unpivot_long", DENSE_SQL + "SELECT category, term, year, count FROM dense")
def g1_unpivot_long(spark, sf):
    """G1: the wide matrix back to (category, term, year, count), zeros kept."""
    return _dense(spark, sf)[3]


@register("g2_domain_unpivot", S.with_ctes(S.DOMAIN_YEAR_SQL, """years AS (SELECT DISTINCT year FROM domain_year)""",
                                           """cats AS (SELECT DISTINCT category FROM domain_year)""") + """
SELECT c.category, CAST(y.year AS INTEGER) AS year, CAST(coalesce(d.total_papers, 0) AS BIGINT) AS total_papers
FROM cats c CROSS JOIN years y LEFT JOIN domain_year d ON d.category = c.category AND d.year = y.year""")
def g2_domain_unpivot(spark, sf):
    """D2-style domain x year pivot (0-filled), then G2 back to long form."""
    domains = _domains(spark, sf)
    years = T.year_list(domains)
    wide = (domains.groupBy("category").pivot("year", years).agg(F.first("total_papers"))
            .na.fill(0, subset=[str(y) for y in years]))
    long = R.unpivot_years(wide, ["category"], [str(y) for y in years], "total_papers")
    return long.select("category", "year", F.col("total_papers").cast("bigint").alias("total_papers"))


@register("d3_category_totals", S.with_ctes(S.TERM_YEAR_SQL) + """
SELECT category, CAST(sum(count) AS BIGINT) AS total FROM term_year GROUP BY category""")
def d3_category_totals(spark, sf):
    terms, _ = _base(spark, sf, domains=False)
    return terms.groupBy("category").agg(F.sum("count").cast("bigint").alias("total")).orderBy(F.desc("total"), "category")


def _categories(df: DataFrame) -> list[str]:
    """Distinct categories (bounded metadata: one per domain) for an explicit pivot."""
    return sorted(r[0] for r in df.select("category").distinct().collect())


@register("d4_year_by_category", S.with_ctes(S.TERM_YEAR_SQL) + f"""
SELECT year, {S.pivot_sql("category", S.PART_TYPES, "count")} FROM term_year WHERE year BETWEEN 1990 AND 2030 GROUP BY year""")
def d4_year_by_category(spark, sf):
    """Category x year sums transposed: one row per year of this chart's own range, one column
    per category, 0 where a category has no term in a year."""
    terms, _ = _base(spark, sf, domains=False)
    cats = _categories(terms)
    rows = terms.where(F.col("year").between(*K.YEAR_COLUMN_RANGE))
    return rows.groupBy("year").pivot("category", cats).agg(F.sum("count").cast("bigint")).na.fill(0, subset=cats)


def _d6_sql(k: int) -> str:
    return S.with_ctes(S.TERM_YEAR_SQL, """g AS (
  SELECT term, CAST(sum(count) AS BIGINT) AS total FROM term_year GROUP BY term)""", f"""top AS (
  SELECT * FROM g ORDER BY total DESC, term LIMIT {k})""") + """
SELECT term, total, round(total / (SELECT max(total) FROM top), 6) AS weight FROM top"""


@register("d6_wordcloud", _d6_sql(K.WORDCLOUD_MAX_WORDS))
def d6_wordcloud(spark, sf, k=K.WORDCLOUD_MAX_WORDS):
    """Global term frequency, largest 150 (a word-cloud parameter), weight relative to the max."""
    terms, _ = _base(spark, sf, domains=False)
    g = terms.groupBy("term").agg(F.sum("count").cast("bigint").alias("total"))
    top = g.orderBy(F.desc("total"), "term").limit(k)
    # the limit bounds this global window
    mx = F.max("total").over(W.partitionBy())
    return top.select("term", "total", r6(F.col("total") / mx).alias("weight"))


@register("d6_wordcloud_small", _d6_sql(20))
def d6_wordcloud_small(spark, sf):
    """D6 with 20 words, fewer than there are."""
    return d6_wordcloud(spark, sf, 20)


TOP12_SQL = DENSE_SQL.replace(_RANGED.format(""), _RANGED.format(
    " WHERE year BETWEEN {} AND {}".format(*K.SUNBURST_YEAR_RANGE))) + f""", top12 AS (
  SELECT category, term, total FROM (
    SELECT *, row_number() OVER (PARTITION BY category ORDER BY total DESC, term) AS rn FROM tot)
  WHERE rn <= {K.SUNBURST_TOP_N}),
  rows12 AS (SELECT d.* FROM dense d JOIN top12 t ON d.category = t.category AND d.term = t.term)
"""


def _top12_rows(spark, sf):
    _, _, _, dense = _dense(spark, sf, K.SUNBURST_YEAR_RANGE)
    return RK.top_terms_rows(dense, K.SUNBURST_TOP_N)


@register("e2_top_terms_rows", TOP12_SQL + "SELECT category, term, year, count FROM rows12")
def e2_top_terms_rows(spark, sf):
    """E2 + F2: top 12 terms per category by total, all their (0-filled) year rows."""
    return _top12_rows(spark, sf)


@register("d7_term_stats", TOP12_SQL + """
SELECT category, term, round(avg(count), 2) AS mean_count, round(stddev_samp(count), 2) AS std_count,
       CAST(max(count) AS BIGINT) AS max_count, CAST(sum(count) AS BIGINT) AS total
FROM rows12 GROUP BY category, term""")
def d7_term_stats(spark, sf):
    """D7 + F4: mean, sample std, max and total per term over its year rows, rounded to 2."""
    rows = _top12_rows(spark, sf)
    return rows.groupBy("category", "term").agg(
        F.round(F.avg("count"), 2).alias("mean_count"), F.round(F.stddev_samp("count"), 2).alias("std_count"),
        F.max("count").cast("bigint").alias("max_count"), F.sum("count").cast("bigint").alias("total"))


@register("d15_term_rollup", TOP12_SQL + """
SELECT category, term, CAST(sum(total) AS BIGINT) AS total FROM top12 GROUP BY ROLLUP (category, term)""")
def d15_term_rollup(spark, sf):
    """Category -> term hierarchy totals (sunburst rings) by ROLLUP."""
    terms, _ = _base(spark, sf, domains=False)
    tot = RK.totals(terms.where(F.col("year").between(*K.SUNBURST_YEAR_RANGE)), ["category", "term"])
    top = RK.top_n_per_group(tot, ["category"], "total", K.SUNBURST_TOP_N)
    return top.rollup("category", "term").agg(F.sum("total").cast("bigint").alias("total"))


@register("e3_top5_terms", DENSE_SQL + f"""
SELECT category, term, total, rank FROM (
  SELECT category, term, total, CAST(row_number() OVER (PARTITION BY category ORDER BY total DESC, term) AS INTEGER) AS rank
  FROM tot) WHERE rank <= {K.CATEGORY_TOP_N}""")
def e3_top5_terms(spark, sf):
    """Top 5 terms of each category by summed count."""
    terms, _ = _base(spark, sf, domains=False)
    tot = RK.totals(terms, ["category", "term"]).withColumn("total", F.col("total").cast("bigint"))
    return RK.top_n_per_group(tot, ["category"], "total", K.CATEGORY_TOP_N).withColumn("rank", F.col("rank").cast("int"))


@register("e4_bell_volume", DENSE_SQL + f"""
SELECT category, term, total, rank0,
       CASE WHEN rank0 = 0 THEN 0 WHEN rank0 % 2 = 1 THEN -CAST((rank0 + 1) // 2 AS INTEGER)
            ELSE CAST(rank0 // 2 AS INTEGER) END AS position
FROM (SELECT category, term, total,
             CAST(row_number() OVER (PARTITION BY category ORDER BY total DESC, term) - 1 AS INTEGER) AS rank0
      FROM tot) WHERE rank0 < {K.BELL_TOP_N}""")
def e4_bell_volume(spark, sf):
    """21 largest terms per category by volume arranged as a bell (odd ranks left)."""
    terms, _ = _base(spark, sf, domains=False)
    tot = RK.totals(terms, ["category", "term"]).withColumn("total", F.col("total").cast("bigint"))
    b = RK.bell_arrangement(tot, ["category"], "total", K.BELL_TOP_N, odd_left=True)
    return b.select("category", "term", "total", F.col("rank0").cast("int").alias("rank0"),
                    F.col("position").cast("int").alias("position"))


@register("d14_cross_pivot", S.with_ctes(S.TERM_YEAR_SQL, """tot AS (
  SELECT term, category, CAST(sum(count) AS BIGINT) AS total FROM term_year GROUP BY term, category)""",
  """gt AS (SELECT term, CAST(sum(total) AS BIGINT) AS grand_total FROM tot GROUP BY term)""") + f"""
SELECT tot.term, {S.pivot_sql("category", S.PART_TYPES, "total")}, g.grand_total
FROM tot JOIN gt g ON tot.term = g.term WHERE g.grand_total > 0 GROUP BY tot.term, g.grand_total""")
def d14_cross_pivot(spark, sf):
    """D14 (N form over all categories): term x category totals, 0-filled,
    Grand_Total, rows whose selected sum > 0."""
    terms, _ = _base(spark, sf, domains=False)
    cats = _categories(terms)
    p = terms.groupBy("term").pivot("category", cats).agg(F.sum("count").cast("bigint")).na.fill(0, subset=cats)
    p = p.withColumn("grand_total", R.row_total(cats).cast("bigint"))
    return p.where(F.col("grand_total") > 0)


@register("d16_distinct_categories", S.with_ctes(S.TERM_YEAR_SQL) + "SELECT DISTINCT category FROM term_year")
def d16_distinct_categories(spark, sf):
    """Sorted distinct category list."""
    terms, _ = _base(spark, sf, domains=False)
    return terms.select("category").distinct().orderBy("category")


@register("d16_distinct_terms", S.with_ctes(S.TERM_YEAR_SQL) + "SELECT DISTINCT category, term FROM term_year")
def d16_distinct_terms(spark, sf):
    """The sorted distinct terms of each category."""
    terms, _ = _base(spark, sf, domains=False)
    return terms.select("category", "term").distinct().orderBy("category", "term")


@register("d16_distinct_topics", S.with_ctes(S.TOPIC_PERIOD_SQL) + "SELECT DISTINCT topic FROM topic_period")
def d16_distinct_topics(spark, sf):
    """The sorted distinct topic labels of the quarterly series."""
    return S.topic_period(spark, sf).select("topic").distinct().orderBy("topic")


@register("h2_growth_realistic", GROWTH_SQL.replace("FROM term_year)", "FROM realistic)").replace(
    "LEFT JOIN term_year t", "LEFT JOIN realistic t").replace("years AS (", """realistic AS (
  SELECT t.* FROM term_year t ANTI JOIN (SELECT category, term FROM term_year GROUP BY category, term HAVING max(count) > 30) b
  ON t.category = b.category AND t.term = b.term), years AS (""", 1) + """
SELECT category, term, round(cagr, 6) AS cagr, round(growth_percent, 6) AS growth_percent, volume FROM growth""")
def h2_growth_realistic(spark, sf):
    """B20 before H2, in this chart's own year range: growth of the terms that no year's count
    disqualifies (here: above 30, so that the rule binds on the supplied tables)."""
    terms, _ = _base(spark, sf, domains=False)
    terms = R.drop_unrealistic_long(terms, ["category", "term"], 30).checkpoint(eager=True)
    years = T.year_list(terms, between=K.YEAR_COLUMN_RANGE)
    g = T.growth(T.dense_term_years(terms, years), *T.growth_window(years))
    return g.select("category", "term", r6("cagr").alias("cagr"), r6("growth_percent").alias("growth_percent"), "volume")


def _b20_sql(cap: int) -> str:
    return S.with_ctes(S.TERM_YEAR_SQL, f"""bad AS (
  SELECT category, term FROM term_year GROUP BY category, term HAVING max(count) > {cap})""") + """
SELECT t.* FROM term_year t ANTI JOIN bad b ON t.category = b.category AND t.term = b.term"""


@register("b20_drop_unrealistic", _b20_sql(K.MAX_REALISTIC_COUNT))
def b20_drop_unrealistic(spark, sf, cap=K.MAX_REALISTIC_COUNT):
    """Drop every row of a term with a yearly count above 200,000."""
    terms, _ = _base(spark, sf, domains=False)
    return R.drop_unrealistic_long(terms, ["category", "term"], cap)


@register("b20_drop_unrealistic_small", _b20_sql(30))
def b20_drop_unrealistic_small(spark, sf):
    """B20 with a cap of 30, which some terms pass."""
    return b20_drop_unrealistic(spark, sf, 30)


@register("h1_norm_freq_small_cap", MERGED_SQL.replace("norm_freq < 50000", "norm_freq < 200") + """
SELECT category, term, year, count, total_papers, round(norm_freq, 6) AS norm_freq FROM merged""")
def h1_norm_freq_small_cap(spark, sf):
    """H1 + B25 with an outlier cap of 200, which some rows pass."""
    terms, domains = _base(spark, sf)
    merged = T.normalized_long(terms, domains, materialised=True, cap=200)
    return merged.select("category", "term", F.col("year").cast("int").alias("year"), "count",
                         "total_papers", r6("norm_freq").alias("norm_freq"))


@register("d17_row_counts", S.with_ctes(S.TERM_YEAR_SQL, f"""bad AS (
  SELECT category, term FROM term_year GROUP BY category, term HAVING max(count) > {K.MAX_REALISTIC_COUNT})""") + """
SELECT CAST((SELECT count(*) FROM term_year) AS BIGINT) AS rows,
       CAST((SELECT count(*) FROM term_year t SEMI JOIN bad b ON t.category = b.category AND t.term = b.term) AS BIGINT) AS dropped""")
def d17_row_counts(spark, sf):
    """Table row count and the B20 drop counter in one aggregate pass."""
    terms, _ = _base(spark, sf, domains=False)
    mx = terms.groupBy("category", "term").agg(F.max("count").alias("mx"), F.count(F.lit(1)).alias("n"))
    return mx.agg(F.sum("n").cast("bigint").alias("rows"),
                  F.coalesce(F.sum(F.when(F.col("mx") > K.MAX_REALISTIC_COUNT, F.col("n"))), F.lit(0)).cast("bigint").alias("dropped"))


@register("e8_last_years", S.with_ctes(S.DOMAIN_YEAR_SQL) + """
SELECT category, year, total_papers FROM domain_year WHERE year > (SELECT max(year) FROM domain_year) - 5""")
def e8_last_years(spark, sf):
    """The last five year columns of the domain table (long form)."""
    domains = _domains(spark, sf)
    hi = T.year_bounds(domains)[1]
    return domains.where(F.col("year") > hi - 5)


# ------------------------------------------------------- wide adapters, labels, chart tables
@register("b17_wide_csv_adapter", DENSE_SQL + "SELECT category, term, year, count FROM dense")
def b17_wide_csv_adapter(spark, sf):
    """B17 + B18 + B21 + G1 + A3: the wide term table written as a CSV with
    loose headers (' Bigram ', 'Domain', year columns, 'Total'), read back
    as strings, names standardised, year columns found and coerced, then
    unpivoted to the long form."""
    _, years, wide, _ = _dense(spark, sf)
    loose = wide.select(F.col("term").alias(" Bigram "), F.col("category").alias("Domain"),
                        *[F.col(str(y)) for y in years], F.col("total").alias("Total"))
    path = checkpoint_path(spark, f"b17-wide-{uuid.uuid4().hex[:12]}")
    SK.write_csv(loose, path)
    raw = spark.read.option("header", True).option("escape", '"').csv(path)  # no text with line breaks
    std = R.standardize_columns(raw)
    ycols = R.year_columns(std)
    std = R.coerce_numeric(std, ycols)
    long = R.unpivot_years(std.select("category", "term", *ycols), ["category", "term"], ycols)
    return long.select("category", "term", "year", F.col("count").cast("bigint").alias("count"))


@register("b22_labels", TOP12_SQL + """
SELECT DISTINCT category || ' - ' || term AS label, split_part(category || ' - ' || term, ' - ', 1) AS label_category,
       split_part(category || ' - ' || term, ' - ', 2) AS label_term FROM rows12""")
def b22_labels(spark, sf):
    """B22 + G5: 'category - term' labels of the top-12 terms and the split back."""
    rows = _top12_rows(spark, sf).select("category", "term").dropDuplicates()
    lab = rows.select(R.label("category", "term").alias("label"))
    c, t = R.split_label("label")
    return lab.select("label", c.alias("label_category"), t.alias("label_term"))


PAIR_SQL = S.with_ctes(S.TERM_YEAR_SQL, """cats AS (
  SELECT category, row_number() OVER (ORDER BY category) AS k FROM (SELECT DISTINCT category FROM term_year))""",
  """tot AS (SELECT term, category, sum(count) AS total FROM term_year GROUP BY term, category)""", """pair AS (
  SELECT t.term,
         CAST(coalesce(sum(CASE WHEN c.k = 1 THEN total END), 0) AS BIGINT) AS cat1,
         CAST(coalesce(sum(CASE WHEN c.k = 2 THEN total END), 0) AS BIGINT) AS cat2
  FROM tot t JOIN cats c ON t.category = c.category GROUP BY t.term)""")


@register("d14_pair_relation", PAIR_SQL + """
SELECT term, cat1, cat2, cat1 + cat2 AS total FROM pair WHERE cat1 > 0 OR cat2 > 0""")
def d14_pair_relation(spark, sf, pair=None):
    """D14 pair form: term totals in two categories (``pair``; by default the first two by name),
    rows with either > 0, and their sum."""
    terms, _ = _base(spark, sf, domains=False)
    cats = list(pair or _categories(terms)[:2])
    p = (terms.where(F.col("category").isin(cats)).groupBy("term").pivot("category", cats)
         .agg(F.sum("count").cast("bigint")).na.fill(0, subset=cats))
    p = p.select("term", F.col(f"`{cats[0]}`").alias("cat1"), F.col(f"`{cats[1]}`").alias("cat2"))
    return p.where((F.col("cat1") > 0) | (F.col("cat2") > 0)).withColumn("total", F.col("cat1") + F.col("cat2"))


@register("d15_term_distribution", S.with_ctes(S.TERM_YEAR_SQL, """best AS (
  SELECT term FROM term_year GROUP BY term ORDER BY sum(count) DESC, term LIMIT 1)""") + """
SELECT t.term, category, CAST(sum(count) AS BIGINT) AS total FROM term_year t JOIN best b ON t.term = b.term
GROUP BY t.term, category""")
def d15_term_distribution(spark, sf, term=None):
    """Category distribution of one term (``term``; by default the largest by total)."""
    terms, _ = _base(spark, sf, domains=False)
    if term is not None:
        return (terms.where(F.col("term") == term).groupBy("term", "category")
                .agg(F.sum("count").cast("bigint").alias("total")))
    best = (terms.groupBy("term").agg(F.sum("count").alias("s")).orderBy(F.desc("s"), "term").limit(1).select("term"))
    return (terms.join(best, "term", "left_semi").groupBy("term", "category")
            .agg(F.sum("count").cast("bigint").alias("total")))


@register("g3_year_term_view", MERGED_SQL + f""", t5 AS (
  SELECT category, term, rank FROM (
    SELECT category, term, row_number() OVER (PARTITION BY category ORDER BY sum(count) DESC, term) AS rank
    FROM term_year WHERE year BETWEEN {K.YEAR_COLUMN_RANGE[0]} AND {K.YEAR_COLUMN_RANGE[1]}
    GROUP BY category, term) WHERE rank <= {K.CATEGORY_TOP_N})
SELECT m.category, CAST(m.year AS INTEGER) AS year, {", ".join(
    f"max(CASE WHEN rank = {k} THEN m.term END) AS term_{k}, max(CASE WHEN rank = {k} THEN round(norm_freq, 6) END) AS freq_{k}"
    for k in range(1, K.CATEGORY_TOP_N + 1))}
FROM merged m JOIN t5 ON m.category = t5.category AND m.term = t5.term
WHERE m.year BETWEEN {K.YEAR_COLUMN_RANGE[0]} AND {K.YEAR_COLUMN_RANGE[1]} GROUP BY m.category, m.year""")
def g3_year_term_view(spark, sf):
    """G3 + E3 + F2 + H1: for every category, its top-5 terms' normalised frequency as a year x term
    table; the columns are the ranks, since each category has terms of its own."""
    terms, _, merged, _, _ = _merged(spark, sf)
    shown = F.col("year").between(*K.YEAR_COLUMN_RANGE)  # this chart's own range
    top = RK.top_n_per_group(RK.totals(terms.where(shown), ["category", "term"]), ["category"], "total", K.CATEGORY_TOP_N)
    sel = merged.where(shown).join(top.select("category", "term", "rank"), ["category", "term"])
    cells = [c for k in range(1, K.CATEGORY_TOP_N + 1) for c in (
        F.max(F.when(F.col("rank") == k, F.col("term"))).alias(f"term_{k}"),
        F.max(F.when(F.col("rank") == k, r6("norm_freq"))).alias(f"freq_{k}"))]
    return sel.groupBy("category", F.col("year").cast("int").alias("year")).agg(*cells)


@register("f1_loose_keys", S.with_ctes(S.TERM_YEAR_SQL, S.DOMAIN_YEAR_SQL) + """
SELECT t.category, t.term, t.year, t.count, CAST(d.total_papers AS DOUBLE) AS total_papers,
       round(t.count / CAST(d.total_papers AS DOUBLE) * 10000, 6) AS norm_freq
FROM term_year t JOIN domain_year d ON t.category = d.category AND t.year = d.year""")
def f1_loose_keys(spark, sf):
    """F1 where the domain table spells categories in its own way (other case, spaces around), in two
    rows each: the keys are compared lower-cased and trimmed, totals of one key are added up."""
    terms, domains = _base(spark, sf)
    half = F.floor(F.col("total_papers") / 2)
    spelled = domains.select(F.concat(F.lit(" "), F.lower("category")).alias("category"), "year", half.alias("total_papers")).unionByName(
        domains.select(F.concat(F.initcap("category"), F.lit("  ")).alias("category"), "year", (F.col("total_papers") - half).alias("total_papers")))
    joined = T.join_domain_totals(terms, spelled, loose_keys=True)
    return joined.select("category", "term", "year", "count", "total_papers", r6(T.norm_freq()).alias("norm_freq"))
