"""Ranking, top-k and arrangement operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import constants as K


def top_n_per_group(df: DataFrame, group: list[str], order_col: str, n: int, tie: str = "term",
                    rank_col: str = "rank") -> DataFrame:
    """E2/E3/E6 core: best n rows per group by ``order_col`` desc, ties by ``tie``.

    Planned with a partial WindowGroupLimit ahead of the shuffle, so each map
    task forwards at most n rows per group even when one group is huge.
    """
    w = W.partitionBy(*group).orderBy(F.desc(order_col), F.asc(tie))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def totals(df: DataFrame, keys: list[str], value: str = "count", out: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def top_terms_rows(df: DataFrame, n: int = K.SUNBURST_TOP_N) -> DataFrame:
    """E2 + F2: top n terms per category by total, then all their rows (semi join)."""
    tot = totals(df, ["category", "term"])
    top = top_n_per_group(tot, ["category"], "total", n).select("category", "term")
    return df.join(top, ["category", "term"], "left_semi")


def bell_position(rank0, odd_left: bool = True):
    """E4 (odd_left=True) / E5 (odd_left=False): position of the r-th largest
    (0-based) item in a bell arrangement around 0."""
    r = rank0
    left = -((r + 1) / 2).cast("int")
    right = (r / 2).cast("int")
    odd = (r % 2) == 1
    if odd_left:
        return F.when(r == 0, F.lit(0)).when(odd, left).otherwise(right)
    return F.when(r == 0, F.lit(0)).when(odd, -left).otherwise(-right)


def bell_arrangement(df: DataFrame, group: list[str], value: str, n: int | None, odd_left: bool,
                     tie: str = "term") -> DataFrame:
    """Rank by value desc within each group, keep n (all when None) and
    place the ranks as a bell (largest at 0)."""
    w = W.partitionBy(*group).orderBy(F.desc(value), F.asc(tie))
    r = df.withColumn("_rn", F.row_number().over(w))
    if n is not None:
        # a filter on row_number itself is planned as a partial WindowGroupLimit
        r = r.where(F.col("_rn") <= n)
    r = r.withColumn("rank0", F.col("_rn") - 1).drop("_rn")
    return r.withColumn("position", bell_position(F.col("rank0"), odd_left))


def rolling_mean(df: DataFrame, key: str, order: str, value: str, periods: int = K.ROLLING_PERIODS,
                 out: str = "rolling_mean") -> DataFrame:
    """Mean of the current and previous periods-1 rows of each series
    (min_periods=1; rows, not calendar distance)."""
    w = W.partitionBy(key).orderBy(order).rowsBetween(-(periods - 1), 0)
    return df.withColumn(out, F.avg(value).over(w))
