"""Exact quantiles of groups of any size (D10, D19), by selection: no group ever stands in one buffer.

Each (group, quantile) has a bracket of values that holds its rank.  A round cuts the bracket by a
bounded sketch (``percentile_approx`` over a grid of shares), counts exactly how many rows lie below
and inside the new bracket, and takes it if the rank is inside.  Once a bracket holds few different
values, or one, their exact counts settle the rank.  A round leaves about 3 / GRID of the rows, so
billions of rows need three or four; all of it is partial and final aggregates, which combine a hot
group map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import ensure_checkpoint_dir

#: Shares that a round's sketch is read at, its accuracy, and the different values that are counted one by one.
GRID, ACCURACY, SMALL = 512, 20_000, 10_000
#: Rounds after which the values are counted one by one however many they are.
MOST_ROUNDS = 12
#: Brackets (rows of a few numbers) that are sent to every task; more are joined by a shuffle.
MOST_BROADCAST = 100_000


def _matched(rows: DataFrame, state: DataFrame, keys: list[str], small: bool) -> DataFrame:
    """Rows with the brackets of their group; null keys are a group."""
    state = state.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in state.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]) if keys else F.lit(True)
    return rows.join(F.broadcast(state) if small else state, on).drop(*[f"_{k}" for k in keys])


def exact_percentiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys..., n, q: array<double>): the quantiles of ``value`` at ``shares`` (0 to 1, interpolated as
    ``percentile`` does) for each group; nulls are left out, a group of nothing but nulls has no row."""
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(shares)]))
    place = F.col("_t.p") * (F.col("_n") - 1)
    # _rank: of the lower of the two values wanted, among the rows inside; _inside: how many those are
    state = (sizes.withColumn("_t", at)
             .select(*keys, F.col("_n"), F.col("_t.i").alias("_i"), place.alias("_place"), "_lo", "_hi",
                     F.floor(place).alias("_rank"), F.col("_n").alias("_inside"), (F.col("_n") <= SMALL).alias("_done"))
             .checkpoint(eager=True))
    small = state.count() <= MOST_BROADCAST
    group = [*keys, "_i"]
    for _ in range(MOST_ROUNDS):
        todo = state.where(~F.col("_done") & (F.col("_lo") < F.col("_hi")))
        inside = _matched(rows, todo, keys, small).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        state_of = ["_n", "_place", "_lo", "_hi", "_rank", "_inside"]
        grid = F.percentile_approx("_v", [k / GRID for k in range(GRID + 1)], ACCURACY).alias("_grid")
        cut = inside.groupBy(*group).agg(*[F.first(c).alias(c) for c in state_of], grid,
                                         F.approx_count_distinct("_v").alias("_values"))
        share = F.col("_rank") / F.greatest(F.col("_inside") - 1, F.lit(1)) * GRID
        low, high = F.greatest(F.floor(share) - 1, F.lit(0)), F.least(F.ceil(share) + 2, F.lit(GRID))
        cut = cut.select(*group, *state_of, (F.col("_values") <= SMALL).alias("_few"),
                         F.get("_grid", low.cast("int")).alias("_a"), F.get("_grid", high.cast("int")).alias("_b")
                         ).checkpoint(eager=True)
        few = cut.agg(F.count(F.lit(1)), F.count_if("_few")).first()
        if few[0] == few[1]:
            break
        counted = (_matched(rows, cut.where(~F.col("_few")), keys, small)
                   .where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).groupBy(*group)
                   .agg(F.count_if(F.col("_v") < F.col("_a")).alias("_below"),
                        F.count_if(F.col("_v").between(F.col("_a"), F.col("_b"))).alias("_between")))
        same = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in group])
        rank = F.col("_rank") - F.col("_below")
        # both values wanted must be inside (the last rank of all has no second one)
        holds = F.coalesce((rank >= 0) & (F.least(rank + 1, F.col("_inside") - 1 - F.col("_below")) < F.col("_between")), F.lit(False))
        moved = cut.alias("s").join(counted.alias("c"), same, "left").select(
            *[F.col(f"s.{k}").alias(k) for k in group], "_n", "_place",
            F.when(holds, F.col("_a")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(holds, F.col("_b")).otherwise(F.col("_hi")).alias("_hi"),
            F.when(holds, rank).otherwise(F.col("_rank")).alias("_rank"),
            F.when(holds, F.col("_between")).otherwise(F.col("_inside")).alias("_inside"), F.col("_few").alias("_done"))
        rest = state.where(F.col("_done") | (F.col("_lo") >= F.col("_hi")))
        state = rest.unionByName(moved).checkpoint(eager=True)
    values = (_matched(rows, state, keys, small).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
              .groupBy(*group, "_n", "_place", "_rank", "_v").agg(F.count(F.lit(1)).alias("_k")))
    upto = F.sum("_k").over(W.partitionBy(*group).orderBy("_v"))
    values = values.withColumn("_upto", upto)
    pick = lambda r: F.max(F.when((F.col("_upto") - F.col("_k") <= r) & (r < F.col("_upto")), F.col("_v")))
    found = (values.groupBy(*group, "_n", "_place").agg(pick(F.col("_rank")).alias("_x"), pick(F.col("_rank") + 1).alias("_y")))
    part = F.col("_place") - F.floor("_place")
    quantile = F.when((part == 0) | F.col("_y").isNull() | (F.col("_x") == F.col("_y")), F.col("_x")).otherwise(
        (F.floor("_place") + 1 - F.col("_place")) * F.col("_x") + part * F.col("_y"))
    of = found.groupBy(*keys, "_n").agg(F.array_sort(F.collect_list(F.struct("_i", quantile.alias("q")))).alias("_q"))
    return of.select(*keys, F.col("_n").alias("n"), F.transform("_q", lambda x: x["q"]).alias("q"))
