"""Reshape and wide-table adapters (G1-G6, B17-B22, C5 wide form, D4, D14)."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K


def standardize_columns(df: DataFrame, term_col: str = "term") -> DataFrame:
    """lower/trim column names; the first of the term aliases becomes
    ``term_col``; ``domain`` becomes ``category``."""
    names = [str(c).lower().strip() for c in df.columns]
    out = df.toDF(*names)
    hit = next((c for c in K.TERM_ALIASES if c in names), None)
    if hit is not None and hit != term_col:
        out = out.withColumnRenamed(hit, term_col)
    if "domain" in names and "category" not in names:
        out = out.withColumnRenamed("domain", "category")
    return out


def year_columns(df: DataFrame, between: tuple[int, int] | None = None) -> list[str]:
    """Names that are all digits (and inside the range when given)."""
    return [c for c in df.columns if c.isdigit() and (between is None or between[0] <= int(c) <= between[1])]


def coerce_numeric(df: DataFrame, cols: list[str], default: float = 0.0) -> DataFrame:
    """try_cast to double; bad / null -> default."""
    repl = {c: F.coalesce(F.col(f"`{c}`").cast("string").try_cast("double"), F.lit(default)) for c in cols}
    return df.withColumns(repl)


def row_total(cols: list[str]):
    """Sum over a dynamic set of columns."""
    if not cols:
        return F.lit(0)
    return reduce(add, [F.col(f"`{c}`") for c in cols])


def with_total(df: DataFrame, cols: list[str], total: str = "total") -> DataFrame:
    """A given total column stays as it is; only an absent one is summed."""
    return df if total in df.columns else df.withColumn(total, row_total(cols))


def drop_unrealistic(df: DataFrame, cols: list[str], cap: float = K.MAX_REALISTIC_COUNT) -> DataFrame:
    """B20 (wide form): keep rows whose every year value is <= cap."""
    if not cols:
        return df
    return df.where(F.forall(F.array(*[F.col(f"`{c}`") for c in cols]), lambda x: x <= cap))


def drop_unrealistic_long(df: DataFrame, keys: list[str], cap: float = K.MAX_REALISTIC_COUNT) -> DataFrame:
    """B20 (long form): drop every row of a key whose largest count exceeds cap.

    An aggregate of the bad keys plus an anti join (no window over the key,
    so a hot key is combined map-side)."""
    bad = df.groupBy(*keys).agg(F.max("count").alias("_mx")).where(F.col("_mx") > cap).select(*keys)
    return df.join(bad, keys, "left_anti")


def pivot_years(df: DataFrame, years: list[int], keys=("category", "term"), value: str = "count",
                total: str | None = "total") -> DataFrame:
    """G3 / C5 wide form: one column per year (explicit values, 0-filled) + total."""
    cols = [str(y) for y in years]
    w = (df.groupBy(*keys).pivot("year", years).agg(F.sum(value)).na.fill(0, subset=cols))
    return with_total(w, cols, total) if total else w


def unpivot_years(df: DataFrame, ids: list[str], year_cols: list[str], value: str = "count") -> DataFrame:
    """Wide -> long (year as int)."""
    long = df.unpivot(ids, year_cols, "year", value)
    return long.withColumn("year", F.col("year").cast("int"))


def label(category, term, sep: str = " - "):
    """B22: 'category - term'."""
    return F.concat_ws(sep, F.col(category) if isinstance(category, str) else category,
                       F.col(term) if isinstance(term, str) else term)


def split_label(c, sep: str = " - "):
    """B22 inverse: (category, term) from a label (ambiguous if the term holds the separator)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.split_part(c, F.lit(sep), F.lit(1)), F.split_part(c, F.lit(sep), F.lit(2))
