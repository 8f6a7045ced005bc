"""Category-code expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DOMAIN_MAP


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def domain_map_column() -> Column:
    """The 20-entry prefix -> domain map as a literal map column."""
    return F.create_map(*[F.lit(x) for kv in DOMAIN_MAP.items() for x in kv])


def domain_map_df(spark: SparkSession) -> DataFrame:
    """the prefix -> domain lookup as a 20-row table (for broadcast joins)."""
    return spark.createDataFrame(list(DOMAIN_MAP.items()), "prefix string, domain string")


def code_prefix(code) -> Column:
    """Part of a category code before the first '.' (``cs.AI`` -> ``cs``)."""
    return F.substring_index(_c(code), ".", 1)


def code_domain(code) -> Column:
    """Category code -> domain, null for unknown prefixes."""
    return F.try_element_at(domain_map_column(), code_prefix(code))


def primary_category(categories) -> Column:
    """First space-separated code ('' for an empty string)."""
    return F.get(F.split(F.coalesce(_c(categories), F.lit("")), " "), 0)


def target_domains(categories) -> Column:
    """Distinct domains (sorted) of a space-separated code list; empty/null -> []."""
    codes = F.split(F.coalesce(_c(categories), F.lit("")), " ")
    return F.array_sort(F.array_distinct(F.filter(F.transform(codes, code_domain), lambda d: d.isNotNull())))
