"""Date expressions: tolerant parsing and period keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats tried in order by ``parse_timestamp``.  RFC-2822 dates have their
# weekday cut first (Spark >= 3 cannot parse the ``E`` letter).
TIMESTAMP_FORMATS = [
    "d MMM yyyy HH:mm:ss z",
    # with or without a fraction of 1 to 9 digits and an offset
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS][XXX]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS][XXX]",
    "yyyy-MM-dd",
    "yyyy-MM",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c) -> Column:
    """String -> timestamp (session zone, UTC by default); invalid -> null."""
    s = F.trim(F.regexp_replace(_c(c), r"^[A-Za-z]{3}, ", ""))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in TIMESTAMP_FORMATS])


def is_bad_date(c) -> Column:
    """A date text that ``parse_timestamp`` cannot read (to be counted, not lost)."""
    return (F.coalesce(F.trim(_c(c)), F.lit("")) != "") & parse_timestamp(c).isNull()


def year_of(c) -> Column:
    return F.year(_c(c)).cast("int")


def quarter_label(c) -> Column:
    """B14: 'YYYYQn' (pandas Period('Q') string)."""
    return F.concat(F.year(_c(c)).cast("string"), F.lit("Q"), F.quarter(_c(c)).cast("string"))


def month_label(c) -> Column:
    """B14: 'YYYY-MM'."""
    return F.date_format(_c(c), "yyyy-MM")


def month_start(c) -> Column:
    """First day of the month as DATE."""
    return F.trunc(F.to_date(_c(c)), "month")


def quarter_label_to_float(c) -> Column:
    """B14: 'YYYYQn' -> YYYY.n as a sort key."""
    return F.replace(_c(c), F.lit("Q"), F.lit(".")).cast("double")


def quarter_label_year(c) -> Column:
    """First four characters of a period label as int."""
    return F.substring(_c(c), 1, 4).cast("int")


def quarter_label_start(c) -> Column:
    """B14: 'YYYYQn' -> first day of that quarter."""
    y = F.substring(_c(c), 1, 4).cast("int")
    q = F.substring(_c(c), 6, 1).cast("int")
    return F.make_date(y, (q - 1) * 3 + 1, F.lit(1))
