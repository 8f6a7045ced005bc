"""Nested-record expressions for raw corpus rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PAPER_URL_PREFIX, PAPER_URL_SUFFIX


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def abs_url(paper_id) -> Column:
    """Paper URL = fixed prefix + id + fixed suffix (see constants)."""
    return F.concat(F.lit(PAPER_URL_PREFIX), _c(paper_id), F.lit(PAPER_URL_SUFFIX))


def first_version_date(versions, update_date) -> Column:
    """Created date of the first version, else update_date."""
    first = F.try_element_at(_c(versions), F.lit(1))
    return F.when(F.size(F.coalesce(_c(versions), F.array())) > 0, first["created"]).otherwise(_c(update_date))


def format_authors(authors_parsed) -> Column:
    """[[last, first, ...], ...] -> ['first last', ...] (stripped)."""
    return F.transform(F.coalesce(_c(authors_parsed), F.array().cast("array<array<string>>")),
                       lambda a: F.trim(F.concat(F.coalesce(F.get(a, 1), F.lit("")), F.lit(" "), F.coalesce(F.get(a, 0), F.lit("")))))


def has_short_author(authors_parsed) -> Column:
    """B7 reject rule: an author entry that is null or has fewer than two parts."""
    return F.exists(F.coalesce(_c(authors_parsed), F.array().cast("array<array<string>>")), lambda a: F.when(a.isNull(), F.lit(True)).otherwise(F.size(a) < 2))


def author_names(authorships) -> Column:
    """Display names as an array (missing names as '')."""
    return F.transform(F.coalesce(_c(authorships), F.array().cast("array<struct<author:struct<display_name:string>>>")),
                       lambda x: F.coalesce(x["author"]["display_name"], F.lit("")))


def join_author_names(authorships) -> Column:
    """Display names joined by ', '."""
    return F.array_join(author_names(authorships), ", ")


def work_category(primary_topic, concepts) -> Column:
    """primary_topic.display_name, else (no topic, or an empty one) the first concept's name, else ''."""
    return F.coalesce(_c(primary_topic)["display_name"], F.get(_c(concepts), 0)["display_name"], F.lit(""))


def reconstruct_abstract(inverted_index) -> Column:
    """Word -> positions map back to text: (position, word) pairs sorted,
    words joined by a space; null / empty map -> ''."""
    pairs = F.flatten(F.transform(F.map_entries(_c(inverted_index)),
                                  lambda e: F.transform(e["value"], lambda p: F.struct(p.alias("pos"), e["key"].alias("word")))))
    return F.coalesce(F.array_join(F.transform(F.array_sort(pairs), lambda x: x["word"]), " "), F.lit(""))
