"""Text expressions: cleaning, tokens, stopwords, n-grams, slugs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ACADEMIC_STOPWORDS, ENGLISH_STOPWORDS

# Python's str-regex ``\s`` is Unicode-aware while Java's and RE2's are ASCII
# only, so the class is spelled out: ASCII whitespace (incl. vertical tab),
# the information separators, NEL, NBSP and the Unicode space separators.
WHITESPACE_CLASS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS_RE = f"[{WHITESPACE_CLASS}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """B1: lower-case, delete everything but a-z and whitespace, collapse
    whitespace runs to one space, strip.  Null becomes ''.

    ``state-of-the-art`` -> ``stateoftheart`` (characters are deleted, not
    blanked).
    """
    # whitespace -> ' ' is a per-character mapping: translate, no regex
    s = F.translate(F.coalesce(_c(c), F.lit("")), WHITESPACE_CLASS, " " * len(WHITESPACE_CLASS))
    s = F.regexp_replace(F.lower(s), "[^a-z ]", "")
    return F.trim(F.regexp_replace(s, " +", " "))


def flatten_newlines(c) -> Column:
    """B2: newline -> space, strip surrounding whitespace, null -> ''."""
    return F.coalesce(F.regexp_replace(F.translate(_c(c), "\n", " "), f"^{WS_RE}+|{WS_RE}+$", ""), F.lit(""))


def title_summary_text(title, summary) -> Column:
    """Title + ' ' + summary with nulls read as ''."""
    return F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), F.coalesce(_c(summary), F.lit("")))


def tokens(clean) -> Column:
    """Split an already cleaned string (single spaces, stripped) into words."""
    return F.split(_c(clean), " ")


def drop_stopwords(toks, extended: bool, academic: list[str] | None = None) -> Column:
    """C1 (extended=True: English + academic list) / C2 (English only):
    keep words longer than 2 characters that are not stopwords;
    ``academic`` replaces the academic list.

    ``isin`` with a long literal list is planned as a hash-set lookup.
    """
    stop = ENGLISH_STOPWORDS + ((ACADEMIC_STOPWORDS if academic is None else academic) if extended else [])
    stop = sorted({w for w in stop if len(w) > 2})
    return F.filter(_c(toks), lambda w: (F.length(w) > 2) & ~w.isin(stop))


def ngrams(toks, n: int) -> Column:
    """Contiguous n-grams of a token array, words joined by a space.

    Built with ``zip_with`` over shifted slices so the token array is never
    referenced from inside a lambda (which would re-evaluate it per element).
    """
    t = _c(toks)
    if n == 1:
        return t
    k = F.greatest(F.size(t) - F.lit(n - 1), F.lit(0))
    out = F.slice(t, 1, k)
    for i in range(1, n):
        out = F.zip_with(out, F.slice(t, i + 1, k), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def count_substring(s, phrase: str) -> Column:
    """Non-overlapping occurrences of ``phrase`` in ``s`` (Python str.count)."""
    if not phrase:
        raise ValueError("empty phrase")
    s = _c(s)
    return ((F.length(s) - F.length(F.replace(s, F.lit(phrase), F.lit("")))) / F.lit(len(phrase))).cast("bigint")


def safe_slug(c) -> Column:
    """Lower, space / slash / backslash -> '_', first 50 characters."""
    return F.substring(F.regexp_replace(F.lower(_c(c)), r"[ /\\]", "_"), 1, 50)


def slug_to_title(c, suffix: str = "_quarterly_counts") -> Column:
    """A4: topic label from a file stem: cut the suffix, '_' -> ' ', title case."""
    return F.initcap(F.replace(F.regexp_replace(_c(c), f"{suffix}$", ""), F.lit("_"), F.lit(" ")))
