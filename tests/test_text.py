"""Text expressions against the Python rules they replace."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexitrend.constants import ACADEMIC_STOPWORDS, ENGLISH_STOPWORDS
from lexitrend.functions import text as TX


def py_clean(s):
    s = "" if s is None else str(s).lower()
    s = re.sub(r"[^a-z\s]", "", s)
    return re.sub(r"\s+", " ", s).strip()


def one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_text_edge_rows(spark):
    vals = ["State-of-the-Art é 3D x", "a\t\tb\n\n c", "", None, "x y", "Ünïcode words"]
    got = one_col(spark, vals, TX.clean_text("s"))
    assert got == ["stateoftheart d x", "a b c", "", "", "x y", "ncode words"]
    assert got == [py_clean(v) for v in vals]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=20))
def test_clean_text_matches_python_rule(spark, values):
    assert one_col(spark, values, TX.clean_text("s")) == [py_clean(v) for v in values]


def test_flatten_newlines(spark):
    got = one_col(spark, ["  a\nb  ", None, "\n", "x"], TX.flatten_newlines("s"))
    assert got == ["a b", "", "", "x"]


def test_title_summary_nulls(spark):
    df = spark.createDataFrame([("t", None), (None, "s"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(TX.title_summary_text("a", "b")).collect()] == ["t ", " s", " "]


def test_stopwords_and_length(spark):
    s = "the paper shows a new deep learning model for the data we have"
    toks = one_col(spark, [s], TX.drop_stopwords(TX.tokens(F.lit(s)), extended=True))[0]
    stop_u = set(ENGLISH_STOPWORDS) | set(ACADEMIC_STOPWORDS)
    assert toks == [w for w in s.split() if w not in stop_u and len(w) > 2]
    toks2 = one_col(spark, [s], TX.drop_stopwords(TX.tokens(F.lit(s)), extended=False))[0]
    assert toks2 == [w for w in s.split() if w not in set(ENGLISH_STOPWORDS) and len(w) > 2]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c", "d"],), ([],), (["x"],)], "t array<string>")
    r2 = [r[0] for r in df.select(TX.ngrams("t", 2)).collect()]
    r3 = [r[0] for r in df.select(TX.ngrams("t", 3)).collect()]
    assert r2 == [["a b", "b c", "c d"], [], []]
    assert r3 == [["a b c", "b c d"], [], []]


def test_count_substring_non_overlapping(spark):
    got = one_col(spark, ["electric vehicles electric vehicle", "aaaa", "", "x"],
                  TX.count_substring("s", "electric vehicle"))
    assert got[0] == 2
    assert one_col(spark, ["aaaa"], TX.count_substring("s", "aa")) == [2]
    assert got[2:] == [0, 0]


def test_safe_slug(spark):
    got = one_col(spark, ["Large Language/Models\\x" + "y" * 60], TX.safe_slug("s"))[0]
    assert got == ("large_language_models_x" + "y" * 60)[:50]
