"""Inputs that readers and parsers used to lose without a word."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lexitrend.functions import records as RC
from lexitrend.functions.dates import is_bad_date, parse_timestamp
from lexitrend.operators import langid as LI
from lexitrend.operators import reshape as R
from lexitrend.operators import trends as T
from lexitrend.sources import corpus as CO
from lexitrend.streaming import ingest as IG
from lexitrend.streaming import period_counts as PC

from .conftest import SF_SMALL


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,title,published_date,authors,primary_category,summary\n"
                                    '1,T,2020-05-06 12:34:56+00:00,"A, B",cs.AI,"two\nlines, here"\n')
    r = CO.read_csv(spark, str(tmp_path), ["id", "summary", "published_date"], multi_line=True).first()
    assert tuple(r) == ("1", "two\nlines, here", "2020-05-06 12:34:56+00:00")
    p = CO.read_papers_csv(spark, str(tmp_path)).first()
    assert p.all_categories == "cs.AI" and p.title == "T"
    with pytest.raises(ValueError):
        CO.read_csv(spark, str(tmp_path), ["nothing"])


def test_csv_headers_that_differ_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,title\n1,a\n")
    (tmp_path / "b.csv").write_text("title,id\nb,2\n")
    with pytest.raises(Exception):
        CO.read_csv(spark, str(tmp_path), ["id", "title"]).collect()


@pytest.mark.parametrize("text,want", [
    ("2020-05-06 12:34:56+00:00", "2020-05-06 12:34:56"), ("2020-05-06 12:34:56.123", "2020-05-06 12:34:56.123"),
    ("2020-05-06 12:34:56.123456+00:00", "2020-05-06 12:34:56.123456"), ("2020-05-06T12:34:56Z", "2020-05-06 12:34:56"),
    ("2020-05-06T14:34:56.5+02:00", "2020-05-06 12:34:56.5"), ("2020-05-06 12:34:56", "2020-05-06 12:34:56"),
    ("2020-05", "2020-05-01 00:00:00"), ("Wed, 6 May 2020 12:34:56 GMT", "2020-05-06 12:34:56"), ("nonsense", None), (None, None)])
def test_date_forms(spark, text, want):
    df = spark.createDataFrame([(text,)], "d string")
    r = df.select(parse_timestamp("d").cast("string").alias("t"), is_bad_date("d").alias("bad")).first()
    assert r.t == want and r.bad == (text == "nonsense")


def test_topic_files_with_marks_quotes_and_decimals(spark, tmp_path):
    (tmp_path / "machine_learning_quarterly_counts.csv").write_text('﻿"note","period","count"\r\n"a, b",2020Q1,3.0\r\nx,2020Q2,4\r\n')
    got = sorted(map(tuple, CO.read_topic_folder(spark, str(tmp_path)).collect()))
    assert got == [("Machine Learning", "2020Q1", 3), ("Machine Learning", "2020Q2", 4)]


def test_null_author_entries_are_rejected_not_lost(spark):
    df = spark.createDataFrame([(1, [["L", "F"], None]), (2, [["L"]]), (3, [["L", "F"]]), (4, None), (5, [["L", None]])],
                               "id int, a array<array<string>>")
    got = {r.id: r.bad for r in df.select("id", RC.has_short_author("a").alias("bad")).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert df.where("id = 5").select(RC.format_authors("a")).first()[0] == ["L"]


def test_empty_topic_falls_through_to_the_concept(spark):
    df = spark.createDataFrame([(1, (None,), [("C",)]), (2, None, [("C",)]), (3, ("T",), [("C",)]), (4, (None,), [])],
                               "id int, t struct<display_name:string>, c array<struct<display_name:string>>")
    assert [r[0] for r in df.orderBy("id").select(RC.work_category("t", "c")).collect()] == ["C", "C", "T", ""]


def test_years_outside_the_old_range_and_repeated_rows(spark):
    rows = [("c", "a", y, n) for y, n in ((1985, 1), (1986, 2), (1987, 3), (2035, 9), (2035, 1))]
    terms = spark.createDataFrame(rows, "category string, term string, year int, count long")
    assert T.year_list(terms) == [1985, 1986, 1987, 2035]
    assert T.predict_term(terms, 2035).count() == 3
    dense = {r.year: r["count"] for r in T.dense_term_years(terms, T.year_list(terms)).collect()}
    assert dense == {1985: 1.0, 1986: 2.0, 1987: 3.0, 2035: 10.0}
    wide = R.pivot_years(terms, T.year_list(terms))
    assert wide.first().total == 16
    assert R.with_total(wide.withColumn("total", F.lit(5)), ["1985"]).first().total == 5
    assert R.year_columns(wide, (1990, 2030)) == [] and len(R.year_columns(wide)) == 4


def test_loose_category_keys(spark):
    terms = spark.createDataFrame([("CS ", "a", 2000, 3)], "category string, term string, year int, count long")
    dom = spark.createDataFrame([("cs", 2000, 10), ("Cs", 2000, 20)], "category string, year int, total_papers long")
    assert T.join_domain_totals(terms, dom).count() == 0
    assert T.join_domain_totals(terms, dom, loose_keys=True).select("category", "total_papers").first() == ("CS ", 30.0)


def test_language_gate_on_texts_it_was_not_fitted_on(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("length(text) > 200")
    model, stats, vocab = LI.fit(docs.where("doc_id % 2 = 0"), "text", "lang")
    other = docs.where("doc_id % 2 = 1").select("doc_id", "lang", F.substring_index("text", "\n", 1).alias("title"))
    got = LI.predict(other, model, stats, vocab, "doc_id", "title").withColumnRenamed("id", "doc_id").join(other, "doc_id")
    assert got.where("length(title) > 30 and lang_pred = lang").count() >= 0.95 * got.where("length(title) > 30").count()


def test_old_files_are_ingested(spark, tmp_path):
    land, df = str(tmp_path / "land"), spark.createDataFrame([(1, "x")], "a int, b string")
    args = (spark, land, df.schema, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "ck"), F.col("a") > 0)
    df.coalesce(1).write.parquet(str(tmp_path / "one"))
    os.makedirs(land)
    part = next(f for f in os.listdir(tmp_path / "one") if f.endswith(".parquet"))
    shutil.copy(tmp_path / "one" / part, f"{land}/new.parquet")
    IG.ingest_available(*args)
    shutil.copy(tmp_path / "one" / part, f"{land}/old.parquet")
    os.utime(f"{land}/old.parquet", (1e9, 1e9))
    IG.ingest_available(*args)
    assert IG.read_sink(spark, str(tmp_path / "good"), df.schema).count() == 2
    assert IG.read_sink(spark, str(tmp_path / "none"), df.schema).count() == 0


def test_late_rows_are_reported(spark, tmp_path):
    land = str(tmp_path / "land")
    day = lambda d, n: spark.sql(f"SELECT timestamp'2020-01-{d:02d} 00:00:00' AS ts, 'k' AS k, 1.0D AS v FROM range({n})")
    args = (spark, land, day(1, 1).schema, "ts", "k", "v", str(tmp_path / "log"), str(tmp_path / "ck"))
    day(20, 3).coalesce(1).write.mode("append").parquet(land)
    assert PC.run_window_counts(*args) == 0
    day(21, 1).coalesce(1).write.mode("append").parquet(land)
    PC.run_window_counts(*args)
    day(2, 4).coalesce(1).write.mode("append").parquet(land)
    assert PC.run_window_counts(*args) > 0
