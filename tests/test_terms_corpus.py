"""C4/C5 rules, B7-B10 record flattening, A1 edge rows, B12 accuracy."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lexitrend.functions import records as RC
from lexitrend.operators import terms as TM
from lexitrend.plans import q_corpus as QC
from lexitrend.session import checkpoint_path
from lexitrend.sources import corpus as CO

from .conftest import SF_SMALL


def papers_df(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, summary string, published_date date, all_categories string")


def test_min_docs_and_min_df(spark):
    rows = []
    # 2019: 4 papers (year skipped); 2020: 5 papers
    for i in range(4):
        rows.append((i, "deep learning", "deep learning methods", dt.date(2019, 1, 1 + i), "cs.AI"))
    for i in range(5):
        rows.append((10 + i, "neural nets", "graph theory", dt.date(2020, 1, 1 + i), "cs.LG"))
    # a term 9 times in 2 papers: df 2 < 3 -> dropped for bigrams
    rows.append((20, "rare pair " * 5, "", dt.date(2020, 2, 1), "cs.AI"))
    rows.append((21, "rare pair " * 4, "", dt.date(2020, 2, 2), "cs.AI"))
    c = TM.term_year_counts(TM.with_clean_text(papers_df(spark, rows)))
    got = {(r.year, r.n, r.term): (r.tf, r.df) for r in c.collect()}
    assert all(y == 2020 for y, _, _ in got)
    assert got[(2020, 2, "neural nets")] == (5, 5)
    assert (2020, 2, "rare pair") not in got
    assert all(tf >= df for tf, df in got.values())


def test_top_terms_limit_and_ties(spark):
    counts = spark.createDataFrame([("c", 2020, 1, t, v, 5) for t, v in [("b", 5), ("a", 5), ("z", 1)]],
                                   "category string, year int, n int, term string, tf long, df long")
    top = TM.top_terms(counts, 2)
    assert sorted((r.term, r.rank) for r in top.collect()) == [("a", 1), ("b", 2)]


def test_reconstruct_abstract_inverts(spark):
    text = "the cat saw the other cat"
    idx = {}
    for p, w in enumerate(text.split()):
        idx.setdefault(w, []).append(p)
    df = spark.createDataFrame([(idx,), ({},), (None,)], "m map<string,array<int>>")
    assert [r[0] for r in df.select(RC.reconstruct_abstract("m")).collect()] == [text, "", ""]


def test_authors_and_categories(spark):
    df = spark.createDataFrame([([["Doe", "Jane", ""], ["Roe", "Rick", "Jr"]],), ([["Solo"]],), (None,)],
                               "a array<array<string>>")
    r = df.select(RC.format_authors("a").alias("f"), RC.has_short_author("a").alias("bad")).collect()
    assert r[0].f == ["Jane Doe", "Rick Roe"] and not r[0].bad
    assert r[1].bad and r[2].f == [] and not r[2].bad
    w = spark.createDataFrame([(None, [{"display_name": "C1"}]), ({"display_name": "T"}, []), (None, []),
                               ({"display_name": None}, [])],
                              "pt struct<display_name:string>, cs array<struct<display_name:string>>")
    # the last one is what an empty topic object parses to: it counts as no topic
    assert [x[0] for x in w.select(RC.work_category("pt", "cs")).collect()] == ["C1", "T", "", ""]


def test_snapshot_edge_rows(spark):
    lines = [
        "{bad json",
        json.dumps({"id": "1", "title": "A\ntitle ", "abstract": " x\ny ", "categories": "cs.AI stat.ML",
                    "versions": [{"created": "Mon, 2 Apr 2007 19:18:42 GMT"}], "update_date": "2008-01-01",
                    "authors_parsed": [["Doe", "Jane", ""]]}),
        "not json either",
        json.dumps({"id": "2", "title": "B", "abstract": None, "update_date": "2009-05-06",
                    "authors_parsed": [["Doe", "Jane", ""], ["Solo"]]}),
        json.dumps({"id": "3", "title": "C", "abstract": "z", "update_date": "2010-01-02", "authors_parsed": []}),
    ]
    path = checkpoint_path(spark, "test-snapshot")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(path)
    raw = CO.read_json_lines(spark, path, CO.SNAPSHOT_SCHEMA)
    good, bad = CO.split_corrupt(raw)
    # (a count that reads only the corrupt column is refused by Spark; read a field too)
    assert len(bad.select("id", CO.CORRUPT).collect()) == 2
    out = {r.id: r for r in QC.clean_snapshot(good).collect()}
    assert set(out) == {"http://arxiv.org/abs/1v1", "http://arxiv.org/abs/3v1"}
    a = out["http://arxiv.org/abs/1v1"]
    assert (a.title, a.summary, a.published_date, a.authors, a.primary_category) == \
        ("A title", "x y", "Mon, 2 Apr 2007 19:18:42 GMT", ["Jane Doe"], "cs.AI")
    c = out["http://arxiv.org/abs/3v1"]
    assert (c.published_date, c.all_categories, c.primary_category, c.authors) == ("2010-01-02", "", "", [])


def test_language_gate_accuracy(spark):
    from lexitrend.operators import langid as LI
    from lexitrend.sources.tables import table
    docs = table(spark, SF_SMALL, "documents")
    model, stats, vocab = LI.fit(docs, "text", "lang")
    pred = LI.predict(docs.withColumnRenamed("doc_id", "id"), model, stats, vocab, "id", "text")
    j = pred.join(docs.select(F.col("doc_id").alias("id"), "lang"), "id")
    acc = j.where(F.col("lang_pred") == F.col("lang")).count() / j.count()
    assert acc > 0.95
    short = spark.createDataFrame([(1, "ab"), (2, None)], "id long, title string")
    assert [r.is_english for r in LI.predict(short, model, stats, vocab).collect()] == [False, False]


def test_char_grams_whole_code_points(spark):
    from lexitrend.operators import langid as LI
    df = spark.createDataFrame([(" a\U0001F600b ",), ("  ",), ("",)], "s string")
    got = [r[0] for r in df.select(LI.char_grams("s")).collect()]
    assert got == [[" a\U0001F600", "a\U0001F600b", "\U0001F600b "], [], []]


def test_reconstruct_inverts_random_texts(spark):
    import random
    rng = random.Random(5)
    vocab = ["alpha", "beta", "gamma", "delta", "x", "Über", "naïve", "a-b"]
    texts = [[rng.choice(vocab) for _ in range(rng.randint(0, 30))] for _ in range(40)]
    rows = []
    for i, words in enumerate(texts):
        idx = {}
        for p, w in enumerate(words):
            idx.setdefault(w, []).append(p)
        rows.append((i, idx if idx else None))
    df = spark.createDataFrame(rows, "i int, m map<string,array<int>>")
    got = {r.i: r.t for r in df.select("i", RC.reconstruct_abstract("m").alias("t")).collect()}
    assert got == {i: " ".join(w) for i, w in enumerate(texts)}
