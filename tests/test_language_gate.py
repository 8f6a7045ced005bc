"""The language gate on whole tables, in tasks of bounded size, and the works whose titles it judges."""

import json
import re

from pyspark.sql import functions as F

from lexitrend.operators import langid as LI
from lexitrend.plans import q_corpus as QC
from lexitrend.plans import registry
from lexitrend.sources import corpus as CO

from .conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_gate_is_fitted_on_every_labelled_text(spark):
    rows = [(f"word{i:04d} text", "en") for i in range(LI.FIT_PER_LABEL + 101)]
    _, stats, _ = LI.fit(spark.createDataFrame(rows, "text string, lang string"), per_label=None)
    assert stats == [("en", len(rows), sum(len(t) for t, _ in rows))]  # padded by two, less two: one gram a character
    registry.load_all()
    assert "k <=" not in registry.ORACLE["a2_works_corpus"] and "k <=" not in registry.ORACLE["b12_language_gate"]


def test_title_gate_query_reads_every_text(spark, tmp_path, monkeypatch):
    n = LI.FIT_PER_LABEL + 101
    rows = [(i, f"plain words {i}", "en") for i in range(n)] + [(n, "schlicht", "de"), (n + 1, None, "de"), (n + 2, "x", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, predict = [], LI.predict
    monkeypatch.setattr(LI, "predict", lambda texts, *model: seen.append(model) or predict(texts, *model))
    registry.load_all()
    got = {r.id: r.lang_pred for r in registry.QUERIES["b12_language_gate"](spark, str(tmp_path)).collect()}
    model, stats = seen[0][:2]
    assert stats == [("de", 2, 8), ("en", n, sum(len(t) for _, t, lang in rows if lang == "en"))]
    assert round(2.718281828459045 ** model.where("gram = 'pla'").first().logs[1]) == n + 1
    assert got[0] == "en" and got[n] == "de" and len(got) == len(rows)


def test_works_gate_reads_every_text(spark, monkeypatch):
    labelled = spark.createDataFrame([(f"plain words {i}", "en") for i in range(900)], "text string, lang string")
    raw = spark.createDataFrame([json.dumps({"id": "W1", "title": "plain words", "language": "en"})], "string").select(
        F.from_json("value", CO.WORKS_SCHEMA).alias("r")).select("r.*").drop(CO.CORRUPT)
    seen, predict = [], LI.predict
    monkeypatch.setattr(LI, "predict", lambda texts, model, *a: seen.append(model) or predict(texts, model, *a))
    assert [r.id for r in QC.flatten_works(raw, labelled).collect()] == ["W1"]
    assert round(2.718281828459045 ** seen[0].where("gram = 'pla'").first().logs[0]) == 900 + 1


def test_title_gate_in_many_partitions(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", F.substring("text", 1, 60).alias("t"), "text", "lang")
    model = LI.fit(docs)
    one = {tuple(r) for r in LI.predict(docs, *model, "doc_id", "t").collect()}
    monkeypatch.setattr(LI, "PIECE", 1000)
    many = LI.predict(docs, *model, "doc_id", "t")
    assert max(int(x) for x in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\)", plan(many))) > 4
    assert {tuple(r) for r in many.collect()} == one
    english = LI.english_texts(docs, "t", *model)
    keys = {bytes(r.k) for r in docs.select(LI.text_key("t").alias("k"), "doc_id").collect() if (r.doc_id, "en", True) in one}
    assert english.columns == ["_key"] and {bytes(r[0]) for r in english.collect()} == keys


def test_works_index_is_made_row_by_row(spark, tmp_path):
    rows = [(1, "t\nb a  b\nc a", "en"), (2, "t", "en"), (3, None, "en"), (4, "t\nx", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    lines = QC.works_lines(spark, str(tmp_path))
    assert "posexplode" not in plan(lines)
    index = sorted(str(json.loads(r.value).get("abstract_inverted_index")) for r in lines.collect())
    assert index == sorted(map(str, [{"a": [1, 4], "b": [0, 2], "c": [3]}, None, None, {"x": [0]}]))
