"""End-to-end jobs on files rendered from the smallest documents table:
snapshot JSON -> clean papers -> domain split / term tables / domain stats /
monthly -> trends."""

from pyspark.sql import functions as F

from lexitrend import jobs
from lexitrend.plans import q_corpus as QC
from lexitrend.session import checkpoint_path

from .conftest import SF_SMALL


def test_end_to_end(spark):
    base = checkpoint_path(spark, "test-jobs")
    raw = f"{base}/raw"
    QC.snapshot_lines(spark, SF_SMALL).write.mode("overwrite").text(raw)
    counts = jobs.clean_snapshot(spark, raw, f"{base}/papers")
    assert counts["malformed"] > 0 and counts["short_author"] > 0
    papers = spark.read.parquet(f"{base}/papers")
    n_docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert papers.count() == n_docs - counts["malformed"] - counts["short_author"]

    jobs.split_domains(spark, f"{base}/papers", f"{base}/domains")
    doms = {r[0] for r in spark.read.parquet(f"{base}/domains").select("domain").distinct().collect()}
    assert doms >= {"computer_science", "physics"}

    jobs.term_tables(spark, f"{base}/papers", f"{base}/terms", k=50)
    t = spark.read.parquet(f"{base}/terms")
    assert t.groupBy("category", "n").agg(F.countDistinct("term").alias("k")).where("k > 50").count() == 0
    assert t.where("count > total").count() == 0

    jobs.domain_stats(spark, f"{base}/papers", f"{base}/dstats")
    d = spark.read.parquet(f"{base}/dstats")
    assert d.where("total_papers <= 0").count() == 0

    jobs.monthly(spark, f"{base}/papers", f"{base}/monthly")
    m = spark.read.option("header", True).schema("date string, count long").csv(f"{base}/monthly")
    assert m.agg(F.sum("count")).first()[0] == papers.count()

    jobs.trends(spark, f"{base}/terms", f"{base}/dstats", f"{base}/trends", n=1)
    s = spark.read.parquet(f"{base}/trends/summary")
    assert s.where("r2 <= 0.5 OR rank > 5").count() == 0


def test_clean_works_job(spark):
    base = checkpoint_path(spark, "test-works-job")
    QC.works_lines(spark, SF_SMALL).repartition(3).write.mode("overwrite").option("compression", "gzip").text(f"{base}/raw")
    jobs.clean_works(spark, f"{base}/raw/*.gz", f"{base}/papers")
    got = spark.read.parquet(f"{base}/papers")
    exp = QC.a2_works_corpus(spark, SF_SMALL)
    assert got.count() == exp.count() > 0
    assert sorted(str(r.id) for r in got.select("id").collect()) == sorted(str(r.id) for r in exp.select("id").collect())
    assert got.schema["authors"].dataType.simpleString() == "array<string>"


def test_snapshot_in_one_pass_with_rejects(spark, tmp_path):
    """Counts, rejects with file and line, and papers from one scan of the input."""
    import json
    good = {"id": "1", "title": "t", "abstract": "a", "categories": "cs.AI", "update_date": "soon",
            "authors_parsed": [["L", "F"]]}
    short = good | {"id": "2", "authors_parsed": [["L"]]}
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "x.json").write_text("\n".join([json.dumps(good), "{broken", json.dumps(short), json.dumps(good | {"id": "3", "update_date": "2020-01-02"})]))
    for _ in range(2):  # a rerun replaces both tables
        got = jobs.clean_snapshot(spark, str(tmp_path / "raw"), str(tmp_path / "papers"))
        assert got == {"malformed": 1, "short_author": 1, "bad_dates": 1, "papers": 2}
    assert sorted(r.id[-4:] for r in jobs.read_papers(spark, str(tmp_path / "papers")).collect()) == sorted(
        r.id[-4:] for r in spark.read.parquet(str(tmp_path / "papers")).collect())
    bad = {r.reject.reason: r.reject for r in spark.read.parquet(str(tmp_path / "papers_rejects")).collect()}
    assert set(bad) == {"malformed", "short_author"}
    assert bad["malformed"].line == "{broken" and bad["malformed"].file.endswith("x.json")
    assert '"id":"2"' in bad["short_author"].line
    assert jobs.domain_stats(spark, str(tmp_path / "papers"), str(tmp_path / "d")) == {"bad_dates": 1}
    assert jobs.monthly(spark, str(tmp_path / "papers"), str(tmp_path / "m")) == {"bad_dates": 1}
    assert sorted(p.name for p in tmp_path.iterdir()) == ["d", "m", "papers", "papers_rejects", "raw"]  # no staging left


def test_snapshot_without_rejects(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": "1", "title": "t", "authors_parsed": [["L", "F"]]}\n')
    assert jobs.clean_snapshot(spark, str(tmp_path / "x.json"), str(tmp_path / "out"))["papers"] == 1
    assert spark.read.parquet(str(tmp_path / "out_rejects")).count() == 0


def test_works_without_id_and_with_one_id(spark, tmp_path):
    """Of four works (no id; W1; W2 English; W2 German) the German title alone is left out."""
    import json
    en = "the results of the analysis show that the method is better than the others in this field of study"
    de = "die ergebnisse der untersuchung zeigen dass das verfahren besser ist als die anderen auf diesem gebiet"
    index = lambda text: {w: [i] for i, w in enumerate(dict.fromkeys(text.split()))}
    rows = [{"id": None, "title": en, "language": "en"}, {"id": "W1", "title": en[:60], "language": "en"},
            {"id": "W2", "title": en[20:], "language": "en"}, {"id": "W2", "title": de, "language": "en"}]
    rows = [r | {"abstract_inverted_index": index(en), "publication_date": "2020-01-02"} for r in rows]
    rows += [{"id": f"D{k}", "title": de, "language": "de", "abstract_inverted_index": index(de + f" x{k}")} for k in range(5)]
    rows[1]["authorships"] = [{"author": {"display_name": "A B"}}, {"author": {"display_name": "C"}}]
    rows[1]["publication_date"] = "never"
    (tmp_path / "w.json").write_text("\n".join(map(json.dumps, rows)) + "\nnot json\n")
    got = jobs.clean_works(spark, str(tmp_path / "w.json"), str(tmp_path / "out"))
    assert got == {"lines": 10, "malformed": 1, "papers": 3, "bad_dates": 1}
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((str(r.id), r.title) for r in out) == sorted([("None", en), ("W1", en[:60]), ("W2", en[20:])])
    assert {str(r.id): r.authors for r in out}["W1"] == ["A B", "C"]
    assert spark.read.parquet(str(tmp_path / "out_rejects")).first()["line"] == "not json"


def test_one_rule_for_repeated_ids(spark, tmp_path):
    """A paper with two dates counts once, in the earlier year, in query and job alike; no id, no paper."""
    rows = [("a", "2021-05-01", "cs.AI"), ("a", "2020-05-01", "cs.LG stat.ML"), (None, "2020-01-01", "cs.AI"), ("b", "2021-01-01", "cs.AI")]
    df = spark.createDataFrame(rows, "id string, published_date string, all_categories string")
    wide = {r.domain: (r["2020"], r["2021"]) for r in QC.domain_year_pivot(df).collect()}
    assert wide == {"computer_science": (1, 1), "statistics": (1, 0)}
    df.write.parquet(str(tmp_path / "p"))
    jobs.domain_stats(spark, str(tmp_path / "p"), str(tmp_path / "d"))
    long = {(r.category, r.year): r.total_papers for r in spark.read.parquet(str(tmp_path / "d")).collect()}
    assert long == {("computer_science", 2020): 1, ("computer_science", 2021): 1, ("statistics", 2020): 1}


def test_reruns_replace_only_their_partitions(spark, tmp_path):
    """A rerun replaces the folders it has rows for; a hot folder's rows go to a bounded number of files."""
    import os
    from lexitrend.sources import sinks as SK
    out = str(tmp_path / "t")
    df = spark.range(3000).select("id", F.when(F.col("id") % 10 > 0, F.lit("hot")).otherwise(F.concat(F.lit("d"), F.col("id") % 3)).alias("d"))
    SK.write_parquet(df.repartition(16), out, ["d"], mode="replace_partitions")
    files = {d: len([f for f in os.listdir(f"{out}/{d}") if f.startswith("part-")]) for d in os.listdir(out) if d.startswith("d=")}
    assert set(files) == {"d=hot", "d=d0", "d=d1", "d=d2"} and max(files.values()) <= 2  # 16 tasks had rows of each
    SK.write_parquet(df.where("d = 'hot' AND id < 100"), out, ["d"], mode="replace_partitions")
    SK.write_parquet(df.where("d = 'hot' AND id < 100"), out, ["d"], mode="replace_partitions")
    got = {r.d: r["count"] for r in spark.read.parquet(out).groupBy("d").count().collect()}
    assert got == {"hot": 90, "d0": 100, "d1": 100, "d2": 100}


def test_job_from_a_configuration(spark, tmp_path):
    """One job run from a JSON section; wrong files, sections and settings are errors."""
    import json

    import pytest

    from lexitrend.config import load_config
    lines = [f'{k},title,electric vehicle inflation paper,2020-0{k % 3 + 1}-01,econ.EM' for k in range(8)] + ["9,t,x,soon,econ.EM"]
    (tmp_path / "econ.csv").write_text("id,title,summary,published_date,primary_category\n" + "\n".join(lines) + "\n")
    cfg = tmp_path / "config.json"
    section = {"data_file": str(tmp_path / "econ.csv"), "output": str(tmp_path / "out"), "academic_stopwords": ["inflation"],
               "search_terms": ["electric vehicle"], "min_df": {"1": 8, "2": 8, "3": 8}, "min_docs_per_year": 8}
    cfg.write_text(json.dumps({"Economy": section, "Empty": {}, "Odd": section | {"colour": 1}, "Wrong": section | {"top_terms": "x"}}))
    assert jobs.configured(spark, str(cfg), "Economy") == {"bad_dates": 1}
    terms = {(r.n, r.term): r["count"] for r in spark.read.parquet(str(tmp_path / "out/terms")).collect()}
    assert (1, "inflation") not in terms and terms[(1, "paper")] == 8 and terms[(2, "vehicle inflation")] == 8
    got = spark.read.option("header", True).csv(str(tmp_path / "out/phrases")).collect()
    assert [(r.phrase, r.period, r["count"]) for r in got] == [("electric vehicle", "2020Q1", "8")]
    assert load_config(str(cfg), "Economy").top_terms == 1000
    for what, error in (("Empty", ValueError), ("Odd", ValueError), ("Wrong", ValueError), ("None", KeyError)):
        with pytest.raises(error):
            load_config(str(cfg), what)
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "none.json"), "Economy")
