"""A4/A5: one catalogue, one scan per layout, one outcome per file."""

from pyspark.sql import functions as F

from lexitrend.sources import corpus as CO
from lexitrend.sources import csv_files as CF


def put(path, files):
    path.mkdir(exist_ok=True)
    for name, text in files.items():
        (path / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_catalogue_finds_headers_and_line_breaks(spark, tmp_path):
    files = {f"f{k:02}.csv": f"period,count\n2020Q{k % 4 + 1},{k}\n" for k in range(20)}
    files |= {"void.csv": "", "blank.csv": "\n\n", "one.csv": "period,count", "multi.csv": 'count,period\n1,"a\nb"\n',
              "mark.csv": "﻿Period, Count\r\n2020Q1,5\r\n", "other.txt": "period,count\n1,2\n"}
    got = {r["file"]: r for r in CF.catalogue(spark, put(tmp_path, files)).collect()}
    assert len(got) == 25
    assert all(got[f"f{k:02}.csv"]["header"] == "period,count" and got[f"f{k:02}.csv"]["lines"] == 2 for k in range(20))
    assert got["void.csv"]["header"] is None and got["void.csv"]["bytes"] == 0 and got["blank.csv"]["header"] is None
    assert got["multi.csv"]["multi"] and not got["f00.csv"]["multi"]
    assert CF.header_names(got["mark.csv"]["header"]) == ["period", "count"]


def test_settings_come_back(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    CF.catalogue(spark, put(tmp_path, {"a.csv": "period,count\n"}))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_mixed_headers_rejects_and_bad_files(spark, tmp_path):
    path = put(tmp_path, {
        "a_quarterly_counts.csv": "period,count\n2020Q1,1\n2020Q2,x\n,3\n2020Q3\n",
        "b_quarterly_counts.csv": 'note,COUNT,Period\n"a, b",4.0,2020Q1\n"two\nlines",5,2020Q2\n',
        "long.csv": "period,count\n2020Q1,1\n2020Q2,2,3\n", "lacks.csv": "period,n\n2020Q1,1\n",
        "void.csv": "", "head.csv": "period,count\n", "broken.csv.gz": b"\x1f\x8b\x08not gzip"})
    rows, found = CO.topic_files(spark, path)
    assert sorted(map(tuple, rows.collect())) == [("A", "2020Q1", 1), ("B", "2020Q1", 4), ("B", "2020Q2", 5)]
    got = {r["file"]: (r["status"], r["reason"], r["n_rows"], r["n_rejected"]) for r in found.collect()}
    assert got == {"a_quarterly_counts.csv": ("read", None, 4, 3), "b_quarterly_counts.csv": ("read", None, 2, 0),
                   "long.csv": ("unreadable", "row with more fields than the header", 0, 0),
                   "lacks.csv": ("unreadable", "column missing", 0, 0), "void.csv": ("unreadable", "no header", 0, 0),
                   "head.csv": ("empty", None, 0, 0)}


def test_broken_gzip_costs_itself(spark, tmp_path):
    path = put(tmp_path, {"arxiv_x.csv.gz": b"\x1f\x8b\x08not gzip", "arxiv_y.csv": "id,published_date\n1,2020-01-02\n"})
    files = CF.catalogue(spark, path, "*.csv*")
    rows = CF.scan(spark, files, ["id"])
    assert [r["id"] for r in rows.collect()] == ["1"]
    got = {r["file"]: r["status"] for r in CF.outcomes(files, rows, ["id"]).collect()}
    assert got == {"arxiv_x.csv.gz": "unreadable", "arxiv_y.csv": "read"}


def test_category_from_file_name_and_dropped_dates(spark, tmp_path):
    path = put(tmp_path, {"arxiv_math.csv": "published_date,id\n2020-01-02,1\nsoon,2\n", "arxiv_cs AI+.csv": "id,published_date\n3,2021-05-06\n"})
    rows, found = CO.category_files(spark, path, ["id"])
    assert sorted((r["category"], r["id"], r["published_date"].year) for r in rows.collect()) == [("cs AI+", "3", 2021), ("math", "1", 2020)]
    assert {r["file"]: r["n_rejected"] for r in found.collect()} == {"arxiv_math.csv": 1, "arxiv_cs AI+.csv": 0}


def test_no_files_that_fit(spark, tmp_path):
    rows, found = CO.topic_files(spark, put(tmp_path, {"a.csv": "x,y\n1,2\n"}))
    assert rows.count() == 0 and [r["status"] for r in found.collect()] == ["unreadable"]


def test_large_plain_files_are_split(spark, tmp_path):
    """A file beyond one split is scanned by several tasks, line breaks inside texts make a file one task."""
    lines = "".join(f"2020Q{k % 4 + 1},{k}\n" for k in range(60_000))
    path = put(tmp_path, {"big.csv": "period,count\n" + lines, "quoted.csv": 'period,count\n"2020\nQ1",1\n' + lines})
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64k")
        files = CF.catalogue(spark, path)
        for name, many in (("big.csv", True), ("quoted.csv", False)):
            df = CF.scan(spark, files.where(F.col("file") == name), ["period", "count"])
            assert (df.rdd.getNumPartitions() > 4) == many
            assert df.count() == 60_000 + (not many)
    finally:
        spark.conf.set(key, before)
    plan = df._jdf.queryExecution().toString()
    assert "wholetext" not in plan.lower()


def test_papers_of_files_that_differ(spark, tmp_path):
    """A3: six or seven columns in any order; line breaks in one file do not make the others one task."""
    head, line = "id,title,published_date,authors,primary_category,summary", '1,T,2020-05-06,"A, B",cs.AI,"two\nlines"'
    path = put(tmp_path, {"a.csv": f"{head}\n{line}\n", "void.csv": "",
                          "b.csv": "summary,id,title,published_date,all_categories\ns,2,U,2021-01-01,cs.LG math.ST\n"})
    got = {r.id: (r.title, r.summary, r.authors, r.all_categories) for r in CO.read_papers_csv(spark, path).collect()}
    assert got == {"1": ("T", "two\nlines", "A, B", "cs.AI"), "2": ("U", "s", None, "cs.LG math.ST")}
    try:
        CO.read_csv(spark, path, ["authors"], multi_line=None)
        raise AssertionError("a file lacks the column")
    except ValueError:
        pass
