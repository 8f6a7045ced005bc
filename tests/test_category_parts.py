"""Category files in parts (A5)."""

from pyspark.sql import functions as F

from lexitrend.operators import terms as TM
from lexitrend.plans import q_corpus as QC
from lexitrend.plans import standins as S
from lexitrend.sources import corpus as CO


def test_category_files_are_written_in_parts(spark, tmp_path):
    rows = [(i, f"title {i}\n{'some line' * 30}\nlast") for i in range(1, 1500)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4k")
    try:
        folder = QC._category_folder(spark, str(tmp_path))
        fs, p = S._hadoop(spark, folder)
        most = max(len([x for x in fs.listStatus(f.getPath()) if x.getPath().getName().startswith("part-")])
                   for f in fs.listStatus(p(folder)) if f.isDirectory())
        rows, found = CO.category_files(spark, folder, ["id", "title", "summary"])
        got = {r.file: (r.status, r.n_rows, r.n_rejected) for r in found.collect()}
        n = rows.count()
    finally:
        spark.conf.set(key, before)
    assert most > 1
    split = TM.domain_split(S.papers(spark, str(tmp_path))).groupBy("domain").agg(
        F.count("*").alias("n"), F.count_if(F.col("id") % QC.BAD_DATE_EVERY == 0).alias("bad")).collect()
    assert {f"arxiv_{r.domain}.csv": ("read", r.n, r.bad) for r in split}.items() <= got.items()
    assert len(got) == len(split) + len(QC.PLANTED_FILES) and n == sum(r.n - r.bad for r in split)


def test_bad_part_costs_its_file_only(spark, tmp_path):
    head = "id,title,summary,published_date\n"
    for name, text in (("arxiv_a.csv/part-0.csv", "1,t,s,2020-01-01\n"), ("arxiv_a.csv/part-1.csv", "2,t,s,2020-01-01,more\n"),
                       ("arxiv_b.csv/part-0.csv", '3,t,"s\ns",2020-01-01\n'), ("arxiv_b.csv/part-1.csv", "4,t,s,never\n"),
                       ("arxiv_c.csv", "5,t,s,2020-01-01\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(head + text)
    rows, found = CO.category_files(spark, str(tmp_path), ["id", "title", "summary"])
    assert {r.file: (r.status, r.n_rows, r.n_rejected) for r in found.collect()} == {
        "arxiv_a.csv": ("unreadable", 0, 0), "arxiv_b.csv": ("read", 2, 1), "arxiv_c.csv": ("read", 1, 0)}
    assert sorted((r.category, r.id) for r in rows.collect()) == [("b", "3"), ("c", "5")]
