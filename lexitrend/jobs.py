"""End-to-end jobs over user files, one per reference script.

Each job reads its input with an explicit schema, runs the operators, and
writes Parquet (or CSV) output partitioned the way the next job reads it.

  clean_snapshot   JSON-lines snapshot -> clean papers (+ reject counts)   A1, B2, B4-B7
  clean_works      gzip works JSON-lines -> clean papers (English)         A2, B8-B11
  split_domains    clean papers -> one folder per domain                   A7, B15, B16
  term_tables      clean papers -> per-domain 1/2/3-gram year tables       C1-C5, A8
  domain_stats     clean papers -> distinct papers per domain x year       D2
  monthly          clean papers -> zero-filled monthly counts              D1
  trends           term table + domain stats -> top trends, forecasts      F1, H1-H8, E6
  configured       a section of a JSON file -> term tables, phrase counts  A12, C1-C6
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import constants as K
from .config import load_config
from .functions.categories import primary_category, target_domains
from .functions.dates import is_bad_date, parse_timestamp, quarter_label
from .functions.text import flatten_newlines
from .operators import aggregates as AG
from .operators import terms as TM
from .operators import trends as T
from .session import checkpoint_path, ensure_checkpoint_dir, get_spark
from .sources import corpus as CO
from .sources import sinks as SK

PAPERS_SCHEMA = "id string, title string, summary string, published_date string, authors array<string>, " \
                "primary_category string, all_categories string"


def clean_snapshot(spark: SparkSession, input_path: str, output: str, rejects: str | None = None) -> dict:
    """Snapshot JSON lines -> clean papers, and a table of rejected lines (file, reason, line) at
    ``rejects`` (default: ``output`` + `_rejects`), in one pass; returns what that pass counted: malformed
    lines, rows with a short author entry, and kept papers whose date cannot be read.

    Both tables have the papers' columns and a struct ``reject``, null in papers."""
    from .functions import records as RC
    raw = CO.read_json_lines(spark, input_path, CO.SNAPSHOT_SCHEMA, file_column="_file")
    bad, short = F.col(CO.CORRUPT).isNotNull(), RC.has_short_author("authors_parsed")
    reason = F.when(bad, F.lit("malformed")).when(short, F.lit("short_author"))
    cats = F.coalesce(F.col("categories"), F.lit(""))
    line = F.coalesce(F.col(CO.CORRUPT), F.to_json(F.struct("id", "title", "authors_parsed")))
    rows = raw.select(RC.abs_url("id").alias("id"), flatten_newlines("title").alias("title"),
                      flatten_newlines("abstract").alias("summary"),
                      RC.first_version_date("versions", "update_date").alias("published_date"),
                      RC.format_authors("authors_parsed").alias("authors"),
                      primary_category(cats).alias("primary_category"), cats.alias("all_categories"),
                      F.when(reason.isNotNull(), F.struct(F.col("_file").alias("file"), reason.alias("reason"),
                                                          line.alias("line"))).alias("reject"))
    seen, kept = Observation(), F.col("reject").isNull()
    rows = rows.observe(seen, F.count_if(F.col("reject.reason") == "malformed").alias("malformed"),
                        F.count_if(F.col("reject.reason") == "short_author").alias("short_author"),
                        F.count_if(kept & is_bad_date("published_date")).alias("bad_dates"),
                        F.count_if(kept).alias("papers"))
    SK.write_split(rows, kept, output, rejects or f"{output.rstrip('/')}_rejects")
    return seen.get


def clean_works(spark: SparkSession, input_glob: str, output: str, rejects: str | None = None) -> dict:
    """Gzip works JSON lines -> clean English papers (abstract rebuilt), and a table of malformed
    lines (file, reason, line) at ``rejects`` (default: ``output`` + `_rejects`); returns counts of lines,
    malformed ones, papers, and papers whose date cannot be read.

    The gzip files, which cannot be split, are parsed once into a Parquet table under the checkpoint
    folder; the gate's fit, the titles and the papers are read from there, column by column."""
    from .functions import records as RC
    from .plans.q_corpus import flatten_works
    parsed = checkpoint_path(spark, f"works-{uuid.uuid4().hex}")
    raw = CO.read_json_lines(spark, input_glob, CO.WORKS_SCHEMA, spread=True, file_column="_file")
    lines, papers = Observation(), Observation()
    raw.observe(lines, F.count(F.lit(1)).alias("lines"),
                F.count_if(F.col(CO.CORRUPT).isNotNull()).alias("malformed")).write.parquet(parsed)
    raw = spark.read.schema(raw.schema).parquet(parsed)
    good, bad = CO.split_corrupt(raw)
    (bad.select(F.col("_file").alias("file"), F.lit("malformed").alias("reason"), F.col(CO.CORRUPT).alias("line"))
     .write.mode("overwrite").parquet(rejects or f"{output.rstrip('/')}_rejects"))
    labelled = good.where(F.size("abstract_inverted_index") > 0).select(RC.reconstruct_abstract("abstract_inverted_index").alias("text"),
                               F.col("language").alias("lang")).where("text <> ''")
    w = flatten_works(good, labelled, True, good.select(F.col("language").alias("lang"))).select(
        "id", "title", "summary", "published_date", "authors", "primary_category",
        F.lit(None).cast("string").alias("all_categories"))
    (w.observe(papers, F.count(F.lit(1)).alias("papers"), F.count_if(is_bad_date("published_date")).alias("bad_dates"))
     .write.mode("overwrite").parquet(output))
    _remove(spark, parsed)
    return lines.get | papers.get


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).delete(path(folder), True)


def read_papers(spark: SparkSession, path: str) -> DataFrame:
    """Clean papers (Parquet, or CSV files by their name) with the date parsed (B13); dates that
    cannot be read are null and marked by ``bad_date``."""
    p = CO.read_papers_csv(spark, path) if path.endswith((".csv", ".csv.gz")) else spark.read.parquet(path)
    date = F.col("published_date").cast("string")
    return p.withColumns({"bad_date": is_bad_date(date), "published_date": parse_timestamp(date)})


def _counted(papers: DataFrame) -> tuple[DataFrame, Observation]:
    """The papers, and the number of unreadable dates among them, known once the job that reads them is done."""
    seen = Observation()
    return papers.observe(seen, F.count_if("bad_date").alias("bad_dates")), seen


def split_domains(spark: SparkSession, papers_path: str, output: str) -> None:
    """Each paper written once under every domain it belongs to; a rerun replaces the domains it has
    papers for and leaves the others."""
    p = spark.read.parquet(papers_path)
    p = p.select([c for c in p.columns if c != "reject"])
    SK.write_parquet(TM.domain_split(p), output, ["domain"], mode="replace_partitions")


def term_tables(spark: SparkSession, papers_path: str, output: str, k: int = K.TOP_TERMS_PER_CATEGORY) -> dict:
    """C1-C5 + A8: per (domain, n) top-k terms with their year counts, long
    form, partitioned by category and n (the merged table is the whole folder); returns the number of
    papers left out because their date cannot be read."""
    ensure_checkpoint_dir(spark)
    papers = read_papers(spark, papers_path)
    clean = TM.with_clean_text(papers)
    counts = TM.stored(TM.term_year_counts(clean))
    SK.write_parquet(TM.top_terms(counts, k), output, ["category", "n"], mode="replace_partitions")
    # the texts are read in two branches above, so this count reads the dates alone
    return {"bad_dates": papers.where("bad_date").count()}


def domain_stats(spark: SparkSession, papers_path: str, output: str) -> dict:
    """D2 (long form): distinct papers per domain x year, by the rule of ``papers_per_domain_year``;
    returns the number of papers left out because their date cannot be read."""
    p, seen = _counted(read_papers(spark, papers_path))
    rows = p.select("id", F.year("published_date").cast("int").alias("year"),
                    F.explode(target_domains("all_categories")).alias("category"))
    AG.papers_per_domain_year(rows).write.mode("overwrite").parquet(output)
    return seen.get


def monthly(spark: SparkSession, papers_path: str, output: str) -> dict:
    """Zero-filled papers per month ('YYYY-MM', count) as CSV; returns the number of papers left out
    because their date cannot be read."""
    papers = read_papers(spark, papers_path)
    SK.write_csv(AG.monthly_counts(papers).select("date", "count"), output)
    return {"bad_dates": papers.where("bad_date").count()}


def trends(spark: SparkSession, terms_path: str, domains_path: str, output: str, n: int = 2) -> None:
    """F1 + H1 + H3 + E6 + H4 over the term tables (bigrams by default, as
    the reference's merged table) and the domain totals."""
    ensure_checkpoint_dir(spark)
    terms = (spark.read.parquet(terms_path).where(F.col("n") == n)
             .select("category", "term", "year", "count").checkpoint(eager=True))
    domains = spark.read.parquet(domains_path).checkpoint(eager=True)
    merged = T.normalized_long(terms, domains, materialised=True)
    lo, hi = T.year_bounds(merged)
    start, end = T.training_window(hi, lo)
    top = T.top_trends(T.normalized_trends(merged, start, end)).checkpoint(eager=True)
    top.write.mode("overwrite").parquet(f"{output}/summary")
    T.forecast(top, end).write.mode("overwrite").parquet(f"{output}/forecast")


def configured(spark: SparkSession, config_path: str, section: str) -> dict:
    """The term tables and phrase counts of one section of a JSON configuration (``config``): papers
    from ``data_file``, terms and phrases below ``output``; returns the number of unreadable dates."""
    ensure_checkpoint_dir(spark)
    c = load_config(config_path, section)
    output = c.output or f"{section.lower()}_out"
    papers = read_papers(spark, c.data_file)
    counts = TM.stored(TM.term_year_counts(TM.with_clean_text(papers), min_df=c.min_df, min_docs=c.min_docs_per_year,
                                           academic=c.academic_stopwords))
    SK.write_parquet(TM.top_terms(counts, c.top_terms), f"{output}/terms", ["category", "n"], mode="replace_partitions")
    phrases = TM.phrase_period_counts(papers, c.search_terms, quarter_label("published_date"))
    SK.write_csv(phrases, f"{output}/phrases")
    return {"bad_dates": papers.where("bad_date").count()}


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="python -m lexitrend.jobs")
    ap.add_argument("job", choices=["clean_snapshot", "clean_works", "split_domains", "term_tables",
                                    "domain_stats", "monthly", "trends", "configured"])
    ap.add_argument("inputs", nargs="+", help="input path(s) then the output path")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_spark(a.master)
    out = globals()[a.job](spark, *a.inputs)
    if out is not None:
        print(out)


if __name__ == "__main__":
    main()
