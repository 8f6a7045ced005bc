"""Corpus group: raw nested records, CSV round trips, domain split.

Raw inputs are rendered from ``documents`` by Spark (JSON lines, gzip),
written under the session's checkpoint folder and read back through the
real readers, so the scans, parsers and sinks are exercised end to end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import records as RC
from ..functions.categories import code_domain, code_prefix, domain_map_df, primary_category, target_domains
from ..functions.text import WS_RE, flatten_newlines
from ..operators import aggregates as AG
from ..operators import langid as LI
from ..operators import terms as TM
from ..session import checkpoint_path
from ..sources import corpus as CO
from ..sources import sinks as SK
from ..sources.tables import table
from . import q_text as QT
from . import standins as S
from .registry import register

MALFORMED_EVERY = 29      # every 29th raw snapshot line is cut in half
NO_VERSIONS_EVERY = 11    # no versions array -> update_date is used
SHORT_AUTHOR_EVERY = 13   # one author entry with a single part -> rejected
NULL_CATS_EVERY = 41      # categories omitted
WORKS_BAD_EVERY = 31      # every 31st works line is garbage
NO_ID_EVERY = 37          # every 37th work has no id
SAME_ID_EVERY = 5         # every 5th of the others has one and the same id


def _scratch(spark, name: str) -> str:
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _author(k_last, k_first):
    return F.array(F.concat(F.lit("Last"), k_last.cast("string")), F.concat(F.lit("First"), k_first.cast("string")), F.lit(""))


def snapshot_lines(spark, sf):
    """Raw snapshot JSON lines rendered from the paper stand-in."""
    p = S.papers(spark, sf)
    d = F.col("id")
    ts = F.timestamp_seconds(F.unix_timestamp(F.col("published_date").cast("timestamp")) + d % 86400)
    rfc = F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    a1 = _author(d % 97, d % 89)
    a2 = F.when(d % SHORT_AUTHOR_EVERY == 0, F.array(F.concat(F.lit("Last"), ((d * 3 + 1) % 97).cast("string")))) \
          .otherwise(_author((d * 3 + 1) % 97, (d * 5 + 2) % 89))
    rec = F.struct(
        F.concat(F.lit("p"), d.cast("string")).alias("id"),
        F.col("title").alias("title"), F.col("summary").alias("abstract"),
        F.when(d % NULL_CATS_EVERY == 0, F.lit(None)).otherwise(F.col("all_categories")).alias("categories"),
        F.date_format("published_date", "yyyy-MM-dd").alias("update_date"),
        F.when(d % NO_VERSIONS_EVERY == 0, F.lit(None)).otherwise(F.array(F.struct(rfc.alias("created")))).alias("versions"),
        F.array(a1, a2).alias("authors_parsed"))
    js = F.to_json(rec)
    return p.select(F.when(d % MALFORMED_EVERY == 0, F.substring(js, 1, 40)).otherwise(js).alias("value"))


def clean_snapshot(raw):
    """A1 + B2 + B4-B7: raw snapshot rows -> 7-column clean papers; rows
    with a short author entry go to the reject side."""
    good = raw.where(~RC.has_short_author("authors_parsed"))
    cats = F.coalesce(F.col("categories"), F.lit(""))
    return good.select(
        RC.abs_url("id").alias("id"), flatten_newlines("title").alias("title"),
        flatten_newlines("abstract").alias("summary"),
        RC.first_version_date("versions", "update_date").alias("published_date"),
        RC.format_authors("authors_parsed").alias("authors"),
        primary_category(cats).alias("primary_category"), cats.alias("all_categories"))


def _snapshot(spark, sf):
    _utc(spark)
    path = _scratch(spark, "a1-snapshot")
    snapshot_lines(spark, sf).write.mode("overwrite").text(path)
    return CO.read_json_lines(spark, path, CO.SNAPSHOT_SCHEMA)


def _b2(x):
    return f"coalesce(regexp_replace(replace({x}, chr(10), ' '), '^{WS_RE}+|{WS_RE}+$', '', 'g'), '')"


_CATS = f"CASE WHEN doc_id % {NULL_CATS_EVERY} = 0 THEN '' ELSE all_categories END"
A1_SQL = S.with_ctes(S.PAPERS_SQL.replace("SELECT doc_id AS id,", "SELECT doc_id AS id, doc_id,")) + f"""
SELECT '{K.PAPER_URL_PREFIX}p' || CAST(doc_id AS VARCHAR) || '{K.PAPER_URL_SUFFIX}' AS id, {_b2('title')} AS title, {_b2('summary')} AS summary,
       CASE WHEN doc_id % {NO_VERSIONS_EVERY} = 0 THEN strftime(published_date, '%Y-%m-%d')
            ELSE strftime(CAST(published_date AS TIMESTAMP) + to_seconds(CAST(doc_id % 86400 AS BIGINT)), '%a, %-d %b %Y %H:%M:%S') || ' GMT'
       END AS published_date,
       ['First' || CAST(doc_id % 89 AS VARCHAR) || ' Last' || CAST(doc_id % 97 AS VARCHAR),
        'First' || CAST((doc_id * 5 + 2) % 89 AS VARCHAR) || ' Last' || CAST((doc_id * 3 + 1) % 97 AS VARCHAR)] AS authors,
       split_part({_CATS}, ' ', 1) AS primary_category, {_CATS} AS all_categories
FROM papers WHERE doc_id % {MALFORMED_EVERY} <> 0 AND doc_id % {SHORT_AUTHOR_EVERY} <> 0"""


@register("a1_json_corpus", A1_SQL)
def a1_json_corpus(spark, sf):
    """A1: JSON-lines snapshot scan (explicit schema, PERMISSIVE) -> clean papers."""
    good, _ = CO.split_corrupt(_snapshot(spark, sf))
    return clean_snapshot(good)


@register("a1_rejects", f"""
SELECT 'malformed' AS reason, CAST(count(*) AS BIGINT) AS n FROM documents WHERE doc_id % {MALFORMED_EVERY} = 0
UNION ALL
SELECT 'short_author' AS reason, CAST(count(*) AS BIGINT) AS n FROM documents
WHERE doc_id % {SHORT_AUTHOR_EVERY} = 0 AND doc_id % {MALFORMED_EVERY} <> 0""")
def a1_rejects(spark, sf):
    """A1 side output: malformed lines and rejected rows, counted."""
    raw = _snapshot(spark, sf)
    reason = (F.when(F.col(CO.CORRUPT).isNotNull(), F.lit("malformed"))
              .when(RC.has_short_author("authors_parsed"), F.lit("short_author")))
    return (raw.select(reason.alias("reason")).where(F.col("reason").isNotNull())
            .groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("n")))


def works_lines(spark, sf):
    """Raw works JSON lines (with a word -> positions abstract index) from documents."""
    # partitioned by id: an id's texts meet without a further exchange, and the word -> positions index
    # is made row by row, from the sorted (word, position) pairs
    p = S.papers(spark, sf, extra=("lang",)).repartition("id")
    p = p.withColumn("texts", F.collect_list("summary").over(W.partitionBy("id")))
    words = lambda t: F.split(F.trim(F.regexp_replace(t, f"{WS_RE}+", " ")), " ")
    p = p.withColumn("pairs", F.sort_array(F.flatten(F.transform("texts", lambda t: F.transform(
        words(t), lambda w, i: F.struct(w.alias("word"), i.alias("pos")))))))
    first = F.transform("pairs", lambda x, i: F.when((i == 0) | (x["word"] != F.get("pairs", i - 1)["word"]), i))
    p = p.withColumn("first", F.filter(first, lambda i: i.isNotNull()))
    index = F.map_from_entries(F.transform("first", lambda i, k: F.struct(
        F.get("pairs", i)["word"], F.transform(F.slice("pairs", i + 1, F.coalesce(F.get("first", k + 1), F.size("pairs")) - i),
                                               lambda x: x["pos"]))))
    full = p.withColumn("idx", F.when(F.col("id").isNotNull() & (F.size("texts") > 0), index))
    d = F.col("id")
    name = F.concat(F.lit("First"), (d % 89).cast("string"), F.lit(" Last"), (d % 97).cast("string"))
    authorships = F.array(F.struct(F.struct(name.alias("display_name")).alias("author")),
                          F.when(d % 7 == 0, F.struct(F.struct(F.lit(None).cast("string").alias("display_name")).alias("author")))
                          .otherwise(F.struct(F.struct(F.lit("Second Author").alias("display_name")).alias("author"))))
    topic = F.when(d % 3 == 0, F.lit(None)).otherwise(F.struct(F.concat(F.lit("Topic "), (d % 10).cast("string")).alias("display_name")))
    concepts = F.when((d % 3 == 0) & (d % 2 == 0), F.array(F.struct(F.concat(F.lit("Concept "), (d % 5).cast("string")).alias("display_name")))) \
        .otherwise(F.array().cast("array<struct<display_name:string>>"))
    rec = F.struct(work_id(d).alias("id"), F.col("title"), F.col("lang").alias("language"),
                   F.date_format("published_date", "yyyy-MM-dd").alias("publication_date"),
                   authorships.alias("authorships"), topic.alias("primary_topic"), concepts.alias("concepts"),
                   F.when(F.col("summary") == "", F.lit(None)).otherwise(F.col("idx")).alias("abstract_inverted_index"))
    return full.select(F.when(d % WORKS_BAD_EVERY == 0, F.lit("{not json")).otherwise(F.to_json(rec)).alias("value"))


def flatten_works(raw, labelled, list_authors=False, docs=None):
    """A2 + B8-B12: works that metadata and title gate call English -> 6-column clean rows with the
    abstract rebuilt.  The gate is fitted on all of ``labelled`` (text, lang) and judges titles, each distinct
    one once, so works without an id or with one that others bear are judged by their own title; titles
    that are null or shorter than 3 characters never pass.  ``list_authors`` gives the names as an array."""
    en = raw.where((F.col("language") == "en") & (F.length("title") >= 3))
    model, stats, vocab = LI.fit(labelled, "text", "lang", docs=docs)
    # works are dealt out by title once, and not sorted: the titles are the small side
    english = LI.english_texts(en, "title", model, stats, vocab).hint("shuffle_hash")
    en = en.withColumn("_key", LI.text_key("title")).join(english, "_key", "left_semi").drop("_key")
    authors = RC.author_names("authorships") if list_authors else RC.join_author_names("authorships")
    return en.select(F.col("id"), F.col("title"), F.col("publication_date").alias("published_date"),
                     authors.alias("authors"),
                     RC.work_category("primary_topic", "concepts").alias("primary_category"),
                     RC.reconstruct_abstract("abstract_inverted_index").alias("summary"))


def work_id(d):
    """Ids of the works stand-in: some works have none, some share one."""
    return (F.when(d % NO_ID_EVERY == 0, F.lit(None).cast("string")).when(d % SAME_ID_EVERY == 0, F.lit("W-same"))
            .otherwise(F.concat(F.lit("W"), d.cast("string"))))


@register("a2_works_corpus", S.with_ctes(f"gate AS ({QT._langid_sql()})", S.PAPERS_SQL.replace("SELECT doc_id AS id,", "SELECT doc_id AS id, doc_id, lang,")) + f"""
SELECT CASE WHEN doc_id % {NO_ID_EVERY} = 0 THEN NULL WHEN doc_id % {SAME_ID_EVERY} = 0 THEN 'W-same'
            ELSE 'W' || CAST(doc_id AS VARCHAR) END AS id, title, strftime(published_date, '%Y-%m-%d') AS published_date,
       'First' || CAST(doc_id % 89 AS VARCHAR) || ' Last' || CAST(doc_id % 97 AS VARCHAR) || ', ' ||
         CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'Second Author' END AS authors,
       CASE WHEN doc_id % 3 <> 0 THEN 'Topic ' || CAST(doc_id % 10 AS VARCHAR)
            WHEN doc_id % 2 = 0 THEN 'Concept ' || CAST(doc_id % 5 AS VARCHAR) ELSE '' END AS primary_category,
       trim(regexp_replace(summary, '{WS_RE}+', ' ', 'g')) AS summary
FROM papers WHERE lang = 'en' AND doc_id % {WORKS_BAD_EVERY} <> 0 AND doc_id IN (SELECT id FROM gate WHERE is_english)""")
def a2_works_corpus(spark, sf):
    """A2: many gzip JSON-lines files scanned in parallel (explicit map schema
    for the abstract index), bad lines dropped, English rows flattened."""
    path = _scratch(spark, "a2-works")
    works_lines(spark, sf).write.mode("overwrite").option("compression", "gzip").text(path)
    raw = CO.read_json_lines(spark, path + "/*.gz", CO.WORKS_SCHEMA)
    good, _ = CO.split_corrupt(raw)
    return flatten_works(good, table(spark, sf, "documents"))


def _papers_csv(spark, sf, columns):
    """A6 sink (quote-all CSV with header) then A3 scan with column pruning."""
    path = _scratch(spark, "a6-papers")
    p = S.papers(spark, sf).withColumn("authors", F.lit(None).cast("string"))
    SK.write_csv(p.select([f.name for f in CO.PAPERS_CSV_SCHEMA.fields]), path)
    return CO.read_csv(spark, path, columns, multi_line=None)  # the files tell whether texts hold line breaks


@register("a6_csv_roundtrip", S.with_ctes(S.PAPERS_SQL) + """
SELECT CAST(id AS VARCHAR) AS id, title, summary, strftime(published_date, '%Y-%m-%d') AS published_date, all_categories FROM papers""")
def a6_csv_roundtrip(spark, sf):
    """A6 + A3: quote-all CSV sink and header CSV scan (multi-line quoted
    fields) give back the same rows; only the asked columns are read."""
    p = _papers_csv(spark, sf, ["id", "title", "summary", "published_date", "all_categories"])
    # an empty field reads back as null; text columns take '' as the reference does
    return p.select("id", *[F.coalesce(c, F.lit("")).alias(c) for c in ["title", "summary"]],
                    "published_date", F.coalesce("all_categories", F.lit("")).alias("all_categories"))


def domain_year_pivot(papers, years=None):
    """Distinct papers per domain x year (``aggregates.papers_per_domain_year``), pivoted over the
    (explicit) years, 0-filled, rows by total descending."""
    from ..functions.dates import parse_timestamp
    p = (papers.select("id", F.year(parse_timestamp("published_date")).cast("int").alias("year"),
                       F.explode(F.split(F.coalesce("all_categories", F.lit("")), " ")).alias("code"))
         .select("id", "year", code_domain("code").alias("domain")))
    p = AG.papers_per_domain_year(p, "domain")
    if years is None:
        years = sorted(r[0] for r in p.select("year").distinct().collect())
    cols = [str(y) for y in years]
    w = p.groupBy("domain").pivot("year", years).agg(F.first("total_papers")).na.fill(0, subset=cols)
    from ..operators.reshape import row_total
    return w.orderBy(F.desc(row_total(cols)), F.asc("domain"))


@register("d2_domain_year_pivot", S.with_ctes(S.PAPERS_SQL, f"""pd AS (
  SELECT DISTINCT id, CAST(year(published_date) AS INTEGER) AS year, unnest({QT.sql_domains('all_categories')}) AS domain FROM papers)""",
  """dom AS (SELECT DISTINCT domain FROM pd)""", """yrs AS (SELECT DISTINCT year FROM pd)""", """cnt AS (
  SELECT d.domain, y.year, (SELECT count(*) FROM pd WHERE pd.domain = d.domain AND pd.year = y.year) AS n
  FROM dom d CROSS JOIN yrs y)""") + f"""
SELECT domain, {S.pivot_sql("year", S.PAPER_YEARS, "n")} FROM cnt GROUP BY domain""")
def d2_domain_year_pivot(spark, sf):
    """D2 over an A6/A3 CSV round trip (pruned to id, date, codes)."""
    _utc(spark)
    return domain_year_pivot(_papers_csv(spark, sf, ["id", "published_date", "all_categories"]))


@register("f5_code_domain_join", S.with_ctes(S.PAPERS_SQL) + f"""
SELECT id, code, split_part(code, '.', 1) AS prefix,
       CASE split_part(code, '.', 1) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DOMAIN_MAP.items())} END AS domain
FROM (SELECT id, unnest(string_split(all_categories, ' ')) AS code FROM papers)
WHERE CASE split_part(code, '.', 1) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in K.DOMAIN_MAP.items())} END IS NOT NULL""")
def f5_code_domain_join(spark, sf):
    """Category code -> prefix -> domain by a broadcast join with
    the fixed 20-row map (unknown prefixes dropped)."""
    p = S.papers(spark, sf).select("id", F.explode(F.split("all_categories", " ")).alias("code"))
    p = p.withColumn("prefix", code_prefix("code"))
    m = domain_map_df(spark)
    return p.join(F.broadcast(m), "prefix").select("id", "code", "prefix", "domain")


@register("a7_domain_split", S.with_ctes(S.PAPERS_SQL) + f"""
SELECT domain, id, CAST(year(published_date) AS INTEGER) AS year
FROM (SELECT id, published_date, unnest({QT.sql_domains('all_categories')}) AS domain FROM papers)""")
def a7_domain_split(spark, sf):
    """A7 multi-sink (one folder per domain, a paper in each of its domains)
    read back by partition discovery (A5: the domain comes from the folder)."""
    path = _scratch(spark, "a7-domains")
    p = TM.domain_split(S.papers(spark, sf)).select("id", F.year("published_date").cast("int").alias("year"), "domain")
    SK.write_parquet(p, path, ["domain"])
    return spark.read.parquet(path).select("domain", "id", "year")


@register("a8_term_sinks", QT.CLEAN_SQL + f""", tot AS (
  SELECT category, n, term, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY ALL),
  top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category, n ORDER BY total DESC, term) AS INTEGER) AS rank
                         FROM tot) WHERE rank <= {K.TOP_TERMS_PER_CATEGORY})
SELECT c.category, c.n, c.term, c.year, c.tf AS count, t.total, t.rank
FROM counts c JOIN top t ON c.category = t.category AND c.n = t.n AND c.term = t.term""")
def a8_term_sinks(spark, sf):
    """Per-category, per-n result tables written partitioned and read back."""
    path = _scratch(spark, "a8-terms")
    t = QT.c5_top_terms(spark, sf)
    SK.write_parquet(t, path, ["category", "n"])
    return spark.read.parquet(path).select("category", F.col("n").cast("int").alias("n"), "term", "year", "count",
                                           "total", "rank")


@register("a4_topic_folder", S.with_ctes(S.TOPIC_PERIOD_SQL) + "SELECT topic, period, count FROM topic_period")
def a4_topic_folder(spark, sf):
    """A4: per-topic (period, count) CSV files in one folder, stacked back
    with the topic label rebuilt from the file's name."""
    _utc(spark)
    path = _scratch(spark, "a4-topics")
    tp = S.topic_period(spark, sf).withColumn(
        "topic", F.concat(F.lower(F.regexp_replace("topic", " ", "_")), F.lit("_quarterly_counts")))
    SK.write_csv(tp.select("topic", "period", "count"), path, ["topic"])
    return CO.read_topic_folder(spark, path)


BAD_DATE_EVERY = 19       # papers of the category files whose date cannot be read
#: Planted category files: name, text; none of them gives a row.
PLANTED_FILES = [("arxiv_void.csv", ""), ("arxiv_header_only.csv", "id,title,summary,published_date\n"),
                 ("arxiv_long_row.csv", "id,title,summary,published_date\n1,a,b,2020-01-01\n2,a,b,2020-01-01,more\n"),
                 ("arxiv_no_date.csv", "id,title,summary\n1,a,b\n")]


def _category_folder(spark, sf) -> str:
    """One `arxiv_X.csv` per domain, in parts, with the planted files beside them."""
    _utc(spark)
    path = _scratch(spark, "a5-categories")
    p = TM.domain_split(S.papers(spark, sf))
    day = F.when(F.col("id") % BAD_DATE_EVERY == 0, F.lit("unknown")).otherwise(F.date_format("published_date", "yyyy-MM-dd"))
    p = p.select(F.col("id").cast("string").alias("id"), "title", "summary", day.alias("published_date"), "domain")
    # a file is written in parts of bounded size, as a category's papers may be any number
    SK.write_csv(p.hint("rebalance", "domain"), f"{path}/written", ["domain"])
    S.move_folders(spark, f"{path}/written", "domain=", f"{path}/files", "arxiv_{}.csv")
    for name, text in PLANTED_FILES:
        S.put_file(spark, f"{path}/files/{name}", text)
    return f"{path}/files"


_A5_SQL = S.with_ctes(S.PAPERS_SQL, f"""split AS (
  SELECT *, unnest({QT.sql_domains('all_categories')}) AS category FROM papers)""")


@register("a5_category_files", _A5_SQL + f"""
SELECT category, CAST(id AS VARCHAR) AS id, nullif(title, '') AS title, nullif(summary, '') AS summary,
       CAST(year(published_date) AS INTEGER) AS year
FROM split WHERE id % {BAD_DATE_EVERY} <> 0""")
def a5_category_files(spark, sf):
    """A5: a folder with one CSV file per category, the category from the file's name; files that are
    empty or cannot be read cost only themselves, rows without a readable date are dropped."""
    rows, _ = CO.category_files(spark, _category_folder(spark, sf), ["id", "title", "summary"])
    return rows.select("category", "id", "title", "summary", F.year("published_date").cast("int").alias("year"))


@register("a5_file_status", _A5_SQL + f"""
SELECT 'arxiv_' || category || '.csv' AS file, 'read' AS status, NULL AS reason, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) FILTER (WHERE id % {BAD_DATE_EVERY} = 0) AS BIGINT) AS n_rejected
FROM split GROUP BY category
UNION ALL SELECT 'arxiv_void.csv', 'unreadable', 'no header', 0, 0
UNION ALL SELECT 'arxiv_header_only.csv', 'empty', NULL, 0, 0
UNION ALL SELECT 'arxiv_long_row.csv', 'unreadable', 'row with more fields than the header', 0, 0
UNION ALL SELECT 'arxiv_no_date.csv', 'unreadable', 'column missing', 0, 0""")
def a5_file_status(spark, sf):
    """A5: what became of each category file, with the rows read and those dropped for their date."""
    _, found = CO.category_files(spark, _category_folder(spark, sf), ["id", "title", "summary"])
    return found.select("file", "status", "reason", "n_rows", "n_rejected")
