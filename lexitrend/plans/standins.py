"""Stand-in inputs derived from the supplied tables (the reference's own
paper corpus is not available).  Each Spark builder has a matching SQL
common-table expression used by the oracle; both must define the same rows.

  long term table  : lineitem x part  -> (category=p_type, term=p_name, year, count)
  domain totals    : distinct orders per p_type x year -> (category, year, total_papers)
  monthly counts   : orders.o_orderdate
  topic series     : lineitem x part by quarter -> (topic=p_type, period 'YYYYQn', count)
  clean papers     : documents -> (id, title, summary, published_date, authors,
                                   primary_category, all_categories)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import quarter_label
from ..sources.tables import table


def term_year(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrences of each part name per part type and ship year.

    lineitem is pre-aggregated on (partkey, year) before the join, so the
    join and the second aggregate see one row per part and year, not per
    line.  The join strategy is left to the planner (part grows with scale).
    """
    li = (table(spark, sf, "lineitem")
          .groupBy("l_partkey", F.year("l_shipdate").cast("int").alias("year"))
          .agg(F.count(F.lit(1)).alias("n")))
    pa = table(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
            .groupBy(F.col("p_type").alias("category"), F.col("p_name").alias("term"), "year")
            .agg(F.sum("n").cast("bigint").alias("count")))


TERM_YEAR_SQL = """term_year AS (
  SELECT p_type AS category, p_name AS term, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(count(*) AS BIGINT) AS count
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_type, p_name, year(l_shipdate))"""


def domain_year(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders per part type and ship year (the 'papers per domain')."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey",
                                             F.year("l_shipdate").cast("int").alias("year"))
    pa = table(spark, sf, "part").select("p_partkey", "p_type")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
            .groupBy(F.col("p_type").alias("category"), "year")
            .agg(F.count_distinct("l_orderkey").cast("bigint").alias("total_papers")))


DOMAIN_YEAR_SQL = """domain_year AS (
  SELECT p_type AS category, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(count(DISTINCT l_orderkey) AS BIGINT) AS total_papers
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_type, year(l_shipdate))"""


def order_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dated records for the calendar group: one row per order."""
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"),
                                            F.col("o_orderdate").alias("published_date"))


def topic_period(spark: SparkSession, sf: str) -> DataFrame:
    """Quarterly series per topic: line items per part type and ship quarter."""
    li = (table(spark, sf, "lineitem")
          .groupBy("l_partkey", quarter_label("l_shipdate").alias("period"))
          .agg(F.count(F.lit(1)).alias("n")))
    pa = table(spark, sf, "part").select("p_partkey", "p_type")
    return (li.join(pa, li.l_partkey == pa.p_partkey)
            .groupBy(F.initcap(F.col("p_type")).alias("topic"), "period")
            .agg(F.sum("n").cast("bigint").alias("count")))


TOPIC_PERIOD_SQL = """topic_period AS (
  SELECT upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS topic,
         CAST(year(l_shipdate) AS VARCHAR) || 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS period,
         CAST(count(*) AS BIGINT) AS count
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY ALL)"""

# Deterministic category codes for the paper stand-in (test mapping, not a
# reference value): codes of one domain side by side, an unknown prefix,
# a code without '.', and an empty list every 23rd paper.
PAPER_CODES = [
    "cs.AI", "cs.LG", "stat.ML", "math.ST", "math-ph", "econ.EM", "q-fin.ST",
    "eess.SP", "q-bio.NC", "physics.soc-ph", "astro-ph.CO", "hep-th",
    "quant-ph", "cond-mat.stat-mech", "xyz.AB", "cs.CL", "nlin.AO", "gr-qc",
]
EMPTY_CODES_EVERY = 23
DATE_ORIGIN = "2015-01-01"
DATE_SPAN_DAYS = 4000


def _codes_col(doc_id):
    arr = F.array(*[F.lit(c) for c in PAPER_CODES])
    k = len(PAPER_CODES)
    a = F.element_at(arr, (doc_id % k + 1).cast("int"))
    b = F.element_at(arr, ((doc_id * 7 + 3) % k + 1).cast("int"))
    return F.when(doc_id % EMPTY_CODES_EVERY == 0, F.lit("")).otherwise(F.concat(a, F.lit(" "), b))


def papers(spark: SparkSession, sf: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Clean-paper stand-in from ``documents`` (whole texts).

    title = first line of the text, summary = the rest; published_date =
    2015-01-01 + (doc_id*37 mod 4000) days; two category codes per paper.
    ``extra`` carries further ``documents`` columns (e.g. ``lang``).
    """
    d = table(spark, sf, "documents").select("doc_id", "text", *extra)
    title = F.substring_index(F.col("text"), "\n", 1)
    return d.select(
        F.col("doc_id").alias("id"),
        title.alias("title"),
        F.expr("substring(text, char_length(substring_index(text, '\\n', 1)) + 2)").alias("summary"),
        F.date_add(F.lit(DATE_ORIGIN).cast("date"), ((F.col("doc_id") * 37) % DATE_SPAN_DAYS).cast("int")).alias("published_date"),
        F.lit(None).cast("array<string>").alias("authors"),
        F.get(F.split(_codes_col(F.col("doc_id")), " "), 0).alias("primary_category"),
        _codes_col(F.col("doc_id")).alias("all_categories"),
        *extra,
    )


def _codes_sql() -> str:
    lst = ", ".join(f"'{c}'" for c in PAPER_CODES)
    k = len(PAPER_CODES)
    return (f"CASE WHEN doc_id % {EMPTY_CODES_EVERY} = 0 THEN '' ELSE "
            f"[{lst}][doc_id % {k} + 1] || ' ' || [{lst}][(doc_id * 7 + 3) % {k} + 1] END")


PAPERS_SQL = f"""papers AS (
  SELECT doc_id AS id,
         split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS summary,
         CAST(DATE '{DATE_ORIGIN}' + CAST((doc_id * 37) % {DATE_SPAN_DAYS} AS INTEGER) AS DATE) AS published_date,
         {_codes_sql()} AS all_categories
  FROM documents)"""


# Column values of the wide tables, listed so that each oracle is one plain SELECT.
SHIP_YEARS = list(range(1995, 2002))
PAPER_YEARS = list(range(2015, 2026))
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def pivot_sql(column: str, values: list, value: str, kind: str = "BIGINT") -> str:
    """One 0-filled sum per value of ``column``, named by it."""
    lit = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join(f'CAST(coalesce(sum(CASE WHEN {column} = {lit(v)} THEN {value} END), 0) AS {kind}) AS "{v}"'
                     for v in values)


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _hadoop(spark: SparkSession, path: str):
    """(file system, Path class) behind a path."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark._jsc.hadoopConfiguration()), p


def put_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file with this text."""
    fs, p = _hadoop(spark, path)
    out = fs.create(p(path))
    out.write(bytearray(text, "utf-8"))
    out.close()


def move_folders(spark: SparkSession, written: str, prefix: str, to: str, name: str) -> None:
    """Give each `<prefix><value>` folder under ``written`` the name that a value's file has: its part files
    are then that file in parts."""
    fs, p = _hadoop(spark, written)
    fs.mkdirs(p(to))
    for folder in fs.listStatus(p(written)):
        value = folder.getPath().getName()
        if value.startswith(prefix):
            fs.rename(folder.getPath(), p(f"{to}/{name.format(value.removeprefix(prefix))}"))
