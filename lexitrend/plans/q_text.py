"""Text group on the paper stand-in."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as K
from ..functions import dates as DT
from ..functions.text import WS_RE, clean_text, flatten_newlines, safe_slug, title_summary_text
from ..operators import langid as LI
from ..operators import terms as TM
from ..sources.tables import table
from . import standins as S
from .registry import register


def _utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# ------------------------------------------------------------ SQL helpers
def sql_clean(x: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower(regexp_replace(coalesce({x}, ''), '{WS_RE}', ' ', 'g')),"
            f" '[^a-z ]', '', 'g'), ' +', ' ', 'g'))")


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def sql_domains(x: str) -> str:
    from ..constants import DOMAIN_MAP
    case = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in DOMAIN_MAP.items())
    return (f"list_sort(list_distinct(list_filter(list_transform(string_split(coalesce({x}, ''), ' '), "
            f"lambda c: CASE split_part(c, '.', 1) {case} END), lambda d: d IS NOT NULL)))")


_EXT = sorted({w for w in K.ENGLISH_STOPWORDS + K.ACADEMIC_STOPWORDS if len(w) > 2})
_EN = sorted({w for w in K.ENGLISH_STOPWORDS if len(w) > 2})

CLEAN_SQL = S.with_ctes(S.PAPERS_SQL, f"""clean AS (
  SELECT id, CAST(year(published_date) AS INTEGER) AS year, {sql_domains('all_categories')} AS domains,
         {sql_clean("title || ' ' || summary")} AS clean
  FROM papers)""", f"""toks AS (
  SELECT id, year, domains,
         list_filter(string_split(clean, ' '), lambda w: length(w) > 2 AND NOT list_contains({sql_list(_EXT)}, w)) AS u,
         list_filter(string_split(clean, ' '), lambda w: length(w) > 2 AND NOT list_contains({sql_list(_EN)}, w)) AS t
  FROM clean)""", """grams AS (
  SELECT id, year, domains, 1 AS n, unnest(u) AS term FROM toks
  UNION ALL
  SELECT id, year, domains, 2 AS n, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM toks
  UNION ALL
  SELECT id, year, domains, 3 AS n,
         unnest(list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) AS term FROM toks)""",
  """per_doc AS (SELECT id, year, domains, n, term, count(*) AS tf FROM grams GROUP BY ALL)""",
  """per_cat0 AS (SELECT year, unnest(domains) AS category, n, term, tf FROM per_doc)""",
  f"""per_cat AS (
  SELECT category, year, n, term, CAST(sum(tf) AS BIGINT) AS tf, CAST(count(*) AS BIGINT) AS df
  FROM per_cat0 GROUP BY ALL
  HAVING count(*) >= CASE n WHEN 1 THEN {K.MIN_DF[1]} WHEN 2 THEN {K.MIN_DF[2]} ELSE {K.MIN_DF[3]} END)""",
  f"""years_ok AS (
  SELECT category, year FROM (SELECT year, unnest(domains) AS category FROM clean)
  GROUP BY ALL HAVING count(*) >= {K.MIN_DOCS_PER_YEAR})""", """counts AS (
  SELECT p.* FROM per_cat p SEMI JOIN years_ok y ON p.category = y.category AND p.year = y.year)""")


def _clean(spark, sf):
    _utc(spark)
    return TM.with_clean_text(S.papers(spark, sf))


_TS = "title || ' ' || summary"


@register("b1_clean_text", S.with_ctes(S.PAPERS_SQL) + f"SELECT id, {sql_clean(_TS)} AS clean FROM papers")
def b1_clean_text(spark, sf):
    """B1 + B3: cleaned 'title summary' of every paper (whole texts)."""
    p = S.papers(spark, sf)
    return p.select("id", clean_text(title_summary_text("title", "summary")).alias("clean"))


@register("b2_flatten_newlines", S.with_ctes(S.PAPERS_SQL) + f"""
SELECT id, coalesce(regexp_replace(replace(title, chr(10), ' '), '^{WS_RE}+|{WS_RE}+$', '', 'g'), '') AS title,
       coalesce(regexp_replace(replace(summary, chr(10), ' '), '^{WS_RE}+|{WS_RE}+$', '', 'g'), '') AS summary
FROM papers""")
def b2_flatten_newlines(spark, sf):
    """B2: newline -> space, stripped, null -> '' for title and summary."""
    p = S.papers(spark, sf)
    return p.select("id", flatten_newlines("title").alias("title"), flatten_newlines("summary").alias("summary"))


@register("b3_text_concat", S.with_ctes(S.PAPERS_SQL) + """
SELECT id, coalesce(title, '') || ' ' || coalesce(summary, '') AS text FROM papers""")
def b3_text_concat(spark, sf):
    """Title + ' ' + summary with nulls read as ''."""
    p = S.papers(spark, sf)
    return p.select("id", title_summary_text("title", "summary").alias("text"))


@register("b23_safe_slug", r"""
SELECT p_partkey, substr(regexp_replace(lower(p_type || ' ' || p_name), '[ /\\]', '_', 'g'), 1, 50) AS slug FROM part""")
def b23_safe_slug(spark, sf):
    """File-safe slug of 'type name' labels."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", safe_slug(F.concat_ws(" ", "p_type", "p_name")).alias("slug"))


@register("b16_target_domains", S.with_ctes(S.PAPERS_SQL) + f"""
SELECT id, all_categories, {sql_domains('all_categories')} AS domains FROM papers""")
def b16_target_domains(spark, sf):
    """Sorted distinct domains of each paper's code list."""
    from ..functions.categories import target_domains
    p = S.papers(spark, sf)
    return p.select("id", "all_categories", target_domains("all_categories").alias("domains"))


@register("c4_term_year_counts", CLEAN_SQL + "SELECT category, year, n, term, tf, df FROM counts")
def c4_term_year_counts(spark, sf):
    """1/2/3-gram term and document frequencies per domain x year,
    df >= 5/3/3, years with >= 5 papers."""
    return TM.term_year_counts(_clean(spark, sf))


def _c5_sql(k: int) -> str:
    return CLEAN_SQL + f""", tot AS (
  SELECT category, n, term, CAST(sum(tf) AS BIGINT) AS total FROM counts GROUP BY ALL),
  top AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category, n ORDER BY total DESC, term) AS INTEGER) AS rank
                         FROM tot) WHERE rank <= {k})
SELECT c.category, c.n, c.term, c.year, c.tf AS count, t.total, t.rank
FROM counts c JOIN top t ON c.category = t.category AND c.n = t.n AND c.term = t.term"""


@register("c5_top_terms", _c5_sql(K.TOP_TERMS_PER_CATEGORY))
def c5_top_terms(spark, sf, k=K.TOP_TERMS_PER_CATEGORY):
    """C5 + C7: first 1000 terms per domain and n by total, their year cells
    (one long table over all domains = the merged term table)."""
    # the counts are read twice (totals, then the kept rows): materialise once
    t = TM.top_terms(TM.stored(TM.term_year_counts(_clean(spark, sf))), k)
    return t.withColumn("rank", F.col("rank").cast("int"))


@register("c5_top_terms_small", _c5_sql(15))
def c5_top_terms_small(spark, sf):
    """C5 with 15 terms per domain and n, fewer than there are."""
    return c5_top_terms(spark, sf, 15)


def _phrase_sql() -> str:
    vals = ", ".join(f"('{p}')" for p in K.SEARCH_PHRASES)
    return S.with_ctes(S.PAPERS_SQL, f"""c AS (
  SELECT CAST(year(published_date) AS VARCHAR) || 'Q' || CAST(quarter(published_date) AS VARCHAR) AS period,
         {sql_clean("title || ' ' || summary")} AS s
  FROM papers WHERE published_date IS NOT NULL)""", f"""ph AS (SELECT * FROM (VALUES {vals}) v(phrase))""") + """
SELECT phrase, period, CAST(sum((length(s) - length(replace(s, phrase, ''))) // length(phrase)) AS BIGINT) AS count
FROM c, ph GROUP BY phrase, period"""


@register("c6_phrase_quarterly", _phrase_sql())
def c6_phrase_quarterly(spark, sf):
    """Fixed-phrase substring counts per quarter, one pass for all phrases."""
    _utc(spark)
    p = S.papers(spark, sf)
    return TM.phrase_period_counts(p, K.SEARCH_PHRASES, DT.quarter_label("published_date"))


# ------------------------------------------------------------ B12
def _langid_sql() -> str:
    return S.with_ctes(S.PAPERS_SQL.replace("SELECT doc_id AS id,", "SELECT doc_id AS id, lang,"), """tr AS (
  SELECT lang, ' ' || lower(coalesce(text, '')) || ' ' AS s
  FROM (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY md5(coalesce(text, ''))) AS k
        FROM documents WHERE lang IS NOT NULL) )""", """tg AS (
  SELECT lang, substr(s, i, 3) AS gram FROM (SELECT lang, s, unnest(range(1, greatest(length(s) - 2, 1) + 1)) AS i FROM tr)
  WHERE length(substr(s, i, 3)) = 3)""", """model AS (SELECT gram, lang, count(*) AS c FROM tg GROUP BY ALL)""",
  """ls AS (SELECT d.lang, d.docs, g.grams FROM (SELECT lang, count(*) AS docs FROM documents WHERE lang IS NOT NULL GROUP BY lang) d
           JOIN (SELECT lang, sum(c) AS grams FROM model GROUP BY lang) g ON d.lang = g.lang)""",
  """v AS (SELECT count(DISTINCT gram) AS vocab, (SELECT sum(docs) FROM ls) AS total FROM model)""",
  """ti AS (SELECT id, title AS raw, ' ' || lower(coalesce(title, '')) || ' ' AS s FROM papers)""",
  """tgr AS (
  SELECT id, gram, count(*) AS k FROM (
    SELECT id, substr(s, i, 3) AS gram FROM (SELECT id, s, unnest(range(1, greatest(length(s) - 2, 1) + 1)) AS i FROM ti))
  WHERE length(gram) = 3 GROUP BY ALL)""", """part AS (
  SELECT tgr.id, m.lang, sum(k * ln(m.c + 1.0)) AS p FROM tgr JOIN model m ON tgr.gram = m.gram GROUP BY ALL)""",
  """sc AS (
  SELECT ti.id, ti.raw, ls.lang,
         coalesce(part.p, 0.0) + ln(ls.docs / v.total) - greatest(length(ti.s) - 2, 0) * ln(ls.grams + v.vocab) AS score
  FROM ti CROSS JOIN ls CROSS JOIN v LEFT JOIN part ON part.id = ti.id AND part.lang = ls.lang)""") + """
SELECT id, lang AS lang_pred, (raw IS NOT NULL AND length(raw) >= 3 AND lang = 'en') AS is_english FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang DESC) AS rn FROM sc) WHERE rn = 1"""


@register("b12_language_gate", _langid_sql())
def b12_language_gate(spark, sf):
    """Title language gate: a char-trigram naive-Bayes model fitted on
    all labelled documents, applied to every paper title (argmax label;
    null or < 3 characters -> not English)."""
    model, stats, vocab = LI.fit(table(spark, sf, "documents"), "text", "lang")
    return LI.predict(S.papers(spark, sf), model, stats, vocab, "id", "title")
