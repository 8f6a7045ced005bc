"""Term extraction and counting (A7 split, C1-C7).

One pass over the papers tells which n-grams are too rare to be kept (``grams``), a second one counts the 1-, 2-
and 3-gram terms together where the documents are; then one shuffle on (category, year, n, term)
yields term frequency and document frequency.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..session import checkpoint_path, ensure_checkpoint_dir
from . import grams as GR
from .joins import join_small
from ..functions.categories import target_domains
from ..functions.text import clean_text, count_substring, title_summary_text

#: Characters of text in a piece, and terms that a task's function holds before it hands them on.
PIECE, TERMS_AT_ONCE = 32 << 20, 1_500_000


def with_clean_text(papers: DataFrame) -> DataFrame:
    """B3 + B1: cleaned 'title summary' per paper, year from the date."""
    return papers.select(
        "id",
        F.year("published_date").cast("int").alias("year"),
        target_domains("all_categories").alias("domains"),
        clean_text(title_summary_text("title", "summary")).alias("clean"),
    ).where(F.col("year").isNotNull())


def domain_split(papers: DataFrame) -> DataFrame:
    """One row per (paper, domain) for each distinct domain of the paper."""
    return papers.select("*", F.explode(target_domains("all_categories")).alias("domain"))


def sizes_by_kind(clean: DataFrame) -> DataFrame:
    """Papers and characters per (year, domains): bounded metadata, a row for each year and set of domains."""
    return clean.groupBy("year", "domains").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.length("clean").cast("long")).alias("chars"))


def cells_of(sizes: list, ns, min_df: dict, min_docs: int) -> list[tuple]:
    """(category, year, n, least df) of the (category, year) that have ``min_docs`` papers: the >= 5 rule."""
    docs: Counter = Counter()
    for r in sizes:
        for category in r.domains:
            docs[category, r.year] += r.n_docs
    return [(*c, n, min_df.get(n, 1)) for c in sorted(docs) if docs[c] >= min_docs for n in ns]


def paper_terms(papers: DataFrame, rooms: dict, cells: list[tuple], academic: list[str] | None = None,
                texts: DataFrame | None = None) -> DataFrame:
    """(cells, term, more, again): the n-grams of papers (year, domains, texts: a paper's cleaned texts) with
    the numbers of their ``cells``, the papers but one that they are in, and their occurrences beyond one in
    each, summed over the papers of one year and domains that a task holds; whole texts.

    Unigrams use the English + academic stopword list (C1), longer n-grams
    the English list only, with n-grams formed after removal (C2, C3).  With ``texts`` (year, domains, clean:
    all the texts) n-grams of too few papers for each of their cells are left out as far as the filter of
    ``grams`` tells them; none of enough papers is.
    """
    english = frozenset(K.ENGLISH_STOPWORDS)
    more = frozenset(K.ACADEMIC_STOPWORDS if academic is None else academic) | english
    number = {c[:3]: i for i, c in enumerate(cells)}
    ns = sorted({c[2] for c in cells})
    floors = {n: k for _, _, n, k in cells if k > 1} if texts is not None else {}
    kept, fold, at_once = {"ns": frozenset(floors)}, GR.folded(rooms, [c[1] for c in cells if c[2] in floors]), TERMS_AT_ONCE
    if floors:
        enough = {c[:2] for c in cells}
        parts = texts.select("year", "domains", F.coalesce("clean", F.lit(""))).mapInArrow(
            lambda batches: GR.sketches(batches, rooms, floors, enough, english, more),
            "year int, n int, slice int, domains array<string>, buckets binary")
        found = parts.groupBy("year", "n", "slice").applyInArrow(
            lambda group: GR.passing(group, floors, fold), "category string, year int, n int, slice int, bits binary")
        kept |= GR.gathered(found.collect(), rooms, fold)  # GR.FILTER_BITS at most
    kept = papers.sparkSession.sparkContext.broadcast(kept)
    return papers.select("year", "domains", "texts").mapInArrow(
        lambda batches: GR.counts(batches, ns, kept.value, rooms, fold, number, english, more, at_once),
        "cells array<int>, term string, more long, again long")


def term_year_counts(clean: DataFrame, ns=(1, 2, 3), min_df: dict | None = None,
                     min_docs: int = K.MIN_DOCS_PER_YEAR, academic: list[str] | None = None) -> DataFrame:
    """C4: per (category, year, n, term) total occurrences (tf) and document
    frequency (df); kept when df >= min_df[n] and the (category, year) has
    at least ``min_docs`` papers.  ``academic`` replaces the academic stopwords."""
    spark = clean.sparkSession
    ensure_checkpoint_dir(spark)
    clean = clean.where(F.col("year").isNotNull() & (F.size("domains") > 0))
    by_kind = sizes_by_kind(clean).checkpoint(eager=True)
    sizes = by_kind.collect()
    chars: Counter = Counter()
    for r in sizes:
        chars[r.year] += r.chars or 0
    rooms = {y: GR.room(x) for y, x in chars.items()}
    cells = cells_of(sizes, ns, min_df or K.MIN_DF, min_docs)
    # The text moves once, dealt out by the ids of pieces: about PIECE characters of one year and set of domains,
    # all rows of a paper in one.  So a paper's rows meet, and the n-grams of a piece, many times larger than its
    # text, are combined before they move; a task's share does not grow with the corpus.
    pieces = by_kind.select("year", "domains", F.ceil(F.col("chars") / PIECE).alias("pieces"))
    mine = F.pmod(F.xxhash64("id"), F.greatest(F.col("pieces"), F.lit(1)))
    papers = (join_small(clean, pieces, ["year", "domains"], materialised=True)
              .select(F.xxhash64("year", "domains", mine).alias("id"), F.col("id").alias("paper"), "year", "domains", "clean")
              .repartition(max(2, 4 * chars.total() // PIECE), "id")
              .groupBy("id", "paper", "year", "domains").agg(F.collect_list("clean").alias("texts")))
    # combined by the tasks already: another partial aggregate before the move would hold the same rows
    per_cell = (paper_terms(papers, rooms, cells, academic, clean)
                .select(F.explode("cells").alias("category"), "term", "more", "again").repartition("category", "term")
                .groupBy("category", "term")
                .agg((F.count(F.lit(1)) + F.sum("more")).alias("df"), F.sum("again").alias("again")))
    names = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "cell int, name string, year int, n int, least int")
    return (per_cell.join(F.broadcast(names), F.col("category") == F.col("cell")).where(F.col("df") >= F.col("least"))
            .select(F.col("name").alias("category"), "year", "n", "term", (F.col("df") + F.col("again")).alias("tf"), "df"))


def stored(counts: DataFrame) -> DataFrame:
    """The counts, written once to the checkpoint folder as Parquet: read twice by ``top_terms``, and a
    fraction of what a checkpoint of their rows takes."""
    path = checkpoint_path(counts.sparkSession, f"terms-{uuid.uuid4().hex}")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def top_terms(counts: DataFrame, k: int = K.TOP_TERMS_PER_CATEGORY) -> DataFrame:
    """Total per (category, n, term) over the kept cells; the first k terms
    per (category, n) by total (ties: term), with all their year rows."""
    from pyspark.sql import Window as W
    tot = counts.groupBy("category", "n", "term").agg(F.sum("tf").cast("bigint").alias("total"))
    w = W.partitionBy("category", "n").orderBy(F.desc("total"), F.asc("term"))
    top = tot.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    # a few thousand terms: the counts stay where they are
    return (join_small(counts, top, ["category", "n", "term"])
            .select("category", "n", "term", "year", F.col("tf").alias("count"), "total", "rank"))


def _clean_literal(p: str) -> str:
    """The B1 rule applied to a fixed phrase on the driver."""
    import re
    return re.sub(r"\s+", " ", re.sub(r"[^a-z\s]", "", p.lower())).strip()


def phrase_period_counts(papers: DataFrame, phrases: list[str], period_col) -> DataFrame:
    """Non-overlapping substring occurrences of each fixed phrase in the
    cleaned text, summed per period.  One aggregate with one sum per phrase
    (partial sums map-side), then unpivoted to (phrase, period, count)."""
    phrases = [_clean_literal(p) for p in phrases]
    txt = papers.select(period_col.alias("period"),
                        clean_text(title_summary_text("title", "summary")).alias("s")).where(F.col("period").isNotNull())
    sums = txt.groupBy("period").agg(*[F.sum(count_substring("s", p)).cast("bigint").alias(f"p{i}")
                                       for i, p in enumerate(phrases)])
    stacked = F.explode(F.array(*[F.struct(F.lit(p).alias("phrase"), F.col(f"p{i}").alias("count"))
                                  for i, p in enumerate(phrases)]))
    return sums.select("period", stacked.alias("x")).select("x.phrase", "period", "x.count")
