"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents, flattened into
numpy node arrays and scored for a whole Arrow batch at once.  Chosen features
carry a monotonic constraint: with more symbols, repeats, duplicate lines, bangs
or capitals a document never scores better.

Defined results: null or empty text has no words, fails the base rule and is not
kept; repeated rows are judged one by one; extra columns are not read; an empty
table gives an empty result; without labels of both classes the base rule decides.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import stats
from .common import ready, schema, texts, whole_row

#: Labelled rows of either class that a model is fitted on, at most.
SAMPLE_PER_CLASS = 4000
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Share of the labelled good documents that the threshold must keep.
KEEP_GOOD = 0.98
#: Parts of the sample for cross-fitted scores.
FOLDS = 4
NEVER_BETTER_WITH_MORE = ["symbols_per_word", "dup_lines", "repeat_words", "upper", "bangs_per_word", "bars_per_word"]


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float
    cut: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the good class for every row of ``x``."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, n_trees: int = 60, depth: int = 3,
              rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: int = 10) -> Trees:
    """Second-order boosting on histograms; ``monotone`` holds -1, 0 or 1 per feature."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    p0 = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(p0 / (1 - p0)))
    margin = np.full(len(y), base)
    feat, thr, left, right, val, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feat)
        for a, v in ((feat, 0), (thr, 0.0), (left, k), (right, k), (val, 0.0)):
            a.append(v)
        return k

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), 0, -np.inf, np.inf)]
        while todo:
            k, rows, level, low, high = todo.pop()
            gs, hs = g[rows].sum(), h[rows].sum()
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for j, c in enumerate(cuts):
                    if not len(c):
                        continue
                    cj = code[rows, j]
                    gl = np.cumsum(np.bincount(cj, g[rows], len(c) + 1))[:-1]
                    hl = np.cumsum(np.bincount(cj, h[rows], len(c) + 1))[:-1]
                    nl = np.cumsum(np.bincount(cj, minlength=len(c) + 1))[:-1]
                    vl = np.clip(gl / (hl + ridge), low, high)
                    vr = np.clip((gs - gl) / (hs - hl + ridge), low, high)
                    gain = gl ** 2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs ** 2 / (hs + ridge)
                    bad = (nl < least) | (len(rows) - nl < least) | (monotone[j] * (vr - vl) < 0)
                    gain[bad] = -1
                    i = int(np.argmax(gain))
                    if gain[i] > best[0]:
                        best = (float(gain[i]), (j, i, float(vl[i]), float(vr[i])))
            if best[1] is None:
                val[k] = rate * float(np.clip(gs / (hs + ridge), low, high))
                margin[rows] += val[k]
                continue
            j, i, vl, vr = best[1]
            feat[k], thr[k], left[k], right[k] = j, float(cuts[j][i]), node(), node()
            mid = (vl + vr) / 2
            lo_l, hi_l, lo_r, hi_r = low, high, low, high
            if monotone[j] > 0:
                hi_l, lo_r = mid, mid
            elif monotone[j] < 0:
                lo_l, hi_r = mid, mid
            go = code[rows, j] <= i
            todo += [(left[k], rows[go], level + 1, lo_l, hi_l), (right[k], rows[~go], level + 1, lo_r, hi_r)]
    return Trees(np.array(roots), np.array(feat), np.array(thr), np.array(left), np.array(right), np.array(val),
                 depth, base)


def document_stats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, BASE counts, features array) of every row."""
    ready(df.sparkSession)

    def run(batches):
        for b in batches:
            both = [stats.measure(t) for t in texts(b.column(1))]
            cols = [b.column(0)] + [pa.array([x[0][i] for x in both], pa.int64()) for i in range(len(stats.BASE))]
            cols.append(pa.array([x[1] for x in both], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(cols, ["key", *stats.BASE, "features"])

    kinds = schema(("key", df.schema[key].dataType), ", ".join(f"{c} long" for c in stats.BASE) + ", features array<double>")
    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, kinds).withColumnRenamed("key", key)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "quality",
                    per_class: int = SAMPLE_PER_CLASS, only=None) -> DataFrame:
    """(doc_id, text, label) of at most ``per_class`` labelled documents a class, picked by a
    hash of the id; the ids (never more than twice ``per_class``) are broadcast.  Of rows that share
    an id one is taken, by a hash of the text, so the sample is as small as its ids are few."""
    one = (labels.select("doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
           .groupBy("doc_id").agg(F.max(label).alias(label)))
    if only is not None:
        one = one.where(only)
    picked = None
    for v in (0, 1):
        part = one.where(F.col(label) == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
                                      F.max(label).alias("label"))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Trees | None:
    """Trees fitted on the sample; the cut is set on cross-fitted scores (each quarter scored by trees fitted
    on the others): the highest one up to 0.5 that keeps ``KEEP_GOOD`` of the good documents, so that a few
    wrong labels do not set it."""
    sample = labelled_sample(docs, labels, per_class=per_class)
    rows = document_stats(sample.select(F.struct("doc_id", "label").alias("k"), "text"), "k").select(
        "k.doc_id", "k.label", "features").collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    if len({r[1] for r in rows}) < 2:
        return None
    x, y = np.array([r[2] for r in rows]), np.array([float(r[1]) for r in rows])
    monotone = np.array([-1 if f in NEVER_BETTER_WITH_MORE else 0 for f in stats.FEATURES])
    fold = np.arange(len(y)) % FOLDS
    trees = fit_trees(x, y, monotone)
    score = trees.score(x)
    if len(y) >= 10 * FOLDS and all(len(set(y[fold != k])) == 2 for k in range(FOLDS)):
        for k in range(FOLDS):
            score[fold == k] = fit_trees(x[fold != k], y[fold != k], monotone).score(x[fold == k])
    good = np.sort(score[y == 1])
    trees.cut = float(min(0.5, good[min(math.ceil((1 - KEEP_GOOD) * len(good)), len(good) - 1)]))
    return trees


def judge(stats_df: DataFrame, trees: Trees | None) -> DataFrame:
    """Add base_failed, score and kept to the output of ``document_stats``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    if trees is None:
        return stats_df.withColumn("base_failed", failed).withColumn("score", F.lit(None).cast("double")) \
            .withColumn("kept", ~F.col("base_failed")).drop("features")
    names = [f.name for f in stats_df.schema if f.name != "features"]
    kinds = T.StructType([f for f in stats_df.schema if f.name != "features"] + [T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            x = np.array(b.column("features").to_pylist(), dtype=float).reshape(-1, len(stats.FEATURES))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(trees.score(x))],
                                             [*names, "score"])

    return (stats_df.mapInArrow(run, kinds).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= trees.cut)))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the BASE counts, score, base_failed, kept: one row per document row."""
    return judge(document_stats(docs), fit(docs, labels))


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    The verdict depends on the text alone, so it is computed beside the row and no join is needed."""
    trees = fit(docs, labels)
    judged = judge(document_stats(docs.select(whole_row(docs), "text"), "row"), trees)
    return judged.where("kept").select("row.*")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", *stats.BASE, "base_failed", "kept", "score")
