"""Quality classifier: Bradley-Terry ranking from preference pairs.

A pair prefers a document labelled good to one labelled bad; the weights minimise the
logistic loss on feature differences.  The raw score is cut at the quantile that leaves
the labelled share of bad documents below it, and mapped to 0..1 so that the cut is at 0.7.

Defined results: null or empty texts are scored as texts without words; repeated rows are
scored one by one; extra columns are not read; an empty table gives an empty result;
without labels of both classes every score is 0.7.  Labels, lang, source and doc_id are
never inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import stats
from .common import ready, schema, texts
from .quality_rules import document_stats, labelled_sample

#: Labelled rows of either class, and preference pairs, that a model is fitted on, at most.
SAMPLE_PER_CLASS = 4000
PAIRS = 20_000
CUT = 0.7


def held_out() -> F.Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def expand(x: np.ndarray) -> np.ndarray:
    """Ratios, their square roots and indicators of any occurrence: a linear score can then bend."""
    root = np.sqrt(np.maximum(x, 0))
    return np.concatenate([x, root, (x > 0).astype(float), np.minimum(x, 1) ** 2], axis=1)


@dataclass
class Ranker:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    scale: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((expand(x) - self.mean) / self.spread, -8, 8)
        return z @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((self.raw(x) - self.cut) / self.scale, -30, 30)
        return 1 / (1 + np.exp(-(z + np.log(CUT / (1 - CUT)))))


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3,
              steps: int = 25) -> Ranker:
    """Newton steps on the mean logistic loss over pairs (good i, bad j)."""
    both = expand(np.concatenate([good, bad]))
    model = Ranker(both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6), np.zeros(both.shape[1]))
    z = np.clip((both - model.mean) / model.spread, -8, 8)
    rng = np.random.default_rng(0)
    i = rng.integers(0, len(good), pairs)
    j = rng.integers(0, len(bad), pairs)
    d = z[i] - z[len(good) + j]
    w = model.weights
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (p - 1) / pairs + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Ranker | None:
    """Weights from a bounded sample of the labelled rows that are not held out; the cut is the
    score quantile at the share of bad rows among all of those labels."""
    learnable = ~held_out()
    share = labels.where(learnable & F.col("quality").isin(0, 1)).agg(F.avg(1.0 - F.col("quality"))).first()[0]
    sample = labelled_sample(docs, labels, per_class=per_class, only=learnable)
    rows = document_stats(sample.select(F.struct("doc_id", "label").alias("k"), "text"), "k").select(
        "k.doc_id", "k.label", "features").collect()
    rows.sort(key=lambda r: (r[0], r[1], r[2]))
    x, y = np.array([r[2] for r in rows]), np.array([r[1] for r in rows])
    if len(set(y.tolist())) < 2:
        return None
    model = fit_pairs(x[y == 1], x[y == 0])
    raw = model.raw(x)
    weight = np.where(y == 1, (1 - share) / max((y == 1).sum(), 1), share / max((y == 0).sum(), 1))
    order = np.argsort(raw)
    at = min(int(np.searchsorted(np.cumsum(weight[order]), share - 1e-9)), len(raw) - 2)
    model.cut = float((raw[order][at] + raw[order][at + 1]) / 2)
    model.scale = float(max(np.median(np.abs(raw - model.cut)) / 3, 1e-6))
    return model


def score_documents(docs: DataFrame, model: Ranker | None) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document row."""
    ready(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = np.array([stats.measure(t)[1] for t in texts(b.column(1))]).reshape(-1, len(stats.FEATURES))
            s = model.score(x) if model is not None else np.full(len(x), CUT)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    out = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, schema(("doc_id", docs.schema["doc_id"].dataType), "score double"))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= CUT).cast("int").alias("predicted"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
