import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexitrend.llm import importance_resampling as I

from .conftest import words

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs_of(text, runs=(1, 1)):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return [" ".join(w[i:i + n]) for n in range(runs[0], runs[1] + 1) for i in range(len(w) - n + 1)], len(w)


def bucket(feature, n):
    return zlib.crc32(feature.encode()) % n


def brute(rows, target, buckets=10_000, runs=(1, 1), least=20, percent=10, seed=2024):
    """(doc_id, n_features, weight, score, rank), rows in their order."""
    found = [runs_of(t, runs) for _, t in rows]
    s = Counter(bucket(f, buckets) for fs, _ in found for f in fs)
    t = Counter(bucket(f, buckets) for x in target for f in runs_of(x, runs)[0])
    S, T = s.total(), t.total()
    out = []
    for k, ((doc, _), (fs, n)) in enumerate(zip(rows, found, strict=True)):
        g = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets))))
             for b in (bucket(f, buckets) for f in fs)]
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(g) // len(g) if g else 0
        out.append([doc, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n, k])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    rank = {r[5]: i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted([(*r[:4], rank.get(r[5])) for r in out], key=str)


def got(df):
    return sorted([tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in df.collect()], key=str)


def texts_of(n, seed=0):
    return [" ".join(words(5 + (k * 13) % 60, seed + k % 17, 3)) for k in range(n)]


@pytest.mark.parametrize("runs,buckets", [((1, 1), 10_000), ((1, 3), 64), ((2, 2), 1000)])
def test_equals_brute_force(docs, monkeypatch, runs, buckets):
    monkeypatch.setattr(I, "CACHE", 50)
    rows = [(k, t) for k, t in enumerate(texts_of(150))]
    rows += [(900, None), (901, ""), (902, " ,;\n"), (903, "ÀÉ Ab9 字_x " * 30), (904, "w " * 3000)]
    target = texts_of(20, 5) + [None, ""]
    frame = docs([(0, t) for t in target])
    df = I.resample(docs(rows, extra=True), frame, runs=runs, buckets=buckets, percent=30)
    assert got(df) == brute(rows, target, buckets, runs, percent=30)


def test_words_across_blocks(docs, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 10)
    rows = [(k, t) for k, t in enumerate(texts_of(40))] + [(90, "y" * 100 + " z")]
    for runs in ((1, 1), (1, 3), (3, 4)):
        df = I.resample(docs(rows), docs(rows[:3]), runs=runs)
        assert got(df) == brute(rows, [t for _, t in rows[:3]], runs=runs)


def test_ties_repeats_and_null_ids(docs):
    same = " ".join(words(25))
    rows = [(k % 7, same) for k in range(60)] + [(None, same)] * 5 + [(3, "other " * 30)] * 4
    for percent in (0, 7, 50, 93, 100):
        df = I.resample(docs(rows).coalesce(1), docs(rows[:1]), percent=percent)
        assert got(df) == brute(rows, [same], percent=percent)


def test_draw_cuts_at_any_place(spark):
    """Every k over rows with few scores and few places takes exactly the first k rows."""
    rows = [(n, n * 7 % 3, None if n % 5 == 0 else n * 11 % 4 - 2) for n in range(40)]
    df = spark.createDataFrame(rows, "number long, score long, place long")
    best = sorted(rows, key=lambda r: (-r[1], r[2] is None, r[2] or 0, r[0]))
    for k in (1, 2, 13, 14, 27, 39, 40):
        assert {r["number"] for r in df.where(I.draw(df, k, F.lit(True))).collect()} == {r[0] for r in best[:k]}


def test_empty_tables(docs):
    empty = docs([])
    assert I.resample(empty, empty).collect() == []
    rows = [(k, t) for k, t in enumerate(texts_of(30))]
    assert got(I.resample(docs(rows), empty)) == brute(rows, [])


def test_string_keys(spark):
    df = spark.createDataFrame([(f"d{k}", t) for k, t in enumerate(texts_of(60))], "doc_id string, text string")
    ranks = sorted(r["rank"] for r in I.resample(df, df, percent=50).collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
