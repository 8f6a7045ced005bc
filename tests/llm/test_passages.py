import random

import pytest
from pyspark.sql import functions as F

from lexitrend.llm import passages as P
from lexitrend.llm import substring_dup as S

from .conftest import words


def brute(rows):
    """Whether a document has a LENGTH-word sequence that another row has too."""
    cut = [(t or "").split() for _, t in rows]
    at = {}
    for k, w in enumerate(cut):
        for s in range(len(w) - P.LENGTH + 1):
            at.setdefault(tuple(w[s:s + P.LENGTH]), set()).add(k)
    return sorted((str(rows[k][0]), any(len(at[tuple(w[s:s + P.LENGTH])]) > 1 for s in range(len(w) - P.LENGTH + 1)))
                  for k, w in enumerate(cut))


def found(df):
    return sorted((str(r.doc_id), r.shares_passage) for r in df.collect())


def corpus(seed=0):
    r = random.Random(seed)
    w = lambda n, k: words(n, k * 1000 + seed, 3)
    p51, p50, p60, base = w(51, 1), w(50, 2), w(60, 3), w(400, 4)
    join = lambda *parts: r.choice([" ", "\n", "  "]).join(x for part in parts for x in part)
    rows = [(k, join(w(30, 20 + k), p51, w(20, 50 + k))) for k in range(4)]
    rows += [(10, join(p50, w(60, 80))), (11, join(w(9, 81), p50))]  # too short to count
    rows += [(12, join(p60, w(5, 82))), (13, join(w(70, 83), p60[4:])), (14, join(p60[:55], w(70, 84), p60[5:]))]
    rows += [(20, join(base)), (21, join(base[:200], ["new"], base[200:])), (22, join(base[100:180], w(10, 85), base[20:75])),
             (23, join(base)), (23, join(base)), (None, join(base[:60]))]
    rows += [(30, join(w(60, 86) * 3)), (31, join(["a"] * 300)), (32, join(["a"] * 120 + ["b"])), (33, join(["c", "d"] * 100))]
    rows += [(40, None), (41, ""), (42, " \t\n"), (43, join(w(51, 87))), (44, "é字 " * 70), (45, "x" + "é字 " * 55)]
    # one text with a passage, the other texts hold longer and shorter parts of it
    rows += [(50 + k, join(w(8, 90 + k), base[300 - 3 * k:360 + 2 * k], w(8, 95 + k))) for k in range(5)]
    return rows


@pytest.mark.parametrize("seed,piece", [(0, 1 << 18), (1, 70), (2, 1 << 18)])
def test_equals_brute_force(docs, monkeypatch, seed, piece):
    monkeypatch.setattr(P, "PIECE", piece)
    rows = corpus(seed)
    assert found(S.substring_dedup(docs(rows, extra=True), with_passages=True)) == brute(rows)


def test_random_overlaps(docs):
    """Many documents cut from a few sources at any place, so that segments share some sequences and not others."""
    r = random.Random(11)
    source = [words(300, k, 2) for k in range(3)]
    rows = []
    for k in range(120):
        s, a = source[r.randrange(3)], r.randrange(230)
        rows.append((k, " ".join(words(r.randrange(30), 200 + k) + s[a:a + r.randrange(45, 70)] + words(r.randrange(30), 400 + k))))
    assert found(S.substring_dedup(docs(rows), with_passages=True)) == brute(rows)


def test_empty_table(docs):
    df = S.substring_dedup(docs([]), with_passages=True)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shares_passage"] and df.count() == 0


def test_one_row_on_a_third_of_all(docs):
    """Copies of one row move as one."""
    rows = [(1, " ".join(words(80, 5)))] * 200 + [(k, " ".join(words(90, k))) for k in range(10, 60)]
    df = S.substring_dedup(docs(rows), with_passages=True)
    assert found(df.where("doc_id = 1").select("doc_id", "shares_passage").distinct()) == [("1", True)]
    assert df.agg(F.count("*")).first()[0] == len(rows)
