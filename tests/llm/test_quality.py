import math
import re
import zlib

import numpy as np

from lexitrend.llm import quality_classifier as Q
from lexitrend.llm import quality_rules as R
from lexitrend.llm import stats

from .conftest import words


def brute(t):
    b = (t or "").encode()
    w = [x for x in re.split(rb"[\x20\x09-\x0D]+", b) if x]
    at = {}
    for k in range(len(w) - 7):
        at.setdefault(tuple(w[k:k + 8]), []).append(k)
    covered = {i for v in at.values() if len(v) > 1 for k in v for i in range(k, k + 8)}
    seen, dup = set(), 0
    for line in b.split(b"\n"):
        if re.search(rb"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(len(x.decode()) for x in w), sum(b.count(c.encode()) for c in "#*$%&|<>"), dup, len(covered)]


W30 = " ".join(words(30))
TEXTS = [None, "", " \n\t", "a" * 300_000, W30, f"{W30} {W30}", f"{W30}\n{W30}\nx\n \nx\n\n", "a b c d e f g h a b c d e f g h",
         "a " * 500, "é ü\x1c x\x85y # * $%&|<>", " ".join(words(20_000, 2)), "x\r\ny\r\ny\r\n"]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def good(k):
    return " ".join(words(60, k)) + "."


def bad(k):
    return "*** ".join(words(60, k)) + " !! | | #"


def test_counts_against_brute_force(docs):
    rows = list(enumerate(TEXTS)) + [(4, W30), (None, W30)]
    got = R.document_stats(docs(rows, extra=True)).collect()
    assert sorted((str(r.doc_id), [r[c] for c in stats.BASE]) for r in got) == sorted((str(i), brute(t)) for i, t in rows)


def test_rules_keep_good_documents(spark, docs):
    rows = [(k, good(k) if k % 2 else bad(k)) for k in range(400)] + [(1000, "few words"), (1001, None), (1, good(1))]
    some = labels(spark, [(k, k % 2, 0) for k in range(200)] + [(3, 1, 1), (None, 1, 0), (5, None, 0)])
    got = R.quality_rules(docs(rows, extra=True), some).collect()
    lost = [r.doc_id for r in got if r.doc_id < 400 and r.doc_id % 2 and not r.kept]
    assert not [k for k in lost if k < 200] and len(lost) <= 2  # of the 100 good ones without a label
    assert not [r for r in got if r.kept and (r.doc_id >= 1000 or r.doc_id % 2 == 0)]
    assert all(r.base_failed == (r.doc_id >= 1000) for r in got)
    left = R.quality_filter(docs(rows, extra=True), some)
    assert left.columns == docs(rows, extra=True).columns and left.count() == 201 - len(lost)
    assert R.quality_rules(docs([]), some).count() == 0
    none = R.quality_rules(docs(rows), labels(spark, [])).collect()
    assert all(r.kept != r.base_failed and r.score is None for r in none)


def test_trees_obey_constraints_and_flat_arrays():
    rng = np.random.default_rng(0)
    x = rng.random((800, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(800) < 0.1)).astype(float)
    trees = R.fit_trees(x, y, np.array([-1, 0, 0]))
    grid = np.repeat(rng.random((50, 1, 3)), 40, axis=1)
    grid[:, :, 0] = np.linspace(0, 1, 40)
    assert (np.diff(trees.score(grid.reshape(-1, 3)).reshape(50, 40), axis=1) <= 1e-12).all()
    assert ((trees.score(x) >= 0.5) == (y == 1)).mean() > 0.85

    def walk(row):  # node by node
        total = trees.base
        for k in trees.roots:
            while trees.left[k] != k:
                k = trees.left[k] if row[trees.feature[k]] <= trees.threshold[k] else trees.right[k]
            total += trees.value[k]
        return 1 / (1 + np.exp(-total))
    assert np.allclose(trees.score(x[:50]), [walk(r) for r in x[:50]])


def test_ranking_on_held_out_rows(spark, docs):
    rows = [(k, good(k) if k % 3 else bad(k)) for k in range(600)] + [(7000, None), (None, good(3)), (1, good(1))]
    flipped = [(k, int(bool(k % 3)) if zlib.crc32(str(k).encode()) % 4 != 2 else int(not k % 3), 0) for k in range(600)]
    df = docs(rows, extra=True)
    got = Q.score_documents(df, Q.fit(df, labels(spark, flipped))).collect()  # held-out labels are wrong: never learnt
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id < 600:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert r.predicted == int(bool(r.doc_id % 3)) == int(r.score >= 0.7) and 0 <= r.score <= 1
    assert Q.score_documents(docs([]), Q.fit(docs([]), labels(spark, []))).count() == 0
    assert {r.score for r in Q.score_documents(docs(rows), None).collect()} == {0.7}


def test_one_id_on_a_third_of_all_rows(spark, docs):
    """The sample that reaches the driver has one row for each id."""
    rows = [(k, good(k) if k % 2 else bad(k)) for k in range(200)] + [(7, good(k)) for k in range(1000, 1100)]
    some = labels(spark, [(k, k % 2, 0) for k in range(200)])
    got = R.labelled_sample(docs(rows), some).collect()
    assert len(got) == 200 and len({r.doc_id for r in got}) == 200
    assert sorted(r.doc_id for r in got if r.label == 1) == list(range(1, 200, 2))
    assert R.labelled_sample(docs(rows * 2), some).where("doc_id = 7").first().text == [r for r in got if r.doc_id == 7][0].text


def test_a_few_wrong_labels_do_not_set_the_cut(spark, docs):
    """Of the labels one in a hundred is turned round: bad documents still go, good ones stay."""
    rows = [(k, good(k) if k % 2 else bad(k)) for k in range(1200)]
    turned = {k for k in range(1200) if k % 100 < 1}
    some = labels(spark, [(k, (k % 2) ^ (k in turned), 0) for k in range(1200)])
    got = {r.doc_id: r.kept for r in R.quality_rules(docs(rows), some).collect()}
    assert sum(got[k] for k in range(0, 1200, 2)) <= 6
    assert sum(got[k] for k in range(1, 1200, 2)) >= 590


def test_classifier_against_brute_force(spark, docs):
    """Scores of whole documents from the fitted weights, by hand; labels held out are never read."""
    rows = [(k, good(k) if k % 2 else bad(k)) for k in range(300)] + [(900, None), (901, ""), (1, good(1))]
    pick = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    some = labels(spark, [(k, k % 2, 0) for k in range(300)])
    turned = labels(spark, [(k, 1 - k % 2 if pick(k) else k % 2, 0) for k in range(300)])
    model = Q.fit(docs(rows), some)
    again = Q.fit(docs(rows), turned)
    assert np.array_equal(model.weights, again.weights) or np.allclose(model.weights, again.weights)
    for r in Q.score_documents(docs(rows), model).collect():
        t = dict(rows)[r.doc_id]
        x = np.array(stats.measure((t or "").encode())[1])
        f = np.concatenate([x, np.sqrt(np.maximum(x, 0)), x > 0, np.minimum(x, 1) ** 2])
        z = np.clip((f - model.mean) / model.spread, -8, 8) @ model.weights
        z = np.clip((z - model.cut) / model.scale, -30, 30) + math.log(Q.CUT / (1 - Q.CUT))
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
        assert r.held_out == pick(r.doc_id) and r.predicted == (r.score >= Q.CUT)
