import random

import numpy as np

from lexitrend.llm import near_dup as N

from .conftest import words


def shingles(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    """(n_shingles, component_id, kept) of each row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [j for m, (j, _) in enumerate(rows) if find(m) == find(k) and j is not None] if sets[k] else [i]
        comp = min((j for j in ids if j is not None), default=None)
        out.append((str(i), len(sets[k]), comp, i == comp))
    return sorted(out, key=str)


def edited(ws, n, r):
    ws = list(ws)
    for k in r.sample(range(len(ws)), n):
        ws[k] = f"new{r.random()}"
    return ws


def corpus():
    r = random.Random(5)
    rows = []
    for g in range(6):
        base = words(120, g)
        rows += [(0, " ".join(edited(base, r.randint(0, 9), r))) for _ in range(25)]
    rows += [(0, " ".join(words(80, 50 + k))) for k in range(40)]
    rows = [(1000 - k, t) for k, (_, t) in enumerate(rows)]
    a = words(60, 90)
    rows += [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, "one two three"), (7, "one two"),
             (8, " ".join(a)), (8, " ".join(a)), (9, "\x0b".join(a).upper()), (None, " ".join(a)), (None, "alone here"), (None, " ".join(edited(a, 1, r))),
             (None, None), (10, "é É " * 4), (11, "É é " * 4), (12, " ".join(words(30_000, 91))), (12, "other text of the same id")]
    return rows


def test_components_against_all_pairs(docs, monkeypatch):
    monkeypatch.setattr(N, "SMALL", 4)  # both ways of resolving keys are taken
    rows = corpus()
    got = N.near_duplicates(docs(rows, extra=True)).collect()
    assert sorted(((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in got), key=str) == sorted(
        ((i, n, c, k if i != "None" else c is None) for i, n, c, k in brute(rows)), key=str)


def test_prefixes_find_every_link_of_large_keys(docs, monkeypatch):
    """With each class a component of its own, the prefix filter alone must find all links."""
    monkeypatch.setattr(N, "SMALL", 2)
    r = random.Random(8)
    base = words(100, 1)
    rows = [(k, " ".join(edited(base, 4, r))) for k in range(30)]
    sets = N.sketches(docs(rows))
    classes = N.classes_of(sets)
    met = N.shared_keys(classes)
    _, many = N.unresolved(met, classes.select("c", N.F.col("c").alias("root")))
    found = N.prefix_pairs(many, N.class_sets(docs(rows), classes))
    by = {x.c: x.doc_id for x in classes.collect()}
    pairs = {tuple(sorted((by[x.a], by[x.b]))) for x in found.collect()}
    texts = dict(rows)
    for a in range(30):
        for b in range(a):
            x, y = shingles(texts[a]), shingles(texts[b])
            assert 100 * len(x & y) < 75 * len(x | y) or (b, a) in pairs


def test_one_of_each_keeps_columns(docs):
    rows = corpus()
    left = N.one_of_each(docs(rows, extra=True))
    assert left.columns == docs(rows, extra=True).columns
    want = {(i, t) for (i, t) in rows if any(str(i) == b[0] and (b[3] or (i is None and b[2] is None)) for b in brute(rows)
                                             if b[1] == len(shingles(t)))}
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted((str(i), str(t)) for i, t in want)
    assert N.one_of_each(docs([])).count() == 0


def test_shingles_do_not_depend_on_the_batch():
    batch = [" ".join(words(50, k)).encode() for k in range(5)] + [b"", b"a b"]
    together = N.shingle_sets(batch)
    for b, s in zip(batch, together, strict=True):
        assert np.array_equal(N.shingle_sets([b])[0], s) and len(s) == len(shingles(b.decode()))


def test_one_of_each_with_null_and_shared_ids(docs):
    r = random.Random(4)
    a, b = words(100, 60), words(100, 61)
    nulls = [(None, " ".join(edited(a, 1, r))) for _ in range(5)]
    shared = [(5, " ".join(edited(b, 1, r))) for _ in range(3)] + [(6, " ".join(b))]
    empty = [(None, ""), (None, None), (None, ""), (7, " "), (7, " ")]
    got = [(x.doc_id, x.text) for x in N.one_of_each(docs(nulls + shared + empty)).collect()]
    assert sum(x in nulls for x in got) == 1 and sum(x in shared for x in got) == 1
    assert [i for i, t in got if (i, t) in shared] == [5]
    assert sorted(map(str, (x for x in got if not (x[1] or "").strip()))) == sorted(map(str, empty))
