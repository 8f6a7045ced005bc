"""The filter against n-grams too rare to be kept: it loses none that are kept, and little else moves."""

import random
import re
from collections import Counter

import pytest

from lexitrend.operators import grams as GR
from lexitrend.operators import terms as TM


def papers(spark, n=120):
    rng = random.Random(3)
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(14)] + ["the", "of", "ab"]
    rows = [(rng.choice([None, *range(n)]), rng.choice([2019, 2020, 2021, None]), rng.choice([["cs"], ["cs", "math"], ["math"], ["bio"], []]),
             " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(n)]
    rows += [(1000, 2018, ["cs"], "few papers in a year")] * 4
    return rows, spark.createDataFrame(rows, "id long, year int, domains array<string>, clean string").repartition(3)


def expected(rows, ns, min_df, min_docs=5):
    texts, docs, tf, df = {}, Counter(), Counter(), Counter()
    for i, year, domains, clean in rows:
        texts.setdefault((i, year, tuple(domains)), []).append(clean)
        docs.update((d, year) for d in domains)
    for (_, year, domains), some in texts.items():
        found = Counter()
        for t in some:
            w = [x for x in t.split() if len(x) > 2 and x != "the" and x != "few"]
            found.update((n, " ".join(w[j:j + n])) for n in ns for j in range(len(w) - n + 1))
        for (n, g), k in found.items():
            for d in domains:
                tf[d, year, n, g] += k
                df[d, year, n, g] += 1
    return {(*k, tf[k], df[k]) for k in tf if k[1] and docs[k[:2]] >= min_docs and df[k] >= min_df.get(k[2], 1)}


@pytest.mark.parametrize("fold, ns, min_df", [(1 << 28, (1, 2, 3), {1: 5, 2: 3, 3: 2}), (1 << 8, (1, 2, 3), {1: 2, 2: 2, 3: 1}),
                                              (1 << 12, (2, 4), {2: 3, 4: 1})])
def test_filter_loses_nothing(spark, monkeypatch, fold, ns, min_df):
    rows, clean = papers(spark)
    monkeypatch.setattr(GR, "FILTER_BITS", fold)
    monkeypatch.setattr(GR, "CHUNK", 500)
    monkeypatch.setattr(GR, "KEYS_AT_ONCE", 300)
    got = {tuple(r) for r in TM.term_year_counts(clean, ns, min_df, academic=[]).collect()}
    assert got == expected(rows, ns, min_df) and any(r[2] == ns[-1] for r in got)


def test_rare_terms_do_not_move(spark):
    rows = [(i, 2020, ["cs"], f"zebra quagga okapi {' '.join(chr(97 + i // 26) + chr(97 + i % 26) + 'x' * (j + 2) for j in range(40))}")
            for i in range(60)]
    clean = spark.createDataFrame(rows, "id long, year int, domains array<string>, clean string")
    seen, counts = [], TM.paper_terms

    def spied(*a):
        seen.append(counts(*a))
        return seen[0]

    TM.paper_terms = spied
    try:
        got = TM.term_year_counts(clean, min_df={1: 5, 2: 3, 3: 3})
    finally:
        TM.paper_terms = counts
    assert not seen[0].where("size(cells) <> 1").count()
    # each paper has 40 words, pairs and triples of its own, that no other paper has
    assert seen[0].count() < 60 * 3 and got.where("df = 60").count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan  # the text moves once


def test_terms_move_for_the_categories_that_may_keep_them(spark, monkeypatch):
    rows = [(i, 2020, ["cs", "math"] if i < 2 else [["cs"], ["math"]][i % 2], "zebra quagga" if i < 12 and i % 2 == 0 or i < 2 else "okapi") for i in range(40)]
    clean = spark.createDataFrame(rows, "id long, year int, domains array<string>, clean string")
    seen, counts = [], TM.paper_terms
    monkeypatch.setattr(TM, "paper_terms", lambda *a: seen.append(counts(*a)) or seen[0])
    got = {tuple(r) for r in TM.term_year_counts(clean, min_df={1: 3, 2: 3, 3: 3}).collect()}
    assert got == {("cs", 2020, 1, "zebra", 7, 7), ("cs", 2020, 1, "quagga", 7, 7), ("cs", 2020, 2, "zebra quagga", 7, 7),
                   ("cs", 2020, 1, "okapi", 14, 14), ("math", 2020, 1, "okapi", 19, 19)}
    assert {len(r.cells) for r in seen[0].where("term like 'z%'").collect()} == {1}


def test_far_buckets_and_repeats():
    batch = GR.pa.RecordBatch.from_pydict({"y": [2020] * 3, "d": [["cs"]] * 3, "t": ["one two", "one two", "one two three"]})
    batch = batch.set_column(0, "y", batch.column(0).cast("int32"))
    rooms = {2020: 32}
    rows = GR.pa.Table.from_batches(GR.sketches(iter([batch]), rooms, {1: 3}, {("cs", 2020)}, frozenset(), frozenset()))
    fold = GR.folded(rooms, [2020])
    assert fold == 5
    found = []
    for part in rows.group_by("slice").aggregate([])["slice"].to_pylist():
        mine = rows.filter(GR.pc.equal(rows["slice"], part))
        found += [tuple(r.values()) for r in GR.passing(mine, {1: 3}, fold).to_pylist()]
    kept = GR.gathered(found, rooms, fold)["cs", 2020, 1]
    assert kept.size * 8 == GR.FILTER_BITS
    bucket = GR.np.array([int(GR.gram_hashes(1, GR.np.array([0]), GR.word_hashes([w]))[0] >> 32) for w in ("one", "two", "three")])
    for x, at in zip(kept, GR.bits_of(bucket, fold), strict=True):
        assert [bool(x[b >> 3] >> (b & 7) & 1) for b in at] == [True, True, False]
        assert sum(int(b).bit_count() for b in x[x > 0]) == 2
