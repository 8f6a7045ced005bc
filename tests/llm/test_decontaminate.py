import math
import random

from lexitrend.llm import decontaminate as D

from .conftest import words

VOCAB = words(400, 3)


def text(n, seed):
    r = random.Random(seed)
    return [r.choice(VOCAB) for _ in range(n)]


ITEMS = [(k, " ".join(text(20 + k, 100 + k)) + ". " + " ".join(text(6, 200 + k)) + ".") for k in range(12)]


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score double")


def test_search_retrieves_all_above_threshold():
    index = D.Index([D.item_of(i, t) for i, t in ITEMS])
    texts = [text(n, n) for n in (0, 3, 64, 65, 500, 2000)]
    texts = [[w.encode() for w in t] for t in texts]
    texts[4][100:100] = D.words_of(ITEMS[3][1])
    got = {(k, at, i): s for k, at, i, s in index.search(texts)}
    s = index.stride
    want = {}
    for k, ws in enumerate(texts):
        for at in range(-s, len(ws), s):
            ts = {index.terms[w] for w in ws[max(at, 0):at + 2 * s] if w in index.terms}
            for i in range(len(index.items)):
                score = sum(index.impact[p] for t in ts for p in index.posts[t] if index.item[p] == i)
                if score >= 1 - 1e-9:
                    want[k, at, i] = score
    assert {x for x in got} == set(want) and all(abs(got[x] - want[x]) < 1e-9 for x in want) and want


def test_leaks_and_edge_cases(spark, docs):
    rows = [(k, " ".join([*text(300, k), *([ITEMS[k][1].upper()] if k < 6 else []), *text(90, k + 50)])) for k in range(10)]
    rows += [(20, None), (21, ""), (22, ITEMS[7][1]), (22, ITEMS[7][1]), (None, ITEMS[8][1]),
             (30, " ".join(text(30_000, 9)) + " " + ITEMS[9][1])]
    items = [(i, t, 0.0) for i, t in ITEMS] + [(3, ITEMS[3][1], 0.0), (99, None, 0.0), (98, "", 0.0), (None, "?!", 0.0)]
    got = sorted((str(r.doc_id), r.item_id) for r in D.find_leaks(docs(rows, extra=True), bench(spark, items)).collect())
    assert got == sorted([(str(k), k) for k in range(6)] + [("22", 7), ("22", 7), ("None", 8), ("30", 9)])
    kept = D.without_leaks(docs(rows, extra=True), bench(spark, items)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(["6", "7", "8", "9", "20", "21"]) and kept[0]["a.b c"] == "x"
    assert D.find_leaks(docs([]), bench(spark, items)).count() == 0
    assert D.find_leaks(docs(rows), bench(spark, [])).count() == 0
    assert D.without_leaks(docs(rows), bench(spark, [])).count() == len(rows)


def test_question_without_answer_is_no_leak(spark, docs):
    i, t = ITEMS[4]
    question = t.split(". ")[0]
    assert D.find_leaks(docs([(1, question + ". " + " ".join(text(200, 77)))]), bench(spark, [(i, t, 0.0)])).count() == 0


def test_shards_cover_all_items(spark, docs, monkeypatch):
    monkeypatch.setattr(D, "SHARD_ITEMS", 2)
    items = bench(spark, [(i, t, 0.0) for i, t in ITEMS])
    passes = list(D.index_passes(items))
    assert len(passes) > 1 and all(len(p) <= D.SHARDS_A_PASS for p in passes)
    assert sorted(x.item_id for p in passes for s in p for x in s.items) == sorted(i for i, _ in ITEMS)
    assert D.find_leaks(docs([(i, t) for i, t in ITEMS]), items).count() == len(ITEMS)
    assert D.without_leaks(docs([(i, t) for i, t in ITEMS] + [(500, "nothing of it")]), items).collect()[0].doc_id == 500


def test_string_item_ids(spark, docs):
    items = spark.createDataFrame([(f"item-{i}", t) for i, t in ITEMS], "item_id string, text string")
    got = D.find_leaks(docs([(i, t) for i, t in ITEMS]), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((i, f"item-{i}") for i, _ in ITEMS)


def bm25(items, passage):
    """Scores of all items for a passage's distinct words, by the formula, as shares of the items' own."""
    words = [D.words_of(t) for _, t in items]
    n, mean = len(words), sum(map(len, words)) / len(words)
    df = {w: sum(w in x for x in words) for x in words for w in x}

    def score(x, held):
        return sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * x.count(w) * (D.K1 + 1)
                   / (x.count(w) + D.K1 * (1 - D.B + D.B * len(x) / mean)) for w in set(x) if w in held)
    return [score(x, passage) / score(x, set(x)) for x in words]


def test_search_against_brute_force(spark, docs):
    """Every passage of two strides against every item: what is retrieved, its score and both overlaps."""
    r = random.Random(31)
    rows = [(k, " ".join([*text(60, 900 + k), *[w if r.random() > 0.1 else "x" for w in t.split()], *text(70, 950 + k)]))
            for k, (_, t) in enumerate(ITEMS)] + [(80 + k, " ".join(text(400, 990 + k))) for k in range(3)]
    want = {}
    for doc, t in rows:
        words = D.words_of(t)
        for i, (item_id, it) in enumerate(ITEMS):
            x = D.item_of(item_id, it)
            s = D.stride_of(len(x.words))
            for at in range(-s, len(words), s):
                passage = words[max(at, 0):max(at + 2 * s, 0)]
                share = bm25(ITEMS, set(passage))[i]
                if share >= D.TAU - 1e-12:
                    q = [sum(g in D.sequences(passage, len(g)) for g in part) / len(part) for part in (x.question, x.answer)]
                    if q[0] >= D.QUESTION and q[1] >= D.ANSWER:
                        want[doc, item_id] = max(want.get((doc, item_id), (0, 0, 0)), (round(share, 6), round(q[0], 6), round(q[1], 6)))
    got = {(x.doc_id, x.item_id): (round(x.score, 6), round(x.question_overlap, 6), round(x.answer_overlap, 6))
           for x in D.find_leaks(docs(rows), bench(spark, [(i, t, 0.0) for i, t in ITEMS])).collect()}
    assert set(got) == set(want) and len(want) >= len(ITEMS) // 2
    assert all(abs(a - b) < 1e-5 for k in want for a, b in zip(got[k], want[k], strict=True))


def test_shards_make_no_difference(spark, docs, monkeypatch):
    long = (50, " ".join(text(900, 400)) + ". " + " ".join(text(9, 401)) + ".", 0.0)
    items = [(i, t, 0.0) for i, t in ITEMS] + [long]
    r = random.Random(6)
    rows = [(k, " ".join([*text(200, 500 + k), *[w if r.random() > 0.12 else "other" for w in t.split()], *text(200, 600 + k)]))
            for k, (_, t, _) in enumerate(items)]
    spread = ITEMS[2][1].split()
    # an item's sequences scattered over a span that only the long item needs are no leak of it
    rows += [(90, " ".join(w for k in range(0, len(spread), 5) for w in [*spread[k:k + 5], *text(150, 700 + k)]))]
    found = []
    for n in (4096, 5, 1):
        monkeypatch.setattr(D, "SHARD_ITEMS", n)
        got = D.find_leaks(docs(rows), bench(spark, items)).collect()
        found.append(sorted((x.doc_id, x.item_id, round(x.score, 9)) for x in got))
        assert not any(x.doc_id == 90 for x in got)
    assert found[0] == found[1] == found[2] and len(found[0]) >= 6


def test_words_of_other_scripts_and_punctuation(spark, docs):
    chinese = "光合作用是植物把阳光转化为化学能的过程其中叶绿素起着关键作用。它主要发生在叶绿体里面。"
    latin = "which “long river” flows through the quiet northern valley—and past eleven old mills. it is the winding silver stream."
    plain = "which long river flows through the quiet northern valley and past eleven old mills it is the winding silver stream"
    others = [(k, t, 0.0) for k, t in ITEMS]
    items = [(100, chinese, 0.0), (101, latin, 0.0), *others]
    rows = [(1, "今天我们在课堂上学习了" + chinese.replace("。", "，") + "然后大家一起回家"), (2, " ".join(text(80, 1)) + " " + plain),
            (3, "今天天气很好，我们一起去公园散步，然后回家吃饭。"), (4, " ".join(text(200, 2)))]
    got = sorted((r.doc_id, r.item_id) for r in D.find_leaks(docs(rows), bench(spark, items)).collect())
    assert got == [(1, 100), (2, 101)]
    assert D.words_of("a—b “c” d、é") == [b"a", b"b", b"c", b"d", "é".encode()]
