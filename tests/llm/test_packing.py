import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from lexitrend.llm import packing

from .conftest import words


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.CLOSING_ID]


def holds(rows, docs, tokenizer, window):
    """Every id of every document in exactly one piece, sequences gapless, and their fills."""
    left = defaultdict(list)
    for k, t in docs:
        left[k].append(ids_of(tokenizer, t))
    pieces, fills = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        fills[r["sequence_id"]].append((r["offset"], r["length"]))
    for k, all_ids in left.items():
        spans = sorted((r["start"], r["length"]) for r in pieces[k])
        if len(all_ids) == 1:
            ids, at = all_ids[0], 0
            for start, n in spans:
                assert start == at and n > 0
                at += n
            assert at == len(ids)
            for r in pieces[k]:
                assert r["doc_tokens"] == len(ids)
                part = np.array(ids[r["start"]:r["start"] + r["length"]], dtype="<u4")
                assert r["ids_crc32"] == zlib.crc32(part.tobytes())
        else:
            assert sum(n for _, n in spans) == sum(map(len, all_ids))
    assert set(pieces) == set(left)
    out = []
    for spans in fills.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= window
        out.append(at)
    return out


def best_level(counts, size, window):
    """Sum of squares by its definition, level by level."""
    def total(c):
        return sum(n * n for h, n in c.items() if 0 < h < window)
    found = []
    for h in [0, *[h for h, n in counts.items() if n and h + size <= window]]:
        c = defaultdict(int, counts)
        c[h] -= 1
        c[h + size] += 1
        found.append((total({k: v for k, v in c.items() if k}), -h))
    return -min(found)[1]


def test_levels_follow_the_sum_of_squares():
    r = np.random.default_rng(3)
    p, counts, window = packing.Packer(32, open_most=10 ** 6), defaultdict(int), 32
    for k in range(600):
        size = int(r.integers(1, 32))
        want = best_level(counts, size, window)
        assert p.level_for(size) == want
        p.add((k, size), np.zeros(size, "<u4"))
        counts[want] -= want > 0
        counts[want + size] += want + size < window
    assert {h: n for h, n in counts.items() if n} == {h: int(n) for h, n in enumerate(p.counts) if n}


@pytest.mark.parametrize("open_most", [2, 1000])
def test_pieces_cover_documents(spark, docs, tokenizer, open_most):
    rows = [(k, " ".join(words(1 + k * 7 % 90, k))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, "x" * 5000), (203, " \n\t"), (204, "É ́a. don't 12　字<|endoftext|>z")]
    got = packing.pack(docs(rows, extra=True), window=64, open_most=open_most, with_ids=True).collect()
    fills = holds(got, rows, tokenizer, 64)
    assert all(n == 64 or n & (n - 1) == 0 for n in fills)  # no padding at all
    assert sum(n < 64 for n in fills) <= 7 * 4  # of each of four tasks one window is dealt out
    assert all(len(r["ids"]) == r["length"] for r in got)


def test_repeated_rows_and_null_ids(docs, tokenizer):
    rows = [(1, "a b c"), (1, "a b c"), (1, "other"), (None, "p q"), (None, None)]
    got = packing.pack(docs(rows)).collect()
    holds(got, rows, tokenizer, packing.WINDOW)
    assert sum(r["start"] == 0 for r in got) >= len(rows)


def test_empty_table(docs):
    df = packing.pack(docs([]))
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert df.count() == 0


def test_long_texts_and_small_cache(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CALL_BYTES", 40)
    monkeypatch.setattr(packing, "CACHE", 20)
    monkeypatch.setattr(packing, "LONGEST", 4)
    parts = [" ".join(words(n, n)) for n in (0, 1, 300, 2, 0, 50)] + ["y" * 300]
    e = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    got = list(e.encode_all([p.encode() for p in parts]))
    assert [k for k, _ in got] == list(range(len(parts)))
    for (_, ids), p in zip(got, parts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() + [2] == ids_of(tokenizer, p)
    assert len(e.runs) <= 400 and len(e.words) <= 400


def test_plain_and_other_texts_are_encoded_alike(tokenizer):
    """Words cut here, runs of other texts, and whole texts: the tokenizer's own ids."""
    import random
    r = random.Random(7)
    plain = [chr(c) for c in range(128)] + list("ÀÉÖØÞßàéöøÿ–—‘’“”…") + ["'s", "'LL", "I'd ", "<|x|>"] + words(40, 1)
    other = plain + list("Σςİıǅﬁ́̈²¼ªµ×÷字カ한🙂\u00a0\u0085\u2003\u200b\x1c") + ["<|endoftext|>", "<|startoftext|>", "e\u0301"]
    texts = ["".join(r.choice(pool) + r.choice(["", "", " "]) for _ in range(r.randint(0, 60)))
             for pool in (plain, other) for _ in range(1500)]
    e = packing.Encoder(public_tokenizers.path(packing.VOCABULARY))
    assert e.known and 0 < sum(bool(re.search(packing.OTHER, t)) for t in texts) < len(texts)
    for (k, ids), t in zip(e.encode_all([t.encode() for t in texts]), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() + [2] == ids_of(tokenizer, t), repr(t)


def test_vocabulary_of_another_kind(docs):
    """Its tokenizer gets whole texts."""
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    rows = [(1, "Some  text\nof 12 words"), (2, "é字"), (3, None)]
    got = packing.pack(docs(rows), vocabulary=path, with_ids=True).collect()
    for k, text in rows:
        ids = [i for p in sorted((p for p in got if p["doc_id"] == k), key=lambda p: p["start"]) for i in p["ids"]]
        assert ids == t.encode(text or "", add_special_tokens=False).ids + [2]


def test_whole_table(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = packing.op11(spark, "/root/testdata/sf0.001").collect()
    fills = holds(got, rows, tokenizer, packing.WINDOW)
    assert all(n & (n - 1) == 0 for n in fills)
    ids = {r["sequence_id"] for r in packing.pack(df.repartition(3)).coalesce(1).collect()}
    assert len({i >> packing.LOCAL_BITS for i in ids}) == 3  # unique however the tasks are run later
