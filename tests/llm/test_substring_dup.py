import hashlib
import random

import numpy as np
import pytest

from lexitrend.llm import substring_dup as S


def letters(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("abcdefgh \n") for _ in range(n))


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    at = {}
    for k, b in enumerate(texts):
        for s in range(len(b) - 399):
            at.setdefault(b[s:s + 400], []).append((k, s))
    gone = [np.zeros(len(b) + 1, dtype=bool) for b in texts]
    for places in at.values():
        if len(places) > 1:
            for k, s in places:
                gone[k][s:s + 400] = True
    out = []
    for (i, _), b, g in zip(rows, texts, gone, strict=True):
        kept = bytes(c for c, x in zip(b, g, strict=False) if not x)
        spans = int((np.diff(np.r_[False, g].astype(int)) == 1).sum())
        out.append((str(i), len(b), int(g.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    p, q, long = letters(600, 1), letters(401, 2), letters(1500, 3)
    rows = [(k, letters(300, 10 + k) + p + letters(200, 40 + k)) for k in range(8)]
    rows += [(20, letters(500, 60) + q), (21, q + letters(30, 61)), (22, q[1:]), (23, q[:399]), (24, "x" * 399),
             (25, "x" * 900), (26, letters(100, 62) + "ab" * 700 + letters(100, 63)), (27, "ab" * 230), (28, None), (29, ""),
             (30, long), (31, long), (31, long), (None, long), (32, long[:700] + "#" + long[701:]), (33, "é" * 500),
             (34, letters(50, 64) + long[200:800] + letters(50, 65) + long[100:600]), (35, "\0\1" * 300 + "\0" * 500),
             (36, p), (37, letters(9000, 66) + "cd" * 3000)]
    return rows


@pytest.mark.parametrize("most,extra", [(256, False), (2, True)])
def test_removal_against_brute_force(docs, monkeypatch, most, extra):
    monkeypatch.setattr(S, "MOST", most)
    monkeypatch.setattr(S, "BLOCK", 3000)
    got = S.substring_dedup(docs(corpus(), extra=extra), with_text=True).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(corpus())
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_empty_table(docs):
    assert S.substring_dedup(docs([])).count() == 0


def test_index_matching_statistics():
    parts = [letters(60, k).encode() + b"shared passage" * 3 for k in range(6)] + [b"aaaaaaaa", b"aaa", b""]
    index = S.RunLengthIndex(parts)
    text = [(k, s) for k, p in enumerate(parts) for s in range(len(p) + 1)]

    def match(x, y):
        a, b = parts[x[0]][x[1]:], parts[y[0]][y[1]:]
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n
    want = [max(match(x, y) for y in text if y != x) for x in text]
    assert index.matching_statistics().tolist() == want
    assert len(index.head_at) < index.n


def test_pieces_of_long_texts(monkeypatch):
    t = letters(5000, 5).encode()
    monkeypatch.setattr(S, "PIECE", 700)
    starts = sorted(int(a) + k for text, count, _, _, lo, at in S.segments([t, b"short", t], 128)
                    for i, n, x, y in zip(text, count, at, at[1:], strict=False) if i == 0 for a in lo[x:y] for k in range(n))
    assert starts == list(range(len(t) - 399))


def test_suffix_ranks_take_four_bytes():
    """Every level of ranks is kept until the block is done: a worker holds few bytes of them per byte of text."""
    import numpy as np
    from lexitrend.llm import substring_dup as D
    codes = np.frombuffer(b"abcab" * 300 + b"\xff" + b"abcab" * 300 + b"\xff", dtype=np.uint8) + np.uint8(1)
    _, levels = D.suffix_array(codes, np.repeat([0, 1], 1501))
    assert len(levels) > 5 and all(rank.itemsize == 4 for _, rank in levels) and D.BLOCK <= 1 << 18
