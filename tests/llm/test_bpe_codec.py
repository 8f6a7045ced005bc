import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from lexitrend.llm import bpe_codec as B


@pytest.fixture(scope="module")
def tokens():
    return B.read_ranks(public_tokenizers.path(B.VOCABULARY))


@pytest.fixture(scope="module")
def reference(tokens):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: k for k, t in enumerate(tokens)},
                             special_tokens={})


def test_every_token_is_its_own_encoding(tokens):
    sp = sentencepiece.SentencePieceProcessor(model_proto=B.sentencepiece_model(tokens))
    chars = B.byte_characters()
    assert [x for x in sp.encode(["".join(chars[b] for b in t) for t in tokens])] == [[k] for k in range(len(tokens))]


def texts():
    r = random.Random(0)
    letters = [chr(c) for c in [*range(0, 400), 0x2581, 0x3000, 0x85, 0x2028, 0x1F600, 0x301, 0x4E2D]]
    out = ["", None, "<|endoftext|> don't  \n\n x", "▁▁  ", " " * 3000, "a" * 5000, "é" * 3000]
    return out + ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(300)]


def test_equals_the_library_and_decodes(docs, reference, monkeypatch):
    rows = list(enumerate(texts())) + [(1, "twice"), (1, "twice"), (None, "no id")]
    want = sorted((str(i), reference.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows)
    got = B.encode_decode(docs(rows, extra=True)).collect()
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in got) == want
    monkeypatch.setattr(B, "CACHE", 50)
    got = B.encode_decode(docs(rows), ("n_tokens", "ids_sha256", "decoded_sha256")).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(
        (i, len(x), sha(" ".join(map(str, x)).encode()), sha(b)) for i, x, b in want)
    assert B.encode_decode(docs([])).count() == 0


def test_bad_vocabulary(tmp_path):
    p = tmp_path / "v"
    p.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        B.read_ranks(str(p))
