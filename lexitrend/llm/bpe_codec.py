"""Byte-level BPE encoding and decoding with a sentencepiece model made from a rank file.

The vocabulary (base64 token, rank) is serialised straight into a sentencepiece BPE
model: every token's bytes are mapped to printable characters, its score is the
negative rank, normalisation is the identity.  Texts are cut into pre-tokens by the
pattern and each distinct pre-token is encoded once per worker cache; ids are decoded
by the inverse mapping.

Defined results: null text encodes as empty (no ids); special tokens in a text are
ordinary text; repeated rows are encoded one by one; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready, schema

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Distinct pre-tokens that a worker remembers; the cache is emptied when full.
CACHE = 300_000
_MINUS_ONE = (1 << 64) - 1


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank; the ranks must be 0, 1, 2 ... and hold all 256 bytes."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks with gaps, or a byte without a token")
    return tokens


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where Latin-1 prints it, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def _piece(text: str, score: float, kind: int) -> bytes:
    return _block(1, _block(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose piece ids are the ranks; the unknown piece follows them."""
    chars = byte_characters()
    pieces = b"".join(_piece("".join(chars[b] for b in t), -float(k), 1) for k, t in enumerate(tokens))
    pieces += _piece("<unk>", 0.0, 2)
    trainer = (_number(3, 2) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
               + b"".join(_number(k, _MINUS_ONE) for k in (41, 42, 43)))  # BPE; no begin, end or pad piece
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return pieces + _block(2, trainer) + _block(3, normaliser)


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, tokens: list[bytes], pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cut = regex.compile(pattern).findall
        self.to_chars = {b: c for b, c in enumerate(byte_characters())}
        self.cache: dict[str, str] = {}
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, text: str) -> str:
        """The decimal ids, joined by one space."""
        parts = self.cut(text)
        cache = self.cache
        new = [p for p in set(parts) if p not in cache]
        if new:
            if len(cache) + len(new) > CACHE:
                cache.clear()
                new = list(set(parts))
            mapped = [p.encode().decode("latin-1").translate(self.to_chars) for p in new]
            cache.update(zip(new, (" ".join(map(str, x)) for x in self.processor.encode(mapped, num_threads=1)),
                             strict=True))
        return " ".join([cache[p] for p in parts])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes behind the ids."""
        n = self.lengths[ids]
        shift = np.repeat(self.starts[ids] - (np.cumsum(n) - n), n)
        return self.bytes[shift + np.arange(len(shift))].tobytes()


_CODECS: dict[bytes, Codec] = {}


def encode_decode(df: DataFrame, columns: tuple[str, ...] = ("ids", "decoded"), key: str = "doc_id",
                  text: str = "text", vocabulary: str | None = None,
                  pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Encode every text and decode its ids again.

    ``columns`` picks among ids (array<int>), decoded (binary, from the ids), n_tokens,
    ids_sha256 and decoded_sha256.  The rank file is read once on the driver; the model
    made from it travels with the tasks."""
    ready(df.sparkSession)
    tokens = read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    shared = df.sparkSession.sparkContext.broadcast((sentencepiece_model(tokens), tokens))
    kinds = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("binary", pa.binary()),
             "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()),
             "decoded_sha256": ("string", pa.string())}

    def run(batches):
        model, words = shared.value
        mark = hashlib.sha256(model + pattern.encode()).digest()
        if mark not in _CODECS:
            _CODECS.clear()
            _CODECS[mark] = Codec(model, words, pattern)
        codec = _CODECS[mark]
        for b in batches:
            out = {c: [] for c in columns}
            for t in b.column(1).to_pylist():
                joined = codec.encode(t or "")
                ids = np.fromstring(joined, dtype=np.int64, sep=" ") if joined else np.zeros(0, np.int64)
                back = codec.decode(ids)
                for c in columns:
                    out[c].append(ids.astype(np.int32) if c == "ids" else back if c == "decoded"
                                  else len(ids) if c == "n_tokens"
                                  else hashlib.sha256(joined.encode() if c == "ids_sha256" else back).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(out[c], kinds[c][1]) for c in columns)],
                                             ["key", *columns])

    out = schema(("key", df.schema[key].dataType), ", ".join(f"{c} {kinds[c][0]}" for c in columns))
    return df.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, out).withColumnRenamed("key", key)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return encode_decode(table(spark, sf_dir, "documents"), ("n_tokens", "ids_sha256", "decoded_sha256"))
