"""Sum-of-squares online packing of tokenised documents into fixed windows.

A document is its token ids and one closing id.  Whole windows are cut off its front; what
remains is placed, as it arrives, into the fill level that makes the sum over all levels of
(number of partly filled windows at that level) squared smallest.  Those numbers stand in a
level array, so one step is a few vector operations whatever the number of windows.

Every task packs the rows it reads, in one pass and without a shuffle.  It keeps the pieces of
partly filled windows; beyond ``open_most`` of them, and at its end, it fills the fullest
windows with pieces of the emptiest, cutting them where needed.  One window at most is then
left, and its tokens are dealt out to sequences of power-of-two lengths, which need no padding.

Token ids: a text of plain letters is cut into words as the tokenizer cuts it, any other text at
ASCII white space, which no token crosses, and the tokenizer encodes each distinct piece once.  Texts
of a vocabulary that prepares them otherwise go to its tokenizer whole.

Defined results: null or empty texts are the closing id alone; every row is a document of its
own, so repeated rows are packed one by one; rows with a null doc_id are packed like others;
texts of any length are packed whole; extra columns are not read; an empty table gives an empty
result.  Sequence ids hold the number of the task's partition above ``LOCAL_BITS`` bits.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready, schema, texts

VOCABULARY = "word_bpe_49k.json"
WINDOW = 4096
#: The id that closes each document.
CLOSING_ID = 2
#: Partly filled windows that a task holds, at most (16 kB each).
OPEN_MOST = 1024
LOCAL_BITS = 40
#: Distinct pieces that a worker remembers, and the length of the longest; when full, it keeps those in use.
CACHE, LONGEST = 600_000, 64
#: Bytes of text that are encoded together, unless one run is longer.
CALL_BYTES = 1 << 20
SPACE = re.compile(rb"[\t-\r ]")
#: How a known vocabulary's tokenizer prepares texts.
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
#: Plain texts hold ASCII, Latin-1 letters and some punctuation alone, and no special string: normalising them
#: is lower case, and what is no letter is cut off as the tokenizer does it.
OTHER = r"[^\x00-\x7fÀ-ÖØ-öø-ÿ–—‘’“”…]|<\|"
NOT_LETTERS = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\t-\r a-zß-öø-ÿ0-9]+)"
_ID = np.dtype("<u4")


class Encoder:
    """Token ids of one worker, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        self.known = {k: steps[k] for k in STEPS} == STEPS
        self.bare = Tokenizer.from_file(path)  # for words that are cut and in lower case already
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words: dict[str, bytes] = {}
        self.runs: dict[str, bytes] = {}

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each plain word."""
        got = self.bare.encode(words, is_pretokenized=True, add_special_tokens=False)
        return _slices(got.ids, np.cumsum(np.bincount(np.array(got.word_ids, np.int64), minlength=len(words))))

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The ids of each run without white space: a token belongs to the run it starts in."""
        got = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
        starts = np.fromiter((a for a, _ in got.offsets), np.int64, len(got.ids))
        return _slices(got.ids, np.searchsorted(starts, np.cumsum([len(w) + 1 for w in runs])))

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part; parts of some CALL_BYTES in all keep this small."""
        text = pa.array(parts, pa.binary()).cast(pa.string())
        if not self.known:
            return [np.array(e.ids, dtype=_ID).tobytes()
                    for e in self.tokenizer.encode_batch(text.to_pylist(), add_special_tokens=False)]
        other = pc.match_substring_regex(text, OTHER)
        plain = pc.replace_substring_regex(pc.utf8_lower(text.filter(pc.invert(other))), NOT_LETTERS, r" \1 ")
        words, self.words = _joined(pc.ascii_split_whitespace(plain), self.words, self._words)
        runs, self.runs = _joined(pc.ascii_split_whitespace(text.filter(other)), self.runs, self._runs)
        words, runs = iter(words), iter(runs)
        return [next(runs if x else words) for x in other.to_pylist()]

    def encode_all(self, texts: list[bytes]):
        """(number of the text, its ids), one text after the other; long ones are encoded part by part."""
        done, parts, owners, size = {}, [], [], 0
        for k, t in enumerate(texts):
            at = 0
            while at < len(t) or not t:
                cut = SPACE.search(t, at + CALL_BYTES) if self.known else None
                end = cut.start() if cut else len(t)
                parts.append(t[at:end])
                owners.append(k)
                size += end - at
                at = end
                if size >= CALL_BYTES:
                    for o, ids in zip(owners, self.encode(parts), strict=True):
                        done.setdefault(o, []).append(ids)
                    parts, owners, size = [], [], 0
                    yield from ((o, b"".join(done.pop(o))) for o in sorted(done) if o < k)
                if not t:
                    break
        for o, ids in zip(owners, self.encode(parts), strict=True):
            done.setdefault(o, []).append(ids)
        yield from ((o, b"".join(done.pop(o))) for o in sorted(done))


class Packer:
    """Windows of one task.  A piece is (document, start, ids); ``closed`` gathers the pieces of
    finished sequences as (document, start, ids, sequence, offset)."""

    def __init__(self, window: int = WINDOW, open_most: int = OPEN_MOST):
        self.window, self.open_most = window, open_most
        self.counts = np.zeros(window + 1, dtype=np.int64)  # windows at each level; 0 and the last stay 0
        self.at: dict[int, list[list]] = {}  # level -> windows, each a list of pieces
        self.n_open = 0
        self.closed: list[tuple] = []
        self.sequences = 0

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids in pieces:
            self.closed.append((doc, start, ids, self.sequences, offset))
            offset += len(ids)
        self.sequences += 1

    def level_for(self, size: int) -> int:
        """The level (0: a new window) that a piece of ``size`` tokens goes to; of equal ones the fullest."""
        stop = self.window - size
        change = 2 * (self.counts[size:] - self.counts[:stop + 1]) + 2
        change[0] -= 1  # a new window leaves no level, a filled one enters none
        change[stop] -= 1
        change[1:][self.counts[1:stop + 1] == 0] = np.iinfo(np.int64).max
        return stop - int(np.argmin(change[::-1]))

    def _put(self, level: int, pieces: list) -> None:
        if level == self.window:
            self._close(pieces)
        else:
            self.at.setdefault(level, []).append(pieces)
            self.counts[level] += 1
            self.n_open += 1

    def add(self, doc, ids: np.ndarray) -> None:
        whole = len(ids) - len(ids) % self.window
        for start in range(0, whole, self.window):
            self._close([(doc, start, ids[start:start + self.window])])
        if size := len(ids) - whole:
            level = self.level_for(size)
            pieces = []
            if level:
                pieces = self.at[level].pop()
                self.counts[level] -= 1
                self.n_open -= 1
            pieces.append((doc, whole, ids[whole:]))
            self._put(level + size, pieces)
            if self.n_open > self.open_most:
                self.gather()

    def gather(self) -> None:
        """Fill the fullest windows with pieces of the emptiest; one at most stays open."""
        windows = [(n, w) for n in sorted(self.at, reverse=True) for w in self.at[n]]
        self.at, self.n_open = {}, 0
        self.counts[:] = 0
        first, last = 0, len(windows) - 1
        while first < last:
            level, pieces = windows[first]
            while level < self.window and first < last:
                below, source = windows[last]
                doc, start, ids = source.pop()
                take = ids[:self.window - level]
                pieces.append((doc, start, take))
                level += len(take)
                if len(take) < len(ids):
                    source.append((doc, start + len(take), ids[len(take):]))
                windows[last] = below - len(take), source
                if not source:
                    last -= 1
            windows[first] = level, pieces
            if level == self.window:
                self._close(pieces)
                first += 1
        if first == last:
            self._put(*windows[first])

    def finish(self) -> None:
        """Close all windows: the last one's tokens go to sequences of power-of-two lengths."""
        self.gather()
        rest = [p for windows in self.at.values() for w in windows for p in w]
        left = sum(len(ids) for _, _, ids in rest)
        self.at, self.n_open = {}, 0
        self.counts[:] = 0
        rest.reverse()
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            pieces = []
            while room:
                doc, start, ids = rest.pop()
                pieces.append((doc, start, ids[:room]))
                if len(ids) > room:
                    rest.append((doc, start + room, ids[room:]))
                room -= len(pieces[-1][2])
            self._close(pieces)


def _slices(ids: list[int], ends: np.ndarray) -> list[bytes]:
    """The ids up to each end from the one before."""
    ids, ends = np.array(ids, dtype=_ID).tobytes(), ends * _ID.itemsize
    return list(map(ids.__getitem__, map(slice, [0, *ends[:-1]], ends)))


def _joined(parts: pa.ListArray, cache: dict, encode) -> tuple[list[bytes], dict]:
    """The ids of each list of pieces, and the cache to go on with: pieces in use stay when it is full."""
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    found = list(map(cache.get, distinct))
    if missing := [k for k, x in enumerate(found) if x is None]:
        if len(cache) + len(missing) > CACHE:
            cache = {w: x for w, x in zip(distinct, found, strict=True) if x is not None}
        new = [distinct[k] for k in missing]
        for k, w, x in zip(missing, new, encode(new), strict=True):
            found[k] = x
            if len(w) <= LONGEST:
                cache[w] = x
    # all ids from those of the distinct pieces, by their places there
    ids = np.frombuffer(b"".join(found), dtype=_ID)
    size = np.array(list(map(len, found)), dtype=np.int64) // _ID.itemsize
    at = coded.indices.to_numpy(zero_copy_only=False)
    n = size[at]
    ends = np.cumsum(n)
    ids = ids[np.repeat((np.cumsum(size) - size)[at] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
    cuts = np.r_[0, ends][parts.offsets.to_numpy() - parts.offsets[0].as_py()] if len(parts) else [0]
    return [ids[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)], cache


_ENCODERS: dict[str, Encoder] = {}


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
         window: int = WINDOW, closing_id: int = CLOSING_ID, open_most: int = OPEN_MOST,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: the key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and
    with ``with_ids`` the piece's ids (array<int>).

    ``vocabulary`` is the path of a tokenizer file that every executor can read at that place; by
    default the installed package of vocabularies names it on each executor."""
    ready(df.sparkSession, 512)
    key_type = df.schema[key].dataType

    def run(batches):
        path = vocabulary or public_tokenizers.path(VOCABULARY)
        if path not in _ENCODERS:
            _ENCODERS.clear()
            _ENCODERS[path] = Encoder(path)
        encoder, packer, base = _ENCODERS[path], Packer(window, open_most), 0
        kind = None

        def rows():
            out, packer.closed = packer.closed, []
            arrays = [pa.array([d[0] for d, *_ in out], kind), pa.array([r[1] for r in out], pa.int64()),
                      pa.array([len(r[2]) for r in out], pa.int64()),
                      pa.array([zlib.crc32(r[2].tobytes()) for r in out], pa.int64()),
                      pa.array([d[1] for d, *_ in out], pa.int64()),
                      pa.array([base + r[3] for r in out], pa.int64()), pa.array([r[4] for r in out], pa.int64())]
            if with_ids:
                arrays.append(pa.array([r[2].astype(np.int32) for r in out], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names)

        for b in batches:
            kind = b.column(0).type
            if b.num_rows:
                base = b.column(2)[0].as_py() << LOCAL_BITS
            docs = b.column(0).to_pylist()
            for k, ids in encoder.encode_all(texts(b.column(1))):
                ids = np.frombuffer(ids + closing, dtype=_ID)
                packer.add((docs[k], len(ids)), ids)
                if len(packer.closed) >= 4096:
                    yield rows()
            if packer.closed:
                yield rows()
        packer.finish()
        if packer.closed:
            yield rows()

    names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    closing = np.array([closing_id], dtype=_ID).tobytes()
    out = schema(("key", key_type), "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
                 "offset long" + ", ids array<int>" * with_ids)
    return (df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"),
                      F.spark_partition_id().cast("long").alias("part"))
            .mapInArrow(run, out).withColumnRenamed("key", key))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return pack(table(spark, sf_dir, "documents"))
