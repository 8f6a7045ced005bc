"""Documents that share a passage of words with another document.

A companion of ``substring_dup`` that counts in words: which documents hold a sequence of ``LENGTH``
words (white space between them does not matter) that also stands in another document.

1. Every sequence of LENGTH words is filed under the smallest hash of the ``INNER``-word sequences
   inside it; consecutive starts with one key form a segment.
2. A segment with equal words (key and fingerprint, two independent 64-bit values) in different texts
   settles both.
3. Texts that step 2 leaves open may share less than a segment: of keys that they have in common with
   other texts, each sequence of LENGTH words is compared (key and a fingerprint of its own); only
   texts with such segments are read once more.

Texts that several rows have are shared; a task cuts each of them once.  Hot passages are aggregated
before they move: a key, a segment or a sequence travels as its least and its greatest text.

Defined results: null texts and those with fewer than LENGTH words share nothing; a passage repeated
in one document alone is not shared; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts, written
from .substring_dup import _BYTE, _P, _mix, powers, sliding_min

#: Passages are longer than 50 words.
LENGTH, INNER = 51, 8
#: Words hashed at once, bytes of texts cut together, and texts that a task remembers to have cut.
PIECE, GROUP, SEEN = 1 << 18, 1 << 21, 1 << 20
_P2 = 0xC2B2AE3D27D4EB4F
_OTHER = np.uint64(0x94D049BB133111EB)


def _rolling(values: np.ndarray, p: int):
    """A function that hashes values[a:b] for arrays a, b."""
    n = len(values)
    power, back = powers(p, n + 1), powers(pow(p, -1, 1 << 64), n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * power[:n], out=total[1:])
    return lambda a, b: _mix((total[b] - total[a]) * back[a])


def word_hashes(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts, cut at ASCII white space, and the words of each text."""
    raw = np.frombuffer(b" ".join(batch), dtype=np.uint8)
    inside = (raw > 32) | (raw < 9) | ((raw > 13) & (raw < 32))
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].view(np.int8)))
    first, last = edge[::2], edge[1::2]
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(first), PIECE):
        a, b = first[at:at + PIECE], last[at:at + PIECE]
        out.append(_rolling(_BYTE[raw[a[0]:b[-1]]], _P)(a - a[0], b - a[0]))
    ends = np.cumsum([len(t) + 1 for t in batch])
    return np.concatenate(out) | np.uint64(1), np.diff(np.searchsorted(first, ends), prepend=0)


def _marks(values: np.ndarray):
    return _rolling(_mix(values ^ _OTHER) | np.uint64(1), _P2)


def _segments(batch: list[bytes]):
    """(text, first, count, key, mark) arrays: consecutive starts with one key."""
    values, sizes = word_hashes(batch)
    none = np.zeros(0, np.int64)
    if len(values) < LENGTH:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    one, two = _rolling(values, _P), _marks(values)
    at = np.arange(len(values) - INNER + 1)
    inner = one(at, at + INNER)
    key = sliding_min(inner, LENGTH - INNER + 1)
    starts, ends = np.arange(len(key)), np.cumsum(sizes)
    text = np.repeat(np.arange(len(batch)), sizes)[:len(key)]
    ok = starts + LENGTH <= ends[text]
    starts, key, text = starts[ok], key[ok], text[ok]
    # a segment also ends where its smallest sequence drops out and an equal one takes its place
    drops = inner[starts] == key
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | drops[:-1]])[:len(starts)]
    count = np.diff(np.r_[new, len(starts)])
    s, of = starts[new], text[new]
    return of, s - (ends - sizes)[of], count, key[new], two(s, s + count + LENGTH - 1) ^ count.astype(np.uint64)


def sharing_texts(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(k2) of the texts that share a passage.  ``rows``: (k1, k2, text binary), one for each document;
    equal texts have equal k2.  ``ids``: (k1, k2, n), how many rows bear each pair, written."""
    spark = rows.sparkSession

    def cut(batches):
        seen = set()
        for b in batches:
            ids, todo, size = [], [], 0
            for k2, t in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                if k2 in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(k2)
                ids.append(k2)
                todo.append(t)
                size += len(t)
                if size >= GROUP:
                    yield segments(ids, todo)
                    ids, todo, size = [], [], 0
            if todo:
                yield segments(ids, todo)

    def segments(ids, todo):
        text, first, count, key, mark = _segments(todo)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(ids, np.int64)[text]), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)),
             pa.array(key.view(np.int64)), pa.array(mark.view(np.int64))], ["k2", "first", "count", "key", "mark"])

    every = written(spark, rows.select("k2", "text").mapInArrow(
        cut, "k2 long, first int, count int, key long, mark long"), "passages-segments")
    sides = [F.min("k2").alias("a"), F.max("k2").alias("b")]
    # written, so that the joins below are of plain tables, which adaptive execution splits on a hot key
    keys = written(spark, every.groupBy("key").agg(*sides).where("a <> b").select("key"), "passages-keys")
    near = written(spark, every.join(keys, "key"), "passages-near")
    marks = written(spark, near.groupBy("key", "mark").agg(*sides, F.min(F.struct("k2", "first", "count")).alias("at")),
                    "passages-marks")
    of_several = written(spark, marks.where("a <> b").select("key", "mark"), "passages-whole")
    by_text = written(spark, ids.groupBy("k2").agg(F.min("k1").alias("k1"), F.sum("n").alias("n")), "passages-texts")
    copies = every.where("first = 0").select("k2").join(by_text.where("n > 1").select("k2"), "k2", "left_semi")
    settled = written(spark, near.join(of_several, ["key", "mark"], "left_semi").select("k2").unionByName(copies).distinct(),
                      "passages-settled")
    # what is open, and all that it may share sequences with
    loose = marks.where("a = b").join(settled.select(F.col("k2").alias("a")), "a", "left_anti").select("key").distinct()
    mixed = marks.join(loose, "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("key")
    chosen = marks.join(mixed, "key", "left_semi").select("key", "a", "b", "at.*")
    chosen = chosen.groupBy("k2").agg(F.collect_list(F.struct("first", "count", "key", "a", "b")).alias("s")).join(by_text.drop("n"), "k2")

    def sequences(batches):
        for b in batches:
            for text, found in zip(texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                two = _marks(word_hashes([text])[0])
                start = np.concatenate([np.arange(s["first"], s["first"] + s["count"]) for s in found])
                of = np.repeat(np.arange(len(found)), [s["count"] for s in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(two(start, start + LENGTH).view(np.int64)),
                     *(pa.array(np.array([s[c] for s in found], np.int64)[of]) for c in ("key", "a", "b"))], ["h", "key", "a", "b"])

    hashes = written(spark, rows.join(chosen, ["k1", "k2"]).select("text", "s")
                     .mapInArrow(sequences, "h long, key long, a long, b long"), "passages-sequences")
    both = hashes.groupBy("key", "h").agg(F.min("a").alias("a"), F.max("b").alias("b")).where("a <> b").select("key", "h")
    more = hashes.where("a = b").join(written(spark, both, "passages-both"), ["key", "h"], "left_semi").select(F.col("a").alias("k2"))
    return settled.unionByName(more).distinct()
