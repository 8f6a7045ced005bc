"""Exact substring dedup with a run-length index: every byte of a 400-byte string that also starts
elsewhere is removed.

1. Every 400-byte string is filed under the smallest hash of the ``k``-byte strings inside it, so
   equal strings get the same key wherever they stand.  Consecutive starts with one key form a
   segment; a key that only one segment of the corpus has needs no look at the bytes.
2. Segments with equal bytes (fingerprint under an equal key) are repeats as a whole.
3. The different segments of a key meet in a block, a bounded text of whole key groups.  A block
   gets a run-length index: its Burrows-Wheeler transform, run by run, with a sample at each run
   end (text position, common prefix with the neighbour there).  Streaming over the text, the
   matching statistic of a position, its longest match elsewhere in the block, follows from the
   last sample: between samples it falls by one a byte.  Starts with 400 or more are repeats.
4. A key with very many different segments is not sent to one block: its segments go through the
   same steps with longer strings inside (384, then 400 bytes), which share fewer keys; with 400
   bytes the key is the string itself, and step 2 settles it.

Defined results: null text is empty; texts below 400 bytes lose nothing; rows with equal id and
text are copies like any other; removal is judged on the input; extra columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ready, schema, texts, written

LENGTH = 400
#: Lengths of the strings whose smallest hash is a key: at first, and for keys with many segments.
INNER = (128, 384, LENGTH)
#: Different segments of a key that may meet in one block.
MOST = 256
#: Bytes worked on at once, and bytes that a block holds on average.
PIECE, BLOCK = 1 << 19, 1 << 18
_RNG = np.random.default_rng(20240701)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P, _P2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: The fingerprint's values of bytes are drawn apart from the key's.
_MARK = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_Q = np.uint64(0xD6E8FEB86659FD93)
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _Q
    return h ^ (h >> _S29)


def _powers(p: int, n: int) -> np.ndarray:
    out = np.full(n, p & (1 << 64) - 1, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def powers(p: int, n: int) -> np.ndarray:
    """The first ``n`` powers; a worker keeps them."""
    if len(_POWERS.get(p, ())) < n:
        _POWERS[p] = _powers(p, max(n, 2 * PIECE))
    return _POWERS[p][:n]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of each ``w`` consecutive values."""
    n = len(x) - w + 1
    rows = -(-len(x) // w)
    pad = np.full(rows * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    pad[:len(x)] = x
    ahead = np.minimum.accumulate(pad.reshape(rows, w), axis=1).ravel()
    back = np.minimum.accumulate(pad.reshape(rows, w)[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def segments(batch: list[bytes], k: int):
    """(text, starts, key, fingerprint, first starts of all, offsets into them) arrays: one entry for
    all equal segments of a text."""
    todo, size = [], 0
    for i, b in enumerate(batch):
        for at in range(0, max(len(b) - LENGTH + 1, 0), PIECE):
            todo.append((i, at, b[at:at + PIECE + LENGTH - 1]))
            size += len(todo[-1][2])
            if size >= PIECE:
                yield _segments(todo, k)
                todo, size = [], 0
    if todo:
        yield _segments(todo, k)


def _segments(pieces: list[tuple[int, int, bytes]], k: int):
    raw = np.frombuffer(b"".join(p[2] for p in pieces), dtype=np.uint8)
    ends = np.cumsum([len(p[2]) for p in pieces])
    n = len(raw)
    power, back = powers(_P, n + 1), powers(pow(_P, -1, 1 << 64), n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * power[:n], out=total[1:])
    inner = _mix((total[k:] - total[:n - k + 1]) * back[:n - k + 1])
    key = sliding_min(inner, LENGTH - k + 1)
    starts = np.arange(len(key))
    piece = np.searchsorted(ends, starts, side="right")
    ok = starts + LENGTH <= ends[piece]
    starts, key, piece = starts[ok], key[ok], piece[ok]
    # a segment also ends where the first smallest string drops out and an equal one takes its place:
    # inside a segment no 400 bytes repeat, and a periodic text becomes equal segments
    drops = inner[starts] == key
    first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (piece[1:] != piece[:-1]) | drops[:-1]])[:len(starts)]
    count = np.diff(np.r_[first, len(starts)])
    s, key, which = starts[first], key[first], piece[first]
    # the fingerprint is another polynomial over other values: equal by chance needs 128 equal bits
    power, back = powers(_P2, n + 1), powers(pow(_P2, -1, 1 << 64), n + 1)
    np.cumsum(_MARK[raw] * power[:n], out=total[1:])
    prints = _mix((total[s + count + LENGTH - 1] - total[s]) * back[s]) ^ count.astype(np.uint64)
    begin = np.r_[0, ends[:-1]]
    text = np.array([p[0] for p in pieces])[which]
    lo = np.array([p[1] for p in pieces])[which] + s - begin[which]
    order = np.lexsort((lo, prints, key, text))
    text, lo, key, prints, count = (x[order] for x in (text, lo, key, prints, count))
    new = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (key[1:] != key[:-1]) | (prints[1:] != prints[:-1])])[:len(lo)]
    return text[new], count[new], key[new].view(np.int64), prints[new].view(np.int64), lo, np.r_[new, len(lo)]


def suffix_array(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffixes in order and the ranks by their first 8, 16, ... symbols.  ``codes``: bytes plus one,
    0 at the end of each segment, which counts as a symbol of its own (``owner``: the segment)."""
    n = len(codes)
    wide = np.concatenate([codes, np.zeros(8, codes.dtype)]).astype(np.uint64)
    stop = np.flatnonzero(codes == 0)
    left = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n)  # symbols before the end
    word = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        word = (word << np.uint64(8)) | np.where(left >= j, wide[j:j + n], np.uint64(0))
    tie = np.where(left < 8, owner + 1, 0)
    order = np.lexsort((tie, word))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.cumsum(np.r_[0, (word[order][1:] != word[order][:-1]) | (tie[order][1:] != tie[order][:-1])])
    levels = [(8, rank.astype(np.int32))]
    h = 8
    while rank.max() < n - 1:
        after = np.concatenate([rank[h:] + 1, np.zeros(min(h, n), np.int64)])[:n]
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.r_[0, pair[order][1:] != pair[order][:-1]])
        h *= 2
        levels.append((h, rank.astype(np.int32)))
    return order, levels


def common_prefix(codes: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of the suffixes at a and b."""
    n, a, b = len(codes), a.copy(), b.copy()
    out = np.zeros(len(a), dtype=np.int64)
    for h, rank in reversed(levels):
        same = (a < n) & (b < n) & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
        out += h * same
        a, b = a + h * same, b + h * same
    same = np.ones(len(a), dtype=bool)
    for j in range(8):
        x, y = np.minimum(a + j, n - 1), np.minimum(b + j, n - 1)
        same &= (a + j < n) & (b + j < n) & (codes[x] == codes[y]) & (codes[x] != 0)
        out += same
    return out


class RunLengthIndex:
    """The runs of a Burrows-Wheeler transform, with samples at both ends of each run."""

    def __init__(self, parts: list[bytes]):
        sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
        codes = np.frombuffer(b"\xff".join(parts) + b"\xff", dtype=np.uint8) + np.uint8(1)  # 255 is in no UTF-8 text
        owner = np.repeat(np.arange(len(parts)), sizes)
        order, levels = suffix_array(codes, owner)
        self.n = len(codes)
        # the symbol before a suffix; ends of segments are symbols of their own
        before = np.where(order > 0, codes[order - 1].astype(np.int64), -1)
        before[before == 0] = -2 - owner[order - 1][before == 0]
        change = np.flatnonzero(before[1:] != before[:-1]) + 1
        heads, tails = np.r_[0, change], np.r_[change - 1, self.n - 1]
        self.symbols = before[heads]
        self.head_at, self.tail_at = order[heads], order[tails]
        self.head_match = np.zeros(len(heads), dtype=np.int64)
        self.tail_match = np.zeros(len(heads), dtype=np.int64)
        if len(heads) > 1:
            at = common_prefix(codes, levels, order[heads[1:] - 1], order[heads[1:]])
            self.head_match[1:], self.tail_match[:-1] = at, at

    def matching_statistics(self) -> np.ndarray:
        """For each text position the longest match that starts anywhere else in the text."""
        best = np.zeros(self.n, dtype=np.int64)
        for at, match in ((self.head_at, self.head_match), (self.tail_at, self.tail_match)):
            by = np.argsort(at)
            at, match = at[by], match[by]
            last = np.searchsorted(at, np.arange(self.n), side="right") - 1
            found = np.where(last >= 0, match[last] - (np.arange(self.n) - at[last]), 0)
            best = np.maximum(best, found)
        return best


def long_starts(parts: list[bytes]) -> list[list[tuple[int, int]]]:
    """For each part the ranges (first, last) of starts whose LENGTH bytes start elsewhere too."""
    hit = RunLengthIndex(parts).matching_statistics() >= LENGTH
    edge = np.diff(np.r_[False, hit, False].astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    begin = np.cumsum([0] + [len(p) + 1 for p in parts])
    which = np.searchsorted(begin, first, side="right") - 1
    out = [[] for _ in parts]
    for i, a, b in zip(which, first - begin[which], last - begin[which], strict=True):
        out[i].append((int(a), int(b)))
    return out


RANGES = "array<struct<lo long, hi long>>"


def together(found: DataFrame) -> DataFrame:
    """One row per text with all its ranges; those that repeated rows bring are the same and count once."""
    return found.groupBy("k1", "k2").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def repeated_starts(docs: DataFrame, inner: tuple[int, ...] = INNER) -> DataFrame:
    """(k1, k2, ranges): ranges (lo, hi) of repeated starts in the texts of ``docs`` (k1, k2, text binary)."""
    spark = docs.sparkSession

    def cut(batches, k=inner[0]):
        for b in batches:
            for text, count, key, mark, lo, offsets in segments(texts(b.column(2)), k):
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(text)), b.column(1).take(pa.array(text)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(lo, pa.int64())),
                     pa.array(count.astype(np.int64)), pa.array(key), pa.array(mark)],
                    ["k1", "k2", "lo", "starts", "key", "mark"])

    long = docs.where(F.octet_length("text") >= LENGTH)
    every = written(spark, long.select("k1", "k2", "text").mapInArrow(
        cut, "k1 long, k2 long, lo array<long>, starts long, key long, mark long"), "repeats-segments")
    size = F.size("lo").cast("long")
    often = every.groupBy("key").agg(F.sum(size).alias("n")).where("n > 1").select("key")
    shared = written(spark, every.join(often, "key"), "repeats-shared")
    marks = shared.groupBy("key", "mark").agg(
        F.sum(size).alias("n"), F.min(F.struct("k1", "k2", F.col("lo")[0].alias("lo"), "starts")).alias("at"))
    marks = written(spark, marks.select("key", "mark", "n", "at.*"), "repeats-marks")
    whole = shared.join(marks.where("n > 1").select("key", "mark"), ["key", "mark"])
    found = whole.select("k1", "k2", F.transform("lo", lambda x: F.struct(
        x.alias("lo"), (x + F.col("starts") - 1).alias("hi"))).cast(RANGES).alias("ranges"))
    if len(inner) == 1:
        return found
    groups = marks.groupBy("key").agg(F.count("*").alias("m"), F.max(F.col("n") == 1).alias("open")).where("m > 1 and open")
    open_marks = marks.join(groups.select("key", "m"), "key")
    per_text = open_marks.groupBy("k1", "k2").agg(F.collect_list(F.struct("key", "mark", "n", "m", "lo", "starts")).alias("s"))

    def fetch(batches):
        for b in batches:
            cols = [[] for _ in range(8)]
            for k1, k2, text, parts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2)),
                                           b.column(3).to_pylist(), strict=True):
                for p in parts:
                    row = (k1, k2, p["lo"], p["key"], p["mark"], p["n"], p["m"],
                           text[p["lo"]:p["lo"] + p["starts"] + LENGTH - 1])
                    for c, v in zip(cols, row, strict=True):
                        c.append(v)
            kinds = [pa.int64()] * 7 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             ["k1", "k2", "lo", "key", "mark", "n", "m", "text"])

    # equal (k1, k2) have equal texts: one of them is read
    bytes_of = docs.select("k1", "k2", "text").join(per_text, ["k1", "k2"])
    bytes_of = bytes_of.select("k1", "k2", "text", "s").mapInArrow(
        fetch, "k1 long, k2 long, lo long, key long, mark long, n long, m long, text binary")
    bytes_of = written(spark, bytes_of.dropDuplicates(["key", "mark"]), "repeats-bytes")
    few = bytes_of.where(F.col("m") <= MOST)
    size = few.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))

    def index(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("mark", "ascending")])
        rows = [[], [], [], []]
        k1, k2, lo, n = (table.column(c).to_pylist() for c in ("k1", "k2", "lo", "n"))
        for i, ranges in enumerate(long_starts(texts(table.column("text")))):
            for a, b in ranges if n[i] == 1 else ():
                for c, v in zip(rows, (k1[i], k2[i], lo[i] + a, lo[i] + b), strict=True):
                    c.append(v)
        return pa.table([pa.array(c, pa.int64()) for c in rows], ["k1", "k2", "lo", "hi"])

    blocked = few.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    matched = blocked.groupBy("block").applyInArrow(index, "k1 long, k2 long, lo long, hi long")
    found = found.unionByName(matched.select("k1", "k2", F.array(F.struct("lo", "hi")).cast(RANGES).alias("ranges")))
    many = bytes_of.where(F.col("m") > MOST)
    if many.limit(1).count():
        finer = together(repeated_starts(
            many.select(F.col("key").alias("k1"), F.col("mark").alias("k2"), "text"), inner[1:]))
        at = many.where("n = 1").select("key", "mark", F.col("k1").alias("d1"), F.col("k2").alias("d2"), "lo")
        finer = finer.join(at, (F.col("k1") == F.col("key")) & (F.col("k2") == F.col("mark")))
        moved = F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("lo")).alias("lo"),
                                                         (r["hi"] + F.col("lo")).alias("hi"))).cast(RANGES)
        found = found.unionByName(finer.select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), moved.alias("ranges")))
    return found


def remove_ranges(b: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """The text without the LENGTH bytes from each start in the ranges, and the removed spans."""
    spans = []
    for lo, hi in sorted(ranges):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi + LENGTH)
        else:
            spans.append([lo, hi + LENGTH])
    kept, at = [], 0
    for lo, hi in spans:
        kept.append(b[at:lo])
        at = hi
    return b"".join(kept) + b[at:], [tuple(s) for s in spans]


def substring_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False,
                    with_passages: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, shares_passage (whether another
    document holds a passage of more than 50 words of it too, ``passages``) and kept (binary): one row per row."""
    spark = docs.sparkSession
    ready(spark, 512)
    body = F.coalesce(F.encode(F.col(text).cast("string"), "UTF-8"), F.lit(b""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text"))
    rows = rows.select("key", F.xxhash64("key").alias("k1"), F.xxhash64("text").alias("k2"), "text")
    ranges = together(repeated_starts(rows.select("k1", "k2", "text")))
    if with_passages:  # by text; brought to the rows with their ranges, so that texts move once
        from .passages import sharing_texts
        ids = written(spark, rows.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")), "repeats-ids")
        shared = ids.drop("n").join(written(spark, sharing_texts(rows.select("k1", "k2", "text"), ids), "repeats-passages"),
                                    "k2", "left_semi")
        ranges = ranges.join(shared.withColumn("shared", F.lit(True)), ["k1", "k2"], "full")
    else:
        ranges = ranges.withColumn("shared", F.lit(False))
    both = (rows.join(written(spark, ranges, "repeats-ranges"), ["k1", "k2"], "left")
            .select("key", "text", "ranges", F.coalesce("shared", F.lit(False)).alias("shared")))
    names = (["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["shares_passage"] * with_passages
             + ["kept"] * with_text)

    def run(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for t, found in zip(texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                kept, spans = remove_ranges(t, [(r["lo"], r["hi"]) for r in found or ()])
                row = (len(t), len(t) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept)
                for c, v in zip(out, row, strict=True):
                    c.append(v)
            cols = [b.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
            cols += [b.column(3)] * with_passages + [pa.array(out[4], pa.binary())] * with_text
            yield pa.RecordBatch.from_arrays(cols, names)

    kinds = ("n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", shares_passage boolean" * with_passages
             + ", kept binary" * with_text)
    return both.mapInArrow(run, schema(("key", docs.schema[key].dataType), kinds)).withColumnRenamed("key", key)


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return substring_dedup(table(spark, sf_dir, "documents"), with_passages=True)
