"""Counting the n-grams of papers inside tasks (C1-C4), in arrays, with a filter against those too rare to be kept.

Most n-grams of a corpus occur in one or two papers, and moving them costs several times the text.  So two passes
are made.  ``sketches`` hashes each paper's n-grams to the buckets of its year and n; ``passing`` adds up the
papers per bucket and category and keeps, for each category, the buckets that reach the least document frequency.
An n-gram is in one bucket, and a bucket's papers are never fewer than the n-gram's: none that is to be kept is
lost.  ``counts`` then counts the words themselves, exactly, without the n-grams whose bucket was not kept.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need no copy of this module

#: Characters of text that a task's function takes at once, and bucket numbers it holds before it hands them on.
CHUNK, KEYS_AT_ONCE = 2 << 20, 2_000_000
#: Buckets of a slice, as a power of two: what a group of ``passing`` holds in memory.
SLICE = 22
#: Bits of the whole filter, at most: beyond it buckets share bits, and more rare n-grams pass.
FILTER_BITS = 1 << 28
_FAR = 65535


def room(chars: int) -> int:
    """Buckets of a year, as a power of two: one for four to eight characters, more than a category has n-grams."""
    return min(32, max(16, (chars // 8).bit_length()))


def folded(rooms: dict, years: list) -> int:
    """The two bits of a bucket stand for 2 ** this buckets, so that the whole filter has FILTER_BITS at most;
    years: of each (category, year, n) that it is for."""
    size = sum(2 << max(SLICE, rooms[y]) for y in years)
    return min(SLICE - 3, max(0, (size - 1).bit_length() - FILTER_BITS.bit_length() + 1)) if years else 0


def bits_of(buckets: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """The bits of buckets in the two parts of the filter: of those side by side, and of those equally far from
    the beginning of the part of a slice."""
    each = SLICE - fold
    return buckets >> fold, buckets >> SLICE << each | buckets & ((1 << each) - 1)


def chunks(sizes: np.ndarray):
    """Ranges of rows of at most CHUNK characters, one row at least."""
    total, at = np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(total, total[at] + CHUNK, "right")) - 1)
        yield at, to
        at = to


def words_of(texts: pa.Array, english: frozenset, more: frozenset):
    """Words that are no English stopwords: their numbers in a vocabulary and the texts they are from, the
    vocabulary, and which of it are unigrams too."""
    lists = pc.split_pattern(texts, " ")
    coded = pc.list_flatten(lists).dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    base = np.array([len(w) > 2 and w not in english for w in vocabulary], bool)
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    keep = base[ids]
    return (ids[keep], pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)[keep], vocabulary,
            np.array([w not in more for w in vocabulary], bool))


def starts(n: int, ids: np.ndarray, text: np.ndarray, unigram: np.ndarray) -> np.ndarray:
    """Where an n-gram begins: n words of one text."""
    if n == 1:
        return np.flatnonzero(unigram[ids])
    return np.flatnonzero(text[n - 1:] == text[:max(0, len(text) - n + 1)])


def word_hashes(vocabulary: list[str]) -> np.ndarray:
    return np.array([crc32(w.encode()) for w in vocabulary], np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(n: int, at: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """64 bits of each n-gram, the first ones well mixed; hashed: of each word of the texts."""
    x = hashed[at]
    for i in range(1, n):
        x = x * np.uint64(0xD6E8FEB86659FD93) + hashed[at + i]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)


class Kinds:
    """Numbers for the (year, domains) that a task meets, -1 for those without a domain of enough papers in the
    year; enough: the (category, year) that have them."""

    def __init__(self, enough):
        self.of, self.enough = {}, enough

    def __call__(self, years: pa.Array, domains: pa.Array) -> np.ndarray:
        found = [(y, tuple(x for x in d if (x, y) in self.enough)) for y, d in zip(years.to_pylist(), domains.to_pylist(), strict=True)]
        return np.array([self.of.setdefault(x, len(self.of)) if x[1] else -1 for x in found], np.int64)


def sorted_once(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys in order, and how often each occurs; ``keys`` are sorted in place (np.unique hashes, which is many times slower)."""
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(first, append=len(keys))


def sketches(batches, rooms: dict, floors: dict, enough, english: frozenset, more: frozenset):
    """From (year, domains, text): rows (year, n, slice, domains, buckets), the buckets of the n-grams of each
    paper, once a paper and no more often than the least document frequency, as gaps of two bytes."""
    kinds, held, size = Kinds(enough), [], 0

    def handed():
        keys = np.concatenate(held)
        held.clear()
        keys, times = sorted_once(keys)
        most = np.zeros(max(floors) + 1, np.int64)
        most[list(floors)] = list(floors.values())
        keys = np.repeat(keys, np.minimum(times, most[(keys >> 32) & 63]))
        group, local = keys >> SLICE, keys & ((1 << SLICE) - 1)
        first = np.flatnonzero(np.diff(group, prepend=-1))
        gap = np.diff(local, prepend=0)
        gap[first] = local[first]
        far = gap // _FAR
        end = np.cumsum(far + 1)
        coded = np.full(end[-1], _FAR, np.uint16)
        coded[end - 1] = gap % _FAR
        # where each group's gaps end, in bytes
        ends = 2 * np.append(end[first[1:] - 1], end[-1])
        buckets = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(coded)])
        known = list(kinds.of)
        of = keys[first]
        kind = of >> 38
        return pa.RecordBatch.from_arrays(
            [pa.array([known[k][0] for k in kind], pa.int32()), pa.array((of >> 32) & 63, pa.int32()),
             pa.array((of >> SLICE) & ((1 << (32 - SLICE)) - 1), pa.int32()),
             pa.array([list(known[k][1]) for k in kind], pa.list_(pa.string())), buckets],
            ["year", "n", "slice", "domains", "buckets"])

    for b in batches:
        kind = kinds(b.column(0), b.column(1))
        mine = np.flatnonzero(kind >= 0)
        kind, texts = kind[mine], b.column(2) if len(mine) == len(kind) else b.column(2).take(pa.array(mine))
        shift = np.array([64 - rooms[y] for y, _ in kinds.of], np.uint64)[kind]
        for at, to in chunks(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
            ids, text, vocabulary, unigram = words_of(texts.slice(at, to - at), english, more)
            hashed, text = word_hashes(vocabulary)[ids], text + at
            keys = []
            for n in floors:
                i = starts(n, ids, text, unigram)
                bucket = (gram_hashes(n, i, hashed) >> shift[text[i]]).astype(np.int64)
                keys.append((text[i].astype(np.int64) - at) << 38 | n << 32 | bucket)
            keys = sorted_once(np.concatenate(keys))[0]
            held.append(kind[(keys >> 38) + at] << 38 | keys & ((1 << 38) - 1))
            size += len(keys)
            if size >= KEYS_AT_ONCE:
                yield handed()
                size = 0
    if size:
        yield handed()


def passing(group: pa.Table, floors: dict, fold: int) -> pa.Table:
    """Of one (year, n, slice), for each category: the bits of the buckets that reach its least document frequency."""
    n = group["n"][0].as_py()
    blobs = group["buckets"].to_pylist()
    gaps = np.frombuffer(b"".join(blobs), np.uint16)
    length = np.array([len(x) // 2 for x in blobs])
    total = np.cumsum(gaps, dtype=np.int64)
    before = np.concatenate([[0], total])[np.cumsum(length) - length]
    real = gaps != _FAR
    local = (total - np.repeat(before, length))[real]
    row = np.repeat(np.arange(len(blobs)), length)[real]
    of = defaultdict(list)
    for i, domains in enumerate(group["domains"].to_pylist()):
        for d in domains:
            of[d].append(i)
    bits = []
    for rows in of.values():
        mine = np.zeros(len(blobs), bool)
        mine[rows] = True
        found = np.bincount(local[mine[row]], minlength=1 << SLICE) >= floors[n]
        bits.append(b"".join(np.packbits(x, bitorder="little").tobytes()
                             for x in (found.reshape(-1, 1 << fold).any(axis=1), found.reshape(1 << fold, -1).any(axis=0))))
    same = [group[c].combine_chunks().slice(0, 1).take(pa.array(np.zeros(len(bits), np.int64))) for c in ("year", "n", "slice")]
    return pa.table([pa.array(list(of), pa.string()), *same, pa.array(bits, pa.binary())], names=["category", "year", "n", "slice", "bits"])


def gathered(rows, rooms: dict, fold: int) -> dict:
    """(category, year, n) -> the two parts of the filter, from the rows of ``passing``."""
    found: dict = {}
    each = 1 << SLICE - fold - 3
    for category, year, n, part, bits in rows:
        if (category, year, n) not in found:
            found[category, year, n] = np.zeros((2, each << max(0, rooms[year] - SLICE)), np.uint8)
        found[category, year, n][:, part * each:(part + 1) * each] = np.frombuffer(bits, np.uint8).reshape(2, -1)
    return found


class Terms:
    """Counts of n-grams by (year, domains) and n: keys of word numbers, occurrences, papers, and the domains that
    may keep the n-gram, a bit for each."""

    def __init__(self):
        self.clear()
        self.width = 21

    def clear(self):
        self.vocabulary: dict = {}
        self.parts: dict = defaultdict(list)
        self.size = 0

    def numbers(self, words: list[str]) -> np.ndarray:
        return np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words], np.int64)

    def columns(self, n: int, at: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """The words of each n-gram, several to a number."""
        out, each = [], 63 // self.width
        for i in range(0, n, each):
            x = ids[at + i]
            for j in range(i + 1, min(n, i + each)):
                x = x << self.width | ids[at + j]
            out.append(x)
        return out

    def add(self, kind: int, n: int, columns: list, tf: np.ndarray, df: np.ndarray, may: np.ndarray):
        self.parts[kind, n].append((columns, tf, df, may))
        self.size += len(tf)

    def merge(self):
        for key, parts in self.parts.items():
            if len(parts) > 1:
                columns = [np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)]
                tf, df, may = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
                order = np.lexsort(columns)
                columns = [c[order] for c in columns]
                first = np.flatnonzero(changes(columns))
                parts[:] = [([c[first] for c in columns], np.add.reduceat(tf[order], first), np.add.reduceat(df[order], first), may[order][first])]
        self.size = sum(len(p[1]) for parts in self.parts.values() for p in parts)

    def rows(self, known: list, cells: dict, at_once: int = 1 << 16):
        """Record batches (cells, term, more, again): the numbers of the (category, year, n), the papers but one,
        and the occurrences beyond one in each paper."""
        words, each = pa.array(list(self.vocabulary), pa.string()), 63 // self.width
        for (kind, n), parts in self.parts.items():
            year, domains = known[kind]
            for columns, tf, df, may in parts:
                for at in range(0, len(tf), at_once):
                    some, found = slice(at, at + at_once), []
                    sets, which = np.unique(may[some], return_inverse=True)
                    mine = pa.array([[cells[d, year, n] for j, d in enumerate(domains) if x >> j & 1] for x in sets.tolist()], pa.list_(pa.int32()))
                    for i, c in enumerate(columns):
                        held = min(each, n - i * each)
                        found += [words.take(pa.array((c[some] >> self.width * j) & ((1 << self.width) - 1)))
                                  for j in range(held - 1, -1, -1)]
                    yield pa.RecordBatch.from_arrays(
                        [mine.take(pa.array(which)),
                         pc.binary_join_element_wise(*found, " ") if n > 1 else found[0],
                         pa.array(df[some] - 1), pa.array(tf[some] - df[some])], ["cells", "term", "more", "again"])


def changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where a sorted key differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def counts(batches, ns, kept, rooms: dict, fold: int, cells: dict, english: frozenset, more: frozenset, terms_at_once: int):
    """From (year, domains, texts of a paper): rows (cells, term, more, again) of the n-grams that ``kept`` (the
    filter, by category, year and n; n-grams of an n that it was not made for all pass) may hold, summed over the
    papers of one year and domains that the task has met until it holds terms_at_once.  cells: numbers for the
    (category, year, n) to count."""
    kinds, terms = Kinds({c[:2] for c in cells}), Terms()
    for b in batches:
        kind = kinds(b.column(0), b.column(1))
        texts, known = b.column(2), list(kinds.of)
        if len(kind) and (kind[0] < 0 or (np.diff(kind) < 0).any()):
            order = np.argsort(kind, kind="stable")
            order = order[kind[order] >= 0]
            texts, kind = texts.take(pa.array(order)), kind[order]
        flat = texts.flatten()
        ends = np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False))
        size = np.add.reduceat(np.append(pc.binary_length(flat).to_numpy(zero_copy_only=False), 0), ends - np.diff(ends, prepend=0)) if len(flat) else ends
        for low in np.flatnonzero(np.diff(kind, prepend=-1)):
            k = kind[low]
            high = np.searchsorted(kind, k, "right")
            year, domains = known[k]
            for at, to in chunks(size[low:high]):
                mine = texts.slice(low + at, to - at)
                ids, text, vocabulary, unigram = words_of(mine.flatten(), english, more)
                paper = pc.list_parent_indices(mine).to_numpy(zero_copy_only=False)[text]
                if len(terms.vocabulary) + len(vocabulary) >= 1 << terms.width:
                    terms.merge()
                    yield from terms.rows(known, cells)
                    terms.clear()
                    terms.width = 21 if len(vocabulary) < 1 << 21 else 31
                hashed, numbers = word_hashes(vocabulary)[ids], terms.numbers(vocabulary)[ids]
                for n in ns:
                    i = starts(n, ids, text, unigram)
                    may = np.full(len(i), (1 << len(domains)) - 1, np.int64)
                    if n in kept["ns"]:
                        places = bits_of((gram_hashes(n, i, hashed) >> np.uint64(64 - rooms[year])).astype(np.int64), fold)
                        may[:] = 0
                        for j, d in enumerate(domains):
                            if (bits := kept.get((d, year, n))) is not None:
                                both = [x[p >> 3] >> (p & 7).astype(np.uint8) & 1 for x, p in zip(bits, places, strict=True)]
                                may |= (both[0] & both[1]).astype(np.int64) << j
                        i, may = i[may > 0], may[may > 0]
                    if not len(i):
                        continue
                    columns = terms.columns(n, i, numbers)
                    order = np.lexsort(columns)
                    columns, doc = [c[order] for c in columns], paper[i[order]]
                    new = changes(columns)
                    first = np.flatnonzero(new)
                    new[1:] |= doc[1:] != doc[:-1]
                    terms.add(k, n, [c[first] for c in columns], np.diff(first, append=len(doc)), np.add.reduceat(new.astype(np.int64), first),
                              may[order][first])
                if terms.size >= terms_at_once:
                    terms.merge()
                    if terms.size >= terms_at_once // 2:
                        yield from terms.rows(known, cells)
                        terms.clear()
    terms.merge()
    yield from terms.rows(list(kinds.of), cells)
