"""Benchmark decontamination: a BM25 inverted index of test items, queried by every passage.

Items become postings (term, item, impact); impacts are divided by the item's own threshold,
a share ``TAU`` of its score against itself, so that every item is retrieved at 1.  Items of
one language and similar length share a block, and each term keeps its largest impact per block and overall.
Every document is cut into passages of two strides (a stride is at least as long as the
items of its class, so each occurrence lies whole in one passage) and a batch of passages goes through the index
together, as block-max WAND does one by one: the sum of the largest impacts drops passages
that can reach no item, the sums of block maxima drop blocks, and only what is left is scored
from the postings.  Both bounds never fall below the score, so everything above the threshold
is retrieved.  A retrieved pair counts as a leak if enough word sequences of the question (all
sentences but the last) and of the answer (the last sentence) stand in the passage.

Words are lower-cased runs of Unicode letters, digits and marks; in scripts without spaces every
character is a word.  Defined results: null
or empty texts and items never match; repeated rows and items are handled one by one (equal
items once); extra columns are not read; an empty table on either side gives an empty result.
Items are indexed in shards of some bounded size, a few for each pass over the documents; the driver holds
those of one pass.  Document frequencies and the mean length are those of the whole benchmark, and a stride
belongs to a class of lengths, so that the shards make no difference to the result.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import ready, schema, whole_row, written

K1, B = 1.2, 0.75
#: Share of an item's score against itself that a passage must reach.
TAU = 0.5
#: Shares of the question's and the answer's word sequences that must stand in the passage.
QUESTION, ANSWER = 0.4, 0.4
LEAST_STRIDE = 64
BLOCK_ITEMS = 4
#: Cells of a matrix of block maxima that are held at once.
CELLS = 2_000_000
#: Bounds of one shard of the index, which is sent to every task.
SHARD_ITEMS, SHARD_BYTES = 4096, 4 << 20
#: Shards that one pass over the documents is held against.
SHARDS_A_PASS = 4
_KEEP = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
_LAST = re.compile(r"(?<=[.!?])\s+(?=\S)|(?<=[\u3002\uff01\uff1f])\s*(?=\S)")
#: Scripts that write no spaces between words, by the first word of their characters' names.
_NO_SPACES = {"CJK", "HIRAGANA", "KATAKANA", "HALFWIDTH", "THAI", "LAO", "KHMER", "MYANMAR", "TIBETAN"}


class _Cut(dict):
    """For str.translate: letters, digits and marks stay, or are words of their own in scripts without spaces."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        new = " "
        if unicodedata.category(c)[0] in "LNM":
            new = f" {c} " if unicodedata.name(c, "").split(" ")[0] in _NO_SPACES else c
        self[code] = new
        return new


_CUT = _Cut()


def words_of(text: str | None) -> list[bytes]:
    low = (text or "").lower()
    if low.isascii():
        return low.encode().translate(_KEEP).split()
    return low.translate(_CUT).encode("utf-8", "replace").split()


def sequences(words: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    n = max(1, min(n, len(words)))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}


@dataclass
class Item:
    item_id: object
    words: list[bytes]
    question: set = field(default_factory=set)
    answer: set = field(default_factory=set)


def item_of(item_id, text: str) -> Item:
    """Question and answer as sets of word sequences; an item of one sentence is split in halves."""
    words = words_of(text)
    parts = _LAST.split(text.strip())
    answer = words_of(parts[-1]) if len(parts) > 1 else words[len(words) // 2:]
    if not answer or len(answer) >= len(words):
        answer = words[len(words) // 2:]
    question = words[:len(words) - len(answer)] or words
    return Item(item_id, words, sequences(question, 4), sequences(answer, 3))


@dataclass
class Corpus:
    """What scores take from the whole benchmark: document frequencies, number of items, mean length."""
    df: dict[bytes, int]
    n: int
    mean: float

    @classmethod
    def of(cls, items: list[Item]) -> Corpus:
        df: dict[bytes, int] = {}
        for x in items:
            for w in set(x.words):
                df[w] = df.get(w, 0) + 1
        return cls(df, len(items), sum(len(x.words) for x in items) / len(items) if items else 1.0)


def stride_of(n: int) -> int:
    """The stride of the items of n words: the next power of two, LEAST_STRIDE at least."""
    return max(LEAST_STRIDE, 1 << (max(n, 1) - 1).bit_length())


class Index:
    """Inverted index of items of one length class; ``corpus``: of the whole benchmark (else these items)."""

    def __init__(self, items: list[Item], corpus: Corpus | None = None):
        items = [x for x in items if x.words]
        corpus = corpus or Corpus.of(items)
        held: dict[bytes, int] = {}
        for x in items:
            for w in set(x.words):
                held[w] = held.get(w, 0) + 1
        # items that share their most common word, so a language, and then a length, share blocks
        items.sort(key=lambda x: (max((held[w], w) for w in x.words), len(x.words)))
        self.items = items
        self.stride = stride_of(max((len(x.words) for x in items), default=0))
        self.terms: dict[bytes, int] = {}
        rows = []
        mean = corpus.mean
        for i, x in enumerate(items):
            counts: dict[bytes, int] = {}
            for w in x.words:
                counts[w] = counts.get(w, 0) + 1
            for w, tf in counts.items():
                t = self.terms.setdefault(w, len(self.terms))
                rows.append((t, i, tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(x.words) / mean))))
        rows.sort()
        term = np.array([r[0] for r in rows], dtype=np.int64)
        self.item = np.array([r[1] for r in rows], dtype=np.int64)
        part = np.array([r[2] for r in rows], dtype=np.float64)
        df = np.bincount(term, minlength=len(self.terms))
        self.posts = np.split(np.arange(len(rows)), np.cumsum(df)[:-1]) if len(rows) else []
        every = np.array([corpus.df[w] for w in self.terms], dtype=np.float64)  # in the order of their numbers
        part *= np.log1p((corpus.n - every + 0.5) / (every + 0.5))[term] if len(rows) else part
        own = np.bincount(self.item, part, len(items))  # a passage's terms count once
        self.impact = part / (TAU * own[self.item]) if len(rows) else part
        self.n_blocks = -(-len(items) // BLOCK_ITEMS)
        self.block_max = np.zeros((len(self.terms), self.n_blocks))
        np.maximum.at(self.block_max, (term, self.item // BLOCK_ITEMS), self.impact)
        self.top = self.block_max.max(axis=1) if len(rows) else np.zeros(0)

    def search(self, texts: list[list[bytes]]):
        """(text, first word, item, score) of all passages and items with a score of 1 or more."""
        get, s, n_terms = self.terms.get, self.stride, len(self.terms)
        pairs, base, starts_at = [], 0, []
        for words in texts:
            t = np.array([get(w, -1) for w in words], dtype=np.int64)
            at = np.flatnonzero(t >= 0)
            cell = base + 1 + at // s  # passage k holds strides k and k + 1
            pairs += [cell * n_terms + t[at], (cell - 1) * n_terms + t[at]]
            starts_at.append(base)
            base += len(words) // s + 2
        if not base or not self.items:
            return
        pair = np.unique(np.concatenate(pairs))
        passage, term = pair // n_terms, pair % n_terms
        keep = (np.bincount(passage, self.top[term], base) >= 1 - 1e-9)[passage]
        passage, term = passage[keep], term[keep]
        if not len(passage):
            return
        edges = np.r_[np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]), len(passage)]
        starts_at = np.array(starts_at)
        # as many passages at once as keep the sums of block maxima small
        part = np.flatnonzero(np.diff(edges[:-1] // max(1, CELLS // self.n_blocks), prepend=-1))
        for first, last in zip(part, np.r_[part[1:], len(edges) - 1], strict=True):
            edge, stop = edges[first:last], edges[last]
            blocks = np.add.reduceat(self.block_max[term[edge[0]:stop]], edge - edge[0], axis=0) >= 1 - 1e-9
            for j in np.flatnonzero(blocks.any(axis=1)):
                ts = term[edges[first + j]:edges[first + j + 1]]
                posts = np.concatenate([self.posts[t] for t in ts])
                posts = posts[blocks[j][self.item[posts] // BLOCK_ITEMS]]
                score = np.bincount(self.item[posts], self.impact[posts], len(self.items))
                k = int(passage[edge[j]])
                text = int(np.searchsorted(starts_at, k, side="right")) - 1
                for i in np.flatnonzero(score >= 1 - 1e-9):
                    yield text, (k - int(starts_at[text]) - 1) * s, int(i), float(score[i])

    def leaks(self, texts: list[list[bytes]]) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score as a share of the item's own, question and answer overlap), the best
        passage of each pair."""
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for k, at, i, score in self.search(texts):
            x, passage = self.items[i], texts[k][max(at, 0):at + 2 * self.stride]
            seen = {n: sequences(passage, n) for n in {len(next(iter(x.question))), len(next(iter(x.answer)))}}
            q = sum(g in seen[len(g)] for g in x.question) / len(x.question)
            a = sum(g in seen[len(g)] for g in x.answer) / len(x.answer)
            if q >= QUESTION and a >= ANSWER:
                best[k, i] = max(best.get((k, i), (0.0, 0.0, 0.0)), (score * TAU, q, a))
        return [(k, i, *v) for (k, i), v in sorted(best.items())]


class Shard:
    """The indexes of one shard of items, one per length class."""

    def __init__(self, items: list[Item], corpus: Corpus):
        by: dict[int, list[Item]] = {}
        for x in items:
            by.setdefault(stride_of(len(x.words)), []).append(x)
        self.indexes = [Index(by[s], corpus) for s in sorted(by)]
        self.items = [x for index in self.indexes for x in index.items]

    def leaks(self, texts: list[list[bytes]]) -> list[tuple[int, int, float, float, float]]:
        """``Index.leaks`` of all indexes; items are numbered as in ``items``."""
        out, before = [], 0
        for index in self.indexes:
            out += [(k, before + i, *rest) for k, i, *rest in index.leaks(texts)]
            before += len(index.items)
        return sorted(out)


def index_passes(benchmark: DataFrame):
    """Lists of shards, SHARDS_A_PASS at most, one list after the other: a pass over the documents for each.

    The benchmark is cut into words, its document frequencies are counted and its shards are dealt out
    in Spark; the driver holds the items and frequencies of one list at a time.  Scores take the document
    frequencies, the number of items and the mean length of the whole benchmark, so they do not depend on
    the shards."""
    spark = benchmark.sparkSession
    ready(spark)

    def cut(batches):
        for b in batches:
            words = [words_of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(w) for w in words], pa.int64()),
                 pa.array([sorted(set(w)) for w in words], pa.list_(pa.binary()))], ["item_id", "text", "n", "words"])

    kinds = schema(("item_id", benchmark.schema["item_id"].dataType), "text string, n long, words array<binary>")
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    items = written(spark, rows.mapInArrow(cut, kinds).where("n > 0"), "benchmark-items")
    n, mean, size = items.agg(F.count(F.lit(1)), F.avg("n"), F.sum(F.octet_length("text").cast("long"))).first()
    if not n:
        return
    shards = -(-max(n * SHARD_BYTES, size * SHARD_ITEMS) * 5 // (SHARD_ITEMS * SHARD_BYTES * 4))  # four fifths full each
    shards = 1 if n <= SHARD_ITEMS and size <= SHARD_BYTES else shards
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)))
    df = written(spark, items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df")),
                 "benchmark-words")
    for first in range(0, shards, SHARDS_A_PASS):
        here = items.where(F.col("shard").between(first, first + SHARDS_A_PASS - 1))
        held: dict[int, list[Item]] = {}
        for r in here.select("shard", "item_id", "text").collect():
            held.setdefault(r["shard"], []).append(item_of(r["item_id"], r["text"]))
        own = here.select(F.explode("words").alias("word")).distinct()
        corpus = Corpus({bytes(r["word"]): r["df"] for r in df.join(own, "word").collect()}, n, mean)
        order = lambda x: (str(x.item_id), x.words)
        yield [Shard(sorted(held[k], key=order), corpus) for k in sorted(held)]


def leaks_of(shards: list[Shard], texts: list[str | None]):
    """(text, item, score, question overlap, answer overlap) of a batch against each shard."""
    words = [words_of(t) for t in texts]
    for shard in shards:
        for k, i, *rest in shard.leaks(words):
            yield k, shard.items[i], *rest


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per document row and leaked item."""
    spark = docs.sparkSession
    ready(spark)
    out = schema(("doc_id", docs.schema["doc_id"].dataType), "score double, question_overlap double, answer_overlap double")
    ids = benchmark.schema["item_id"].dataType
    out = T.StructType([out.fields[0], T.StructField("item_id", ids), *out.fields[1:]])
    kind = to_arrow_type(ids)
    found = None
    for shards in index_passes(benchmark):
        def run(batches, shards=shards):  # Spark broadcasts a function that holds much
            for b in batches:
                rows = list(leaks_of(shards, b.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                     pa.array([r[1].item_id for r in rows], kind),
                     *(pa.array([r[n] for r in rows], pa.float64()) for n in (2, 3, 4))], out.names)

        part = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, out)
        # of several passes each is written, so that the driver lets go of its index
        found = part if found is None else written(spark, found, "leaks").unionByName(written(spark, part, "leaks"))
    return spark.createDataFrame([], out) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text holds no leaked item."""
    spark = docs.sparkSession
    ready(spark)
    passes = 0
    for shards in index_passes(benchmark):
        if passes:
            docs = written(spark, docs, "unleaked")
        passes += 1
        rows = docs.select(whole_row(docs), F.col("text").cast("string"))

        def run(batches, shards=shards):
            for b in batches:
                bad = {r[0] for r in leaks_of(shards, b.column(1).to_pylist())}
                yield b.select([0]).take(pa.array([k for k in range(b.num_rows) if k not in bad], pa.int64()))

        docs = rows.mapInArrow(run, rows.select("row").schema).select("row.*")
    return docs


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
