"""MinHash near-dedup with tensored banding, exact verification and connected components.

A document's set holds its distinct five-word shingles, lower-cased in A-Z; with fewer words the
whole sequence is the one shingle.  Documents with intersection / union >= 0.75 are linked.

1. Equal sets form one class (fingerprints of 128 bits over the sorted set); classes go on.
2. Two collections of ``HALF`` half keys, each of ``WIDE`` minhashes, give HALF x HALF tables: the
   key of table (i, j) combines half key i of one collection with j of the other, so 2 * HALF * WIDE
   minhashes serve where plain banding needs HALF * HALF * 2 * WIDE.  A pair at similarity s shares a
   table with probability (1 - (1 - s ** WIDE) ** HALF) ** 2, 0.9995 at 0.75.
3. Classes that share a key are compared with two of them (the most frequent one and the first in
   one order of all classes), never all with all; signatures drop hopeless pairs; the rest are verified on full sets.
4. Linked classes form components (alternating large-star and small-star rounds).
5. Keys whose classes still lie in several components are resolved: small ones by all pairs across
   components, large ones by prefix filtering (rare shingles first), which finds every pair at 0.75
   or more.  New links are verified on full sets and join components.

Tables cross stages as Parquet in the shared checkpoint folder; hot keys are combined before they
are shuffled and joined by skew-aware joins.  Nothing but scalars reaches the driver.

Defined results: without words or text a document has the empty set and is linked with nothing;
repeated rows are copies of each other; a component is named by its smallest doc_id, null ids left
out; a row without doc_id is kept only if no row of its component has one; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ready, schema, texts, whole_row, written

WORDS = 5
#: The link threshold, in percent.
PERCENT = 75
HALF, WIDE = 10, 2
N_HASHES = 2 * HALF * WIDE
#: Pairs with fewer equal minhashes are dropped: at 0.75, chance of fewer is below 2e-6.
LEAST_EQUAL = 17
#: Keys with at most so many classes are resolved by all pairs across components.
SMALL = 24
#: Bytes of text whose words are hashed together.
TOGETHER = 2 << 20
_RNG = np.random.default_rng(20240501)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = _RNG.integers(1, 1 << 63, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1, 1 << 63, N_HASHES, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_Q = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_S29, _S32 = np.uint64(29), np.uint64(32)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S32)) * _Q
    return h ^ (h >> _S29)


def shingle_sets(batch: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text, a few MB of text at a time."""
    out, at, size = [], 0, 0
    for k, b in enumerate(batch):
        size += len(b)
        if size >= TOGETHER or k == len(batch) - 1:
            out += _shingle_sets(batch[at:k + 1])
            at, size = k + 1, 0
    return out


def _shingle_sets(batch: list[bytes]) -> list[np.ndarray]:
    """Word hashes are differences of a running polynomial over all bytes of the batch; they do not
    depend on where a word stands, nor on the batch."""
    text = b"\n".join(batch).lower()
    sizes = np.array([len(b) + 1 for b in batch], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    if not text:
        return [np.zeros(0, np.uint64) for _ in batch]
    raw = np.frombuffer(text, dtype=np.uint8)
    space = _SPACE[raw]
    edge = np.diff(np.r_[True, space, True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = np.zeros(len(starts), dtype=np.uint64)
    step = 1 << 20  # the running sums are made for a piece of the text at a time, from word to word
    at = 0
    while at < len(starts):
        last = max(at + 1, int(np.searchsorted(ends, starts[at] + step, side="right")))
        low, high = int(starts[at]), int(ends[last - 1])
        power = np.full(high - low + 1, _P, dtype=np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        back = np.full(high - low + 1, _P_INV, dtype=np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        total = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[raw[low:high]] * power[:-1], dtype=np.uint64)])
        s, e = starts[at:last] - low, ends[at:last] - low
        words[at:last] = (total[e] - total[s]) * back[s] + (e - s).astype(np.uint64)
        at = last
    words = _mix(words)
    doc_first = np.searchsorted(starts, bounds)
    n = len(words) - WORDS + 1
    windows = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(WORDS):
        windows = windows * _P + words[k:k + n] if n > 0 else windows
    windows = _mix(windows)
    out = []
    for a, b in zip(doc_first[:-1], doc_first[1:], strict=True):
        if b - a >= WORDS:
            out.append(np.unique(windows[a:b - WORDS + 1]))
        elif b > a:
            h = np.full(1, b - a, dtype=np.uint64)
            for w in words[a:b]:
                h = h * _P + w
            out.append(_mix(h))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> np.ndarray:
    """N_HASHES minhashes of 32 bits."""
    low = np.full(N_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(s), 4096):
        h = s[k:k + 4096, None] * _MULT + _ADD
        low = np.minimum(low, (h ^ (h >> _S32)).min(axis=0))
    return (low >> _S32).astype(np.uint32).view(np.int32)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text), n_shingles, f1, f2 (fingerprint of the set), sig: one row per row."""
    ready(docs.sparkSession)

    def run(batches):
        for b in batches:
            sets = shingle_sets(texts(b.column(2)))
            prints = [np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([int(p[0]) for p in prints], pa.int64()), pa.array([int(p[1]) for p in prints], pa.int64()),
                 pa.array([signature(s).tolist() if len(s) else [] for s in sets], pa.list_(pa.int32()))],
                ["doc_id", "t", "n_shingles", "f1", "f2", "sig"])

    out = schema(("doc_id", docs.schema["doc_id"].dataType), "t long, n_shingles long, f1 long, f2 long, sig array<int>")
    body = F.col("text").cast("string")
    return docs.select("doc_id", F.xxhash64(body).alias("t"), body).mapInArrow(run, out)


def table_keys() -> F.Column:
    """All keys of a signature: each half key of the first collection with each of the second."""
    def half(side: int, i: int):
        at = (side * HALF + i) * WIDE
        return F.xxhash64(F.lit(side * HALF + i), *[F.col("sig")[at + k] for k in range(WIDE)])

    first, second = (F.array(*[half(side, i) for i in range(HALF)]) for side in (0, 1))
    return F.flatten(F.transform(first, lambda a: F.transform(second, lambda b: F.xxhash64(a, b))))


def alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures allow a link."""
    one = classes.select(F.col("c").alias("a"), F.col("sig").alias("sa"), F.col("n_shingles").alias("na"))
    two = classes.select(F.col("c").alias("b"), F.col("sig").alias("sb"), F.col("n_shingles").alias("nb"))
    both = pairs.join(one, "a").join(two, "b")
    same = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda p, x: p + x)
    fits = 100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb")
    return both.where(fits & (same >= LEAST_EQUAL)).select("a", "b")


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(c, set) of the classes in ``wanted``, from the text of the row that each one names."""
    one = wanted.select("c", F.col("doc_id").alias("i"), F.col("t").alias("h"), "f1", "f2")
    body = F.col("text").cast("string")
    rows = docs.select("doc_id", F.xxhash64(body).alias("t"), body.alias("text")).join(
        one, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("t") == F.col("h")))

    def run(batches):
        for b in batches:
            sets = shingle_sets(texts(b.column(3)))
            ok = [k for k, (s, x, y) in enumerate(zip(sets, b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True))
                  if (p := np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64))[0] == x and p[1] == y]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok, pa.int64())),
                                              pa.array([sets[k].tobytes() for k in ok], pa.binary())], ["c", "set"])

    out = rows.select("c", "f1", "f2", "text").mapInArrow(run, "c long, set binary")
    return out.dropDuplicates(["c"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    one = sets.select(F.col("c").alias("a"), F.col("set").alias("sa"))
    two = sets.select(F.col("c").alias("b"), F.col("set").alias("sb"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")

    def run(batches):
        for b in batches:
            ok = []
            for k, (x, y) in enumerate(zip(b.column(2), b.column(3), strict=True)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.concatenate([x, y])
                both.sort()
                n = int((both[1:] == both[:-1]).sum())
                if 100 * n >= PERCENT * (len(x) + len(y) - n):
                    ok.append(k)
            yield b.select([0, 1]).take(pa.array(ok, pa.int64()))

    return rows.mapInArrow(run, "a long, b long")


def components(links: DataFrame, name: str = "near-dup") -> DataFrame:
    """(c, root) of all nodes in ``links`` (a, b): alternating large-star and small-star rounds
    until the edges are those from every node to the smallest of its component."""
    spark = links.sparkSession

    def sums(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    def star(e: DataFrame, large: bool) -> DataFrame:
        ways = e.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            ways = ways.unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        far = ways.join(least, "u")
        if large:
            out = far.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = far.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = written(spark, edges, f"{name}-edges")
    before = sums(edges)
    while True:
        wide = star(edges, True)
        wide = wide.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges = written(spark, star(wide, False), f"{name}-edges")
        now = sums(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("c"), F.col("b").alias("root"))


def roots_of(classes: DataFrame, comps: DataFrame) -> DataFrame:
    """(c, root) of every class; a class without links is its own root."""
    return classes.select("c").join(comps, "c", "left").select("c", F.coalesce("root", "c").alias("root"))


def unresolved(met: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (key, c, n): pairs across components of small keys, and (c, root) of the classes of large
    keys; keys whose classes are all in one component are settled."""
    held = met.where("n > 2").select("key", "c", "n").join(roots, "c")
    mixed = held.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    held = written(met.sparkSession, held.join(mixed.select("key"), "key"), "near-dup-mixed")
    few = held.where(F.col("n") <= SMALL)
    x = few.select("key", F.col("c").alias("a"), F.col("root").alias("ra"))
    y = few.select("key", F.col("c").alias("b"), F.col("root").alias("rb"))
    pairs = x.join(y, "key").where("a < b and ra <> rb").select("a", "b").distinct()
    return pairs, held.where(F.col("n") > SMALL).select("c", "root").distinct()


def prefix_pairs(many: DataFrame, sets: DataFrame) -> DataFrame:
    """All pairs of ``many`` (c, root) in different components that can reach the threshold.

    In an order common to all sets, rare shingles first, the first shingle that two linked sets
    share cannot stand late in either; where it stands bounds the sizes of possible partners.  At
    each shingle the classes outside its most frequent component meet the others of those sizes."""
    spark = many.sparkSession

    def run(batches):
        for b in batches:
            for c, root, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                h = np.frombuffer(s.as_buffer(), dtype=np.int64)
                n = len(h)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, c)), pa.array(np.full(n, root)),
                                                  pa.array(np.full(n, n)), pa.array(h)], ["c", "root", "n", "h"])

    tokens = many.join(sets, "c").select("c", "root", "set").mapInArrow(run, "c long, root long, n long, h long")
    tokens = written(spark, tokens, "near-dup-tokens")
    often = tokens.groupBy("h").agg(F.count("*").alias("df"))
    ranked = tokens.join(often, "h").withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("df", "h")))
    # a pair needs P (n + m) / (100 + P) shared shingles, and from its first shared one, at rank r, none
    # of the sets has more than n - r + 1: that bounds the size of the other set
    least = F.ceil(F.col("n") * PERCENT / 100)
    most = F.least(F.floor(F.col("n") * 100 / PERCENT),
                   F.floor((F.col("n") - F.col("r") + 1) * ((100 + PERCENT) / PERCENT)) - F.col("n"))
    prefix = ranked.where(F.col("df") > 1).withColumn("least", least).withColumn("most", most).where("most >= least")
    prefix = written(spark, prefix.select("h", "c", "root", "n", "least", "most"), "near-dup-prefix")
    per_root = prefix.groupBy("h", "root").agg(F.count("*").alias("k"))
    main = per_root.groupBy("h").agg(F.max_by("root", F.struct("k", "root")).alias("main"),
                                     F.count("*").alias("roots")).where("roots > 1")
    there = prefix.join(main.select("h", "main"), "h")

    def size_class(n: str):
        return F.floor(F.log(F.col(n)) / F.log(F.lit(1.05)) + 1e-9)

    x = there.where("root <> main").select(
        "h", F.explode(F.sequence(size_class("least"), size_class("most"))).alias("s"),
        F.col("c").alias("a"), F.col("root").alias("ra"), F.col("n").alias("na"), "least", "most")
    y = there.select("h", size_class("n").alias("s"), F.col("c").alias("b"), F.col("root").alias("rb"),
                     F.col("n").alias("nb"), F.col("least").alias("lb"), F.col("most").alias("mb"))
    met = x.join(y, ["h", "s"]).where("ra <> rb and nb between least and most and na between lb and mb")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes_of(rows: DataFrame) -> DataFrame:
    """One row per set: c (a hash of the fingerprint), doc_id (the smallest; null if none) and text hash
    of a row that has it, copies, sig."""
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t")).alias("at")
    full = rows.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(
        least, F.count("*").alias("copies"), F.first("sig").alias("sig"))
    return full.select(F.xxhash64("f1", "f2", "n_shingles").alias("c"), "n_shingles", "f1", "f2", "at.doc_id", "at.t",
                       "copies", "sig")


def shared_keys(classes: DataFrame) -> DataFrame:
    """(key, c, n, p1, p2) of all keys that several classes share: their number, the most frequent
    of them and the first in one order."""
    # a class becomes HALF * HALF rows: dealt out first, so that no task counts too many keys
    dealt = classes.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "c")
    keys = dealt.select("c", "copies", F.explode(table_keys()).alias("key"))
    order = F.xxhash64("c")  # one order for all keys: a class meets the same few others again and again
    first = F.col("copies") + F.pmod(order, F.lit(1 << 20)) / float(1 << 20)
    shared = keys.groupBy("key").agg(F.count("*").alias("n"), F.max_by("c", first).alias("p1"),
                                     F.min_by("c", order).alias("p2")).where("n > 1")
    return keys.select("key", "c").join(shared, "key")


def verdicts(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text), n_shingles, root (of the component; null for an empty set), component_id,
    kept: one row per document row."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = written(spark, sketches(docs), "near-dup-rows")
    classes = written(spark, classes_of(rows), "near-dup-classes")
    met = written(spark, shared_keys(classes), "near-dup-keys")
    stars = met.select("c", F.explode(F.array("p1", "p2")).alias("p")).where("c <> p")
    stars = stars.select(F.least("c", "p").alias("a"), F.greatest("c", "p").alias("b")).distinct()
    stars = written(spark, alike(stars, classes), "near-dup-pairs")
    need = stars.select(F.explode(F.array("a", "b")).alias("c"))
    need = need.union(met.where(F.col("n") > SMALL).select("c")).distinct()
    sets = written(spark, class_sets(docs, classes.join(need, "c")), "near-dup-sets")
    links = written(spark, verified(stars, sets), "near-dup-links")
    pairs, many = unresolved(met, roots_of(classes, components(links)))
    pairs = pairs.unionByName(prefix_pairs(many, sets)).distinct().join(stars, ["a", "b"], "left_anti")
    pairs = written(spark, alike(pairs, classes), "near-dup-pairs")
    need = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct().join(sets, "c", "left_anti")
    more = written(spark, class_sets(docs, classes.join(need, "c")), "near-dup-sets")
    links = links.unionByName(verified(pairs, sets.unionByName(more)))
    named = classes.join(roots_of(classes, components(links)), "c")
    named = named.join(named.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root")
    named = named.select("n_shingles", "f1", "f2", "root", "component_id")
    out = rows.select("doc_id", "t", "n_shingles", "f1", "f2").join(named, ["n_shingles", "f1", "f2"], "left")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", "t", "n_shingles", "root", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document row."""
    return verdicts(docs).drop("t", "root")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, less near duplicates: of each component one row stays, that of
    the smallest doc_id (nulls last), then of the smallest text hash; rows with an empty set are linked with nothing
    and all stay."""
    each = verdicts(docs).groupBy("doc_id", "t").agg(F.count("*").alias("n"), F.first("root").alias("root"))
    each = written(docs.sparkSession, each, "near-dup-kept")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("i"), "t", "n")).alias("at")
    kept = each.where("root is not null").groupBy("root").agg(least).select("at.i", "at.t", "at.n")
    kept = written(docs.sparkSession, kept, "near-dup-kept")
    empty = each.where("root is null").select(F.col("doc_id").alias("i"), "t", F.lit(1).cast("long").alias("n"))
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("h"), whole_row(docs))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("t"))
    once = rows.join(kept.where("n = 1").unionByName(empty), same, "left_semi")
    if kept.where("n > 1").limit(1).count():
        again = rows.join(kept.where("n > 1"), same, "left_semi").dropDuplicates(["id", "h"])
        once = once.unionByName(again)
    return once.select("row.*")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return near_duplicates(table(spark, sf_dir, "documents"))
