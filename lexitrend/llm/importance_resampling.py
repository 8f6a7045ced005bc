"""Target-distribution importance resampling: draw the documents most like a target corpus.

Features are runs of words, hashed into buckets; their counts over all documents and over the
target give each bucket a gain, an array of integers, and a document's weight is the floored mean
of its features' gains.  Buckets of every document are written once, as arrays, and both the counts
and the weights come from them.  A seeded Gumbel term per document turns the highest scores into a
weighted draw without replacement.

The draw: numeric bisection of the score by repeated exact count jobs over the persisted scores
finds the lowest score drawn; among rows tied at it the same bisection over doc_id, and for repeated
ids over the row's number, finds where the draw ends.  Only the drawn rows are then range-partitioned
for their ranks; no sort or window sees all rows.

Defined results: null texts have no words; a text without features weighs 0; null doc_ids are hashed
as the empty string, and come last among ties; repeated rows are drawn one by one, in the order they
were read; extra columns are not read; an empty table gives an empty result; an empty target gives
gains from the documents alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc32_sql, ready, schema, texts, written

BUCKETS = 10_000
#: Shortest and longest run of words.
RUNS = (1, 1)
SEED = 2024
#: Words that a document must have to be drawn, and the percentage that is drawn.
LEAST_WORDS, PERCENT = 20, 10
#: Distinct words that a worker remembers the bucket of; the cache is emptied when full.
CACHE = 500_000
#: Bytes of text that are cut into words at once, unless one word is longer.
BLOCK = 1 << 22
#: Lower case for A-Z, white space for other ASCII characters that are not letters or digits.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


class _Buckets(dict):
    """Word -> bucket, computed at the first use."""

    def __init__(self, n: int):
        self.n = n

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = k = zlib.crc32(word) % self.n
        return k


def words_of(text: bytes):
    """Blocks of words of a text's UTF-8 bytes: lower-cased A-Z, cut at ASCII other than letters and digits."""
    text, at = text.translate(_LETTERS), 0
    while at < len(text):
        end = text.find(b" ", at + BLOCK)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS,
             runs: tuple[int, int] = RUNS) -> DataFrame:
    """(key, n_words, n_features, buckets): the bucket of every feature of a text, repeats included, as
    little-endian unsigned 32-bit integers."""
    ready(docs.sparkSession)

    def run(batches):
        known = _Buckets(buckets)
        for b in batches:
            n_words, found = [], []
            for t in texts(b.column(1)):
                parts, last, n = [], [], 0
                for block in words_of(t):
                    n += len(block)
                    for size in range(runs[0], runs[1] + 1):
                        if size == 1:
                            ids = [known[w] for w in block]
                        else:  # runs that end in this block
                            held = last[len(last) - size + 1 if len(last) >= size else 0:] + block
                            ids = [zlib.crc32(b" ".join(held[i:i + size])) % buckets for i in range(len(held) - size + 1)]
                        parts.append(np.array(ids, dtype="<u4").tobytes())
                    if runs[1] > 1:
                        last = (last + block)[1 - runs[1]:]
                n_words.append(n)
                found.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array([len(x) // 4 for x in found], pa.int64()),
                 pa.array(found, pa.binary())], ["key", "n_words", "n_features", "buckets"])

    out = schema(("key", docs.schema[key].dataType), "n_words long, n_features long, buckets binary")
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).mapInArrow(run, out)


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features fall in each bucket: a row for each bucket of each task, then one for each
    bucket (``buckets`` numbers on the driver)."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(x, dtype="<u4"), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for r in (found.select("buckets").mapInArrow(run, "bucket long, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target share and source share) of each bucket."""
    s, t, n = source.astype(np.float64), target.astype(np.float64), float(len(source))
    ratio = (t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(key, n_words, n_features, weight): the floored mean of the gains of a text's features, 0 without any."""
    shared = found.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        table = shared.value
        for b in batches:
            sums = [int(table[np.frombuffer(x, dtype="<u4")].sum()) for x in b.column(3).to_pylist()]
            weight = [s // n if n else 0 for s, n in zip(sums, b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(weight, pa.int64())],
                                             ["key", "n_words", "n_features", "weight"])

    out = schema(("key", found.schema["key"].dataType), "n_words long, n_features long, weight long")
    return found.mapInArrow(run, out)


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln(u))) for u in (0, 1) from the first 32 bits of sha256(`seed:key`)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _least_cut(rows: DataFrame, value: str, k: int) -> tuple[int, int]:
    """The least value v such that at least ``k`` rows have ``value`` <= v, and how many have less:
    bisection of the range, an exact count job a step.  There are ``k`` rows or more, ``k`` > 0."""
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    below = 0  # rows under lo
    while lo < hi:
        mid = (lo + hi) // 2
        n = rows.where(F.col(value) <= mid).count()
        if n >= k:
            hi = mid
        else:
            lo, below = mid + 1, n
    return lo, below


def draw(scored: DataFrame, k: int, eligible: Column) -> Column | None:
    """A condition for the ``k`` eligible rows with the highest ``score``, ties to the smaller ``place``
    (nulls last), then to the smaller ``number``.  ``scored`` is read once a step: pass a written table."""
    rows = scored.where(eligible).select(F.negative("score").alias("low"), F.col("place").isNull().cast("int").alias("none"),
                                         F.coalesce("place", F.lit(0).cast("long")).alias("place"), "number")
    keys = {"low": F.negative("score"), "none": F.col("place").isNull().cast("int"),
            "place": F.coalesce("place", F.lit(0).cast("long")), "number": F.col("number")}
    if k <= 0:
        return None
    tied, drawn = F.lit(True), F.lit(False)
    for name, c in keys.items():
        cut, below = _least_cut(rows, name, k)
        drawn = drawn | (tied & (c < cut))
        tied = tied & (c == cut)
        rows = rows.where(F.col(name) == cut)
        k -= below
        if rows.count() == k:
            break
    return eligible & (drawn | tied)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             buckets: int = BUCKETS, runs: tuple[int, int] = RUNS, seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """Every row's key, n_words, n_features, weight, score and rank (1 for the highest score; null if not drawn).
    Of the rows with ``least_words`` words or more, floor(percent * n / 100) are drawn.  Integer keys order
    ties by their value; others by the value's text hashed to 64 bits."""
    spark = docs.sparkSession
    ready(spark)
    found = written(spark, features(docs, key, text, buckets, runs), "resample-features")
    aims = target.select(F.lit(0).alias("key"), F.col(f"`{target_text}`").alias("text"))
    gain = gains(bucket_counts(found, buckets), bucket_counts(features(aims, "key", "text", buckets, runs), buckets))
    integer = isinstance(docs.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    place = F.col("key").cast("long") if integer else F.when(F.col("key").isNotNull(), F.xxhash64(F.col("key").cast("string")))
    scored = written(spark, weighted(found, gain).select(
        "*", (F.col("weight") + gumbel(F.col("key"), seed)).alias("score"), place.alias("place"),
        F.monotonically_increasing_id().alias("number")), "resample-scores")
    eligible = F.col("n_words") >= least_words
    condition = draw(scored, percent * scored.where(eligible).count() // 100, eligible)
    columns = [F.col("key").alias(key), "n_words", "n_features", "weight", "score"]
    if condition is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    order = [F.desc("score"), F.asc_nulls_last("place"), F.asc("number")]
    drawn = (scored.where(condition).repartitionByRange(*order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id())
             .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    drawn = written(spark, drawn, "resample-drawn")
    before, shift = 0, F.lit(0).cast("long")
    starts = []
    for part, n in sorted(drawn.groupBy("part").count().collect()):  # a row for each partition
        starts += [F.lit(part), F.lit(before)]
        before += n
    if starts:
        shift = F.create_map(*starts)[F.col("part")]
    ranked = drawn.select(*columns, (F.col("at") + 1 + shift).cast("long").alias("rank"))
    rest = scored.where(~condition).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(rest)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, coalesce({_WORDS}, []) AS w FROM documents),
dw AS (SELECT k, unnest(w) AS word FROM d),
bw AS (SELECT unnest(coalesce({_WORDS}, [])) AS word FROM benchmark),
v AS (SELECT word, {crc32_sql("word")} % 10000 AS b FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
s AS (SELECT b, count(*) AS s FROM dw JOIN v USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM bw JOIN v USING (word) GROUP BY b),
g AS (SELECT b, CAST(floor(1000 * ln(((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM dw) + 10000))
                                    / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM bw) + 10000)))) AS BIGINT) AS gain
      FROM s FULL JOIN t USING (b)),
x AS (SELECT k, sum(gain)::BIGINT AS total, count(*) AS n FROM dw JOIN v USING (word) JOIN g USING (b) GROUP BY k),
y AS (SELECT k, doc_id, coalesce(n, 0)::BIGINT AS n_features,
             coalesce((total - ((total % n) + n) % n) // n, 0)::BIGINT AS weight,
             CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h
      FROM d LEFT JOIN x USING (k)),
z AS (SELECT k, doc_id, n_features, weight,
             weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
             count(*) OVER (PARTITION BY n_features >= 20) AS n FROM z)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM r
"""
