"""A Merkle manifest of a dataset, its upper proofs gathered by butterfly exchange.

Every row is a leaf.  Per group (a source) the leaves stand in key order and are cut into blocks of
``fanout ** levels`` leaves, the partitions of the exchange; a block hashes its own subtree.  Then,
round by round, aligned groups of ``fanout`` subgroups of blocks swap the roots of their subtrees:
every block gets one root from each sibling subgroup (from the member at its own offset there, or at
that offset modulo the size of a smaller last subgroup), hashes the parent itself, redundantly, and
notes the siblings on its path.  After the last round every block holds its upper proof; nothing is
sent down the tree.  The group roots do the same among each other.

Leaves are placed without a window over a group: rows are range-partitioned by group, key and leaf,
and a row's position is its place in its partition plus the rows of its group in earlier ones.

Defined results: null fields are `-` in the leaf; rows without a group form a group of their own,
before all others; null keys come first in their group; rows with equal keys are ordered by leaf, so
repeated rows are leaves side by side; the last run of a level may be short, even one node, and is
hashed like others; a group of one leaf has that leaf as its root, and so has a dataset of one group;
extra columns are not read; an empty table gives an empty result.  Texts are hashed whole.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..operators.joins import join_small
from .common import crc32_sql, ready, schema, written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels that a block hashes by itself: it has FANOUT ** LEVELS leaves (729).
LEVELS = 6
PATH = "array<struct<before:string,after:string>>"


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field is `-` if null, else its UTF-8 byte count, `:` and its value."""
    parts = []
    for c in fields.values():
        s = c.cast("string")
        parts.append(F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path give."""
    return F.aggregate(path, start, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def _subtree(leaves: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of every level, leaves first; with ``levels`` None up to a single node."""
    out = [leaves]
    while len(out) - 1 < levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([hashlib.sha256("".join(below[i:i + fanout]).encode()).hexdigest()
                    for i in range(0, len(below), fanout)])
    return out


def _placed(spark: SparkSession, rows: DataFrame, size: int) -> DataFrame:
    """(grp, block, blocks, pos, ...) for rows (name, key, leaf, ...): grp numbers the groups by name,
    pos the leaves of a group, block = pos div size."""
    keys = ["name", "key", "leaf", "salt"]
    rows = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("salt")
            .withColumn("part", F.spark_partition_id())
            .withColumn("at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    rows = written(spark, rows, "merkle-sorted")
    # a row for each group of each partition; groups run on from one partition to the next
    runs = rows.groupBy("name", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    by_group = W.partitionBy("name")
    runs = (runs.withColumn("before", F.sum("n").over(by_group.orderBy("part")) - F.col("n"))
            .withColumn("leaves", F.sum("n").over(by_group)))
    runs = written(spark, runs, "merkle-runs")
    starts = runs.where("before = 0")
    # groups that start in earlier partitions: a row for each partition in this window
    earlier = (starts.groupBy("part").agg(F.count(F.lit(1)).alias("groups"))
               .select("part", (F.sum("groups").over(W.orderBy("part")) - F.col("groups")).alias("earlier")))
    numbers = (starts.join(earlier, "part")
               .select("name", (F.col("earlier") + F.row_number().over(W.partitionBy("part").orderBy("first")) - 1)
                       .alias("grp")))
    runs = runs.join(numbers, "name").select("name", "part", "grp", (F.col("before") - F.col("first")).alias("shift"),
                                             F.ceil(F.col("leaves") / size).alias("blocks"))
    pos = F.col("at") + F.col("shift")
    return (join_small(rows, runs, ["name", "part"]).withColumn("pos", pos)
            .withColumn("block", F.floor(pos / size)).drop("name", "part", "at", "shift"))


def exchange(state: DataFrame, fanout: int, most: int) -> DataFrame:
    """Butterfly rounds over (grp, block, blocks, digest, path), ``most`` the largest ``blocks``: every
    block ends with its group's root as digest and with all siblings above it on its path."""
    m = 1  # blocks under one node
    while m < most:
        base = F.col("block") - F.col("block") % (fanout * m)
        place = ((F.col("block") - base) / m).cast("int")
        offset = F.col("block") % m
        own_size = F.least(F.lit(m), F.col("blocks") - F.col("block") + offset)

        def receivers(d: int, base=base, offset=offset, own_size=own_size, m=m) -> Column:
            start = base + d * m
            size = F.least(F.lit(m).cast("long"), F.col("blocks") - start)
            return F.when((F.col("place") != d) & (offset < size),
                          F.transform(F.sequence(offset, size - 1, own_size.cast("long")), lambda x: start + x)
                          ).otherwise(F.array().cast("array<bigint>"))

        grows = F.col("blocks") > m
        sent = (state.withColumn("place", place)
                .withColumn("to", F.concat(F.array("block"), F.when(grows, F.concat(*map(receivers, range(fanout))))
                                           .otherwise(F.array().cast("array<bigint>"))))
                .select("grp", "blocks", "place", "digest", F.posexplode("to").alias("k", "target"), "path"))
        node = F.struct("place", "digest")
        got = (sent.groupBy("grp", F.col("target").alias("block"))
               .agg(F.max("blocks").alias("blocks"), F.max(F.when(F.col("k") == 0, F.col("place"))).alias("place"),
                    F.max(F.when(F.col("k") == 0, F.col("digest"))).alias("own"),
                    F.max(F.when(F.col("k") == 0, F.col("path"))).alias("path"),
                    F.array_sort(F.collect_list(node)).alias("run")))  # fanout nodes at most

        def joined(nodes: Column) -> Column:
            return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")
        step = F.struct(joined(F.filter("run", lambda x: x["place"] < F.col("place"))).alias("before"),
                        joined(F.filter("run", lambda x: x["place"] > F.col("place"))).alias("after"))
        state = got.select("grp", "block", "blocks",
                           F.when(grows, F.sha2(joined(F.col("run")), 256)).otherwise(F.col("own")).alias("digest"),
                           F.when(grows, F.array_append("path", step)).otherwise(F.col("path")).alias("path"))
        m *= fanout
    return state


def manifest(df: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source",
             carry: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per row: the key, leaf, subroot, root, the path from leaf to root, and the columns of
    ``carry`` (expressions over ``df``; keep them small, they move with the leaves)."""
    spark = df.sparkSession
    ready(spark)
    carry = carry or {}
    size = fanout ** levels
    name = F.col(f"`{group}`").cast("string")
    rows = df.select(F.coalesce(F.concat(F.lit("="), name), F.lit("-")).alias("name"),  # `-` sorts before `=`
                     F.col(f"`{key}`").alias("key"), leaf({c: F.col(f"`{c}`") for c in fields}).alias("leaf"),
                     F.monotonically_increasing_id().alias("salt"),
                     F.struct(F.lit(0).alias("none"), *[c.alias(n) for n, c in carry.items()]).alias("more"))
    rows = _placed(spark, written(spark, rows, "merkle-leaves"), size)
    blocks = written(spark, rows.groupBy("grp", "block").agg(
        F.max("blocks").alias("blocks"),
        F.array_sort(F.collect_list(F.struct("pos", "key", "leaf", "more"))).alias("rows")), "merkle-blocks")

    def roots(batches):
        for b in batches:
            digests = [_subtree(x, fanout, None if n == 1 else levels)[-1][0]
                       for n, x in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(digests, pa.string())],
                                             ["grp", "block", "blocks", "digest"])

    state = (blocks.select("grp", "block", "blocks", F.transform("rows", lambda x: x["leaf"]).alias("leaves"))
             .mapInArrow(roots, "grp long, block long, blocks long, digest string")
             .withColumn("path", F.array().cast(PATH)))
    most = blocks.agg(F.max("blocks"), F.max("grp")).first()
    state = written(spark, exchange(state, fanout, most[0] or 0), "merkle-state")
    n_groups = 0 if most[1] is None else most[1] + 1
    top = state.where("block = 0").select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("block"),
                                          F.lit(n_groups).cast("long").alias("blocks"), "digest",
                                          F.array().cast(PATH).alias("path"))
    top = exchange(top, fanout, n_groups).select(F.col("block").alias("grp"), F.col("digest").alias("root"),
                                                 F.col("path").alias("above"))
    upper = (join_small(state, top, ["grp"])
             .select("grp", "block", F.col("digest").alias("subroot"), "root",
                     F.concat("path", "above").alias("upper")))

    def paths(batches):
        for b in batches:
            for k in range(b.num_rows):
                blocks_of, held, upper = (b.column(c)[k] for c in ("blocks", "rows", "upper"))
                held, above = held.values, [(x["before"], x["after"]) for x in upper.as_py()]
                nodes = _subtree(held.field("leaf").to_pylist(), fanout, None if blocks_of.as_py() == 1 else levels)
                out = []
                for i in range(len(held)):
                    path, j = [], i
                    for level in nodes[:-1]:
                        s = j - j % fanout
                        path.append(("".join(level[s:j]), "".join(level[j + 1:s + fanout])))
                        j //= fanout
                    out.append([{"before": x, "after": y} for x, y in path + above])
                same = [pa.array([b.column(c)[k].as_py()] * len(held), pa.string()) for c in ("subroot", "root")]
                yield pa.RecordBatch.from_arrays(
                    [*(held.field(c) for c in ("key", "leaf", "more")), *same, pa.array(out, steps)],
                    ["key", "leaf", "more", "subroot", "root", "path"])

    steps = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
    held = {f.name: f.dataType for f in blocks.schema["rows"].dataType.elementType}
    out = schema(("key", held["key"]), "leaf string, subroot string, root string, path " + PATH)
    out = T.StructType([*out.fields[:2], T.StructField("more", held["more"]), *out.fields[2:]])
    found = (join_small(blocks.select("grp", "block", "blocks", "rows"), upper, ["grp", "block"])
             .mapInArrow(paths, out))
    return found.select(F.col("key").alias(key), "leaf", "subroot", "root", "path",
                        *[F.col(f"more.`{c}`").alias(c) for c in carry])


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, and the check of a copy some of whose texts lost their line ends."""
    from ..sources.tables import table
    docs = table(spark, sf_dir, "documents")
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    lost = F.when(number % 2 == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    altered = leaf({c: lost if c == "text" else F.col(c) for c in FIELDS})
    found = manifest(docs, carry={"altered": altered})
    return (found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         fold(F.col("altered"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(text if c == "text" else c) for c in FIELDS) + ")"


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT *, CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS lost
  FROM documents),
l AS (SELECT doc_id, coalesce('=' || source, '-') AS g, {_leaf_sql("text")} AS leaf, {_leaf_sql("lost")} AS altered FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
             dense_rank() OVER (ORDER BY g) - 1 AS grp FROM l),
n AS (SELECT grp, 0 AS lvl, pos, leaf AS h FROM p
  UNION ALL
  SELECT grp, max(lvl) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS c FROM n) WHERE c > 1 GROUP BY grp, pos // 3),
subs AS (SELECT grp, max_by(h, lvl) AS subroot, max(lvl) AS top FROM n GROUP BY grp),
t AS (SELECT 0 AS lvl, grp AS pos, subroot AS h FROM subs
  UNION ALL
  SELECT max(lvl) + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS c FROM t) WHERE c > 1 GROUP BY pos // 3),
r AS (SELECT max_by(h, lvl) AS root, max(lvl) AS top FROM t),
every AS (SELECT grp, lvl, pos, h FROM n UNION ALL SELECT -1, lvl, pos, h FROM t),
sides AS (
  SELECT grp, lvl, pos,
         coalesce(string_agg(h, '') OVER (PARTITION BY grp, lvl, pos // 3 ORDER BY pos
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER (PARTITION BY grp, lvl, pos // 3 ORDER BY pos
                                          ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM every),
f AS (SELECT grp, pos AS leaf_pos, 0 AS lvl, pos, altered AS h, '' AS proof FROM p
  UNION ALL
  SELECT f.grp, leaf_pos, f.lvl + 1, f.pos // 3, sha256(s.before || h || s.after), proof || s.before || s.after
  FROM f JOIN subs USING (grp) JOIN sides s ON s.grp = f.grp AND s.lvl = f.lvl AND s.pos = f.pos WHERE f.lvl < subs.top),
u AS (SELECT f.grp, leaf_pos, 0 AS lvl, f.grp AS pos, h, proof FROM f JOIN subs ON subs.grp = f.grp AND subs.top = f.lvl
  UNION ALL
  SELECT u.grp, leaf_pos, u.lvl + 1, u.pos // 3, sha256(s.before || h || s.after), proof || s.before || s.after
  FROM u, r, sides s WHERE s.grp = -1 AND s.lvl = u.lvl AND s.pos = u.pos AND u.lvl < r.top)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, u.h AS folded_root, u.h = root AS verified
FROM p JOIN subs USING (grp) JOIN u ON u.grp = p.grp AND u.leaf_pos = p.pos JOIN r ON u.lvl = r.top
"""
