import hashlib

import pytest
from pyspark.sql import functions as F

from lexitrend.llm import merkle_manifest as M

from .conftest import words

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf_of(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path_of(levels, i, fanout):
    path = []
    for level in levels[:-1]:
        s = i - i % fanout
        path.append(("".join(level[s:i]), "".join(level[i + 1:s + fanout])))
        i //= fanout
    return path


def brute(rows, fanout):
    """Sorted (doc_id, leaf, subroot, root, path) of all rows."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels_of([x[2] for x in groups[g]], fanout)
    top = levels_of([trees[g][-1][0] for g in names], fanout)
    out = []
    for k, g in enumerate(names):
        for i, (_, _, leaf, doc) in enumerate(groups[g]):
            path = path_of(trees[g], i, fanout) + path_of(top, k, fanout)
            out.append((doc, leaf, trees[g][-1][0], top[-1][0], path))
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], [(x["before"], x["after"]) for x in r["path"]])
                   for r in df.collect()), key=str)


def rows_of(sizes):
    """Groups of these sizes, one without a name, with repeated rows, null ids and null fields."""
    out, k = [], 0
    for g, n in enumerate(sizes):
        for i in range(n):
            k += 1
            out.append((k * 37 % 1009, None if g == 1 else f"s{g * 7 % 10}é", "en" if i % 3 else None, i, " ".join(words(2, k))))
    return out + out[:3] + out[:1] + [(None, "s0é", None, None, None), (None, "s0é", "de", None, ""), (5, "", None, 1, None)]


@pytest.mark.parametrize("fanout,levels,sizes", [(3, 0, (1, 2, 100)), (3, 1, (82, 27, 1, 10, 9, 3)), (2, 1, (33, 5, 64)),
                                                 (5, 1, (130, 25, 26)), (3, 6, (40, 3, 1)), (3, 2, (250,))])
def test_equals_brute_force(spark, fanout, levels, sizes):
    rows = rows_of(sizes)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = M.manifest(df, fanout=fanout, levels=levels)
    assert found(got) == brute(rows, fanout)


def test_folds_and_proofs(spark):
    rows = rows_of((30, 4))
    df = spark.createDataFrame(rows, SCHEMA)
    got = (M.manifest(df, levels=1, carry={"other": F.sha2(F.lit("x"), 256)})
           .select("root", M.fold(F.col("leaf"), F.col("path")).alias("f"), M.fold(F.col("other"), F.col("path")).alias("g"),
                   "path", M.proof_digest(F.col("path")).alias("p")).collect())
    for r in got:
        assert r["f"] == r["root"] != r["g"]
        assert r["p"] == H("".join(x["before"] + x["after"] for x in r["path"]))


def test_one_row_and_one_group(spark):
    row = (7, "a", "en", 3, "abc")
    r, = M.manifest(spark.createDataFrame([row], SCHEMA)).collect()
    assert r["leaf"] == r["subroot"] == r["root"] == leaf_of(row) and r["path"] == []


def test_empty_table_and_clashing_columns(spark):
    names = ["name", "key", "salt", "part", "at", "grp", "block", "blocks", "pos", "leaf", "more", "path", "a.b c"]
    df = spark.createDataFrame([], SCHEMA + "".join(f", `{n}` string" for n in names))
    assert M.manifest(df).collect() == []
    rows = rows_of((12,))
    df = spark.createDataFrame([(*r, *names) for r in rows], SCHEMA + "".join(f", `{n}` string" for n in names))
    assert found(M.manifest(df, levels=1)) == brute(rows, 3)


def test_string_keys_and_long_texts(spark):
    rows = [(f"k{i}", "s", "en", i, "x\n" * 200_000) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA.replace("doc_id long", "doc_id string"))
    got = M.manifest(df).collect()
    assert {r["doc_id"]: r["leaf"] for r in got} == {r[0]: leaf_of(r) for r in rows}


def test_exchange_moves_few_rows(spark):
    """A round sends each block one root from each sibling subgroup, and no more."""
    state = spark.range(100).select(F.lit(0).cast("long").alias("grp"), F.col("id").alias("block"),
                                    F.lit(100).cast("long").alias("blocks"), F.sha2(F.col("id").cast("string"), 256)
                                    .alias("digest"), F.array().cast(M.PATH).alias("path"))
    got = M.exchange(state, 3, 100).collect()
    tree = levels_of([H(str(i)) for i in range(100)], 3)
    assert len(got) == 100 and {r["digest"] for r in got} == {tree[-1][0]}
    for r in got:
        assert [(x["before"], x["after"]) for x in r["path"]] == path_of(tree, r["block"], 3)
