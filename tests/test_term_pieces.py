"""Term counts whose tasks are bounded."""

import re

from lexitrend.operators import terms as TM


def test_term_counts_in_many_partitions(spark, monkeypatch):
    rows = [(i, 2020, ["cs", "math"] if i % 3 else ["cs"], f"alpha beta gamma delta {'alpha beta' if i % 2 else 'the of'}")
            for i in range(40)] + [(7, 2020, ["cs", "math"], "alpha beta"), (50, 2020, [], "alpha beta gamma")]
    clean = spark.createDataFrame(rows, "id long, year int, domains array<string>, clean string")
    one = sorted(map(tuple, TM.term_year_counts(clean).collect()))
    monkeypatch.setattr(TM, "PIECE", 100)
    monkeypatch.setattr(TM, "TERMS_AT_ONCE", 5)
    many = TM.term_year_counts(clean)
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert max(int(x) for x in re.findall(r"hashpartitioning\(id#\d+L?, (\d+)\)", plan)) > 4
    assert sorted(map(tuple, many.collect())) == one
    # no aggregate on (paper, term): papers are counted where they are; a repeated id is one paper
    assert not re.search(r"keys=\[id#[^\]]*term#", plan)
    assert ("cs", 2020, 1, "alpha", 40 + 20 + 1, 40) in one and ("cs", 2020, 2, "alpha beta", 61, 40) in one
