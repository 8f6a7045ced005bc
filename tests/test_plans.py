"""Plan-shape checks for the scale properties the README claims."""

import re

import __spark_entry__ as E

from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_a_partial_group_limit(spark):
    p = plan(E.queries()["e6_top_trends"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p
    p4 = plan(E.queries()["e4_bell_volume"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p4


def test_domain_totals_join_is_broadcast(spark):
    from lexitrend.operators import trends as T
    from lexitrend.plans import standins as S
    p = plan(T.normalized_long(S.term_year(spark, SF_SMALL), S.domain_year(spark, SF_SMALL)))
    assert "BroadcastHashJoin" in p
    # no shuffle keyed by (category, year) alone
    assert not re.search(r"hashpartitioning\(category#\d+L?, year#\d+L?, \d+\)", p)


def test_term_counts_shuffle_text_not_ngrams(spark):
    p = plan(E.queries()["c4_term_year_counts"](spark, SF_SMALL))
    parts = re.findall(r"Exchange (hashpartitioning\([^)]*\))", p)
    keyed_by_id = [x for x in parts if re.match(r"hashpartitioning\(id#\d+L?, \d+\)", x)]
    assert len(keyed_by_id) == 1                      # the papers, once
    assert not [x for x in parts if "id#" in x and "term#" in x]  # no per-paper n-gram shuffle
    assert any("term#" in x and "category#" in x for x in parts)  # one shuffle on the term key
    assert "partial_sum" in p and "partial_count" in p


def test_scans_are_pruned(spark):
    from lexitrend.plans import standins as S
    p = plan(S.term_year(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert "struct<l_partkey:bigint,l_shipdate:timestamp_ntz>" in schemas
    assert "struct<p_partkey:bigint,p_name:string,p_type:string>" in schemas
    txt = plan(E.queries()["d1_monthly_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in txt
