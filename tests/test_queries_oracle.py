"""Every registered query against its DuckDB oracle on the smallest tables
(the same comparison the correctness gate runs at sf0.01)."""

import duckdb
import pytest

import __spark_entry__ as E
from lexitrend.plans import registry
from lexitrend.sources.tables import TABLES
from tools.check_oracle import digest

from .conftest import SF_SMALL

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["category", "term", "slope", "intercept", "r2", "current_norm", "rank"]
    assert len(rows) >= 0


OWN = sorted(registry.QUERIES)  # those outside the optional subpackage


def test_every_query_has_oracle():
    assert set(OWN) == set(registry.ORACLE) and set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    con.execute(f"CREATE OR REPLACE VIEW oracle_view AS {SQL[name]}")  # must be one plain SELECT
    res = con.execute("SELECT * FROM oracle_view")
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
