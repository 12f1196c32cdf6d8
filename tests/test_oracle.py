"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally)."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from oracle_compare import compare, duck

SQLS = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF01), con, SQLS[name])
    assert ok, msg


def test_every_query_has_an_oracle():
    from derived_queries import QUERIES
    assert set(QUERIES) <= set(SQLS) and set(SQLS) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 25
    assert df.columns == ["counterparty_int", "total_trades", "breaks", "match_rate",
                          "total_break_value"]
    assert [r.breaks for r in rows] == sorted((r.breaks for r in rows), reverse=True)
