"""Every registered query against its DuckDB oracle on sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = "/root/testdata/sf0.01"
# The library's own queries; those of optional subpackages are tested beside them.
QUERIES, ORACLES = E._queries(), E._oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert compare(df, con, ORACLES[name]) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
