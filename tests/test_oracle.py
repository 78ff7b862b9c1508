"""Every registered query against its DuckDB oracle (sf0.001; the driver
checks sf0.01 the same way)."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck_connection
from conftest import SF_SMALL, library_queries


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", library_queries())
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(spark, SF_SMALL, key, con)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(library_queries()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"from", "to", "value", "evt_hash"} <= set(df.columns)
