"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from tools.oracle_check import compare, duck_connect

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF_SMALL, con)
    if SQL.get(name) is None:
        assert r["spark_rows"] > 0
    else:
        assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["bucket", "slot", "sip", "dip", "sport", "dport", "proto", "c"]
