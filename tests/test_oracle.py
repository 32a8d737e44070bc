"""Every driver query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as E
from tamarind.queries.catalog import all_oracles, all_queries
from tamarind.queries.compare import compare, duck

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_dir, con, name):
    assert name in ORACLES, "every query of the library has an oracle"
    res = compare(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir, con)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "dwh_crtd_dttm"
