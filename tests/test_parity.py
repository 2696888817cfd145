"""Every registered query against its SQL twin on whole tables of the smallest sample."""

import pytest
from parity import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from funnelloom.catalog import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_sql(spark, con, key):
    _, _, problem = compare(spark, con, key, QUERIES[key], ORACLES.get(key), FOLDER)
    assert problem is None, problem


def test_every_query_has_an_oracle():
    """Of the library itself; the training-data operators state where SQL can't express them."""
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns[:5] == ["g", "c", "f", "fn", "p"]
    assert df.count() > 0
