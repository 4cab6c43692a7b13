"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from suite.compare import difference, duck
from suite.registry import ORACLES, QUERIES

entry.queries()  # fills the registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, sf_dir, key):
    assert difference(spark, con, sf_dir, QUERIES[key], ORACLES[key]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "documents_synced" in df.columns
