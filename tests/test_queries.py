"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tidemark.plans import all_queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


def test_every_query_has_sql():
    assert not set(all_queries()) - set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry_returns_the_mart(spark):
    mart = entry.entry(spark)
    assert mart.count() > 0
    assert "category" in mart.columns
