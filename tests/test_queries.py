"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry
from rillmark.plans.catalog.registry import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
# The training-data queries have tests of their own.
QUERIES = {name: entry.queries()[name] for name in all_queries()}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}
# These may find nothing in the small tables.
MAY_BE_EMPTY = {"stream_sustained", "series_ratio", "metric_age", "vector_join", "scalar_join"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, con, ORACLE[name]) is None
    assert name in MAY_BE_EMPTY or not df.isEmpty()


def test_flagship(spark):
    if not os.path.isdir(entry.SMOKE_DIR):
        pytest.skip("no smoke tables")
    assert entry.entry(spark).count() > 0
