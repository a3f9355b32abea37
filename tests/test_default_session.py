"""Queries in a session with Spark's own defaults, as a caller's session may have them."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
DEFAULTS = {
    "spark.sql.sources.partitionOverwriteMode": "STATIC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}


@pytest.fixture
def plain(spark):
    own = {key: spark.conf.get(key) for key in DEFAULTS}
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in own.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["current_state_incremental", "dq_report_from_states", "stream_incidents_timed"])
def test_query(plain, name):
    found = entry.queries()[name](plain, SF_DIR)
    assert difference(found, connect(SF_DIR), entry.oracle_sql()[name]) is None
    assert {key: plain.conf.get(key) for key in DEFAULTS} == DEFAULTS
