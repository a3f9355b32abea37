"""Queries over what only larger tables hold: large keys, several samples in one millisecond."""

from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from oracle import difference

import __spark_entry__ as entry


def against_sql(spark, folder, name, table, ddl, rows):
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{table}.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    # One thread: which of several largest values an arg_max takes hangs on the threads otherwise.
    con.execute("SET threads=1")
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    return difference(entry.queries()[name](spark, folder), con, entry.oracle_sql()[name])


@pytest.mark.parametrize("keys", [(99, 9_999, 99_999), (100_000, 150_000, 899_999, 123_456_789)])
def test_numbers_beyond_a_thousand_thousands(spark, folder, keys):
    rows = [(n, key) for n, key in enumerate(keys)]
    assert against_sql(spark, folder, "humanized_values", "orders", "o_orderkey long, o_custkey long", rows) is None


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
KINDS = ("click", "view", "signup", "purchase", "error")


@pytest.mark.parametrize(
    "name",
    ["values_at_steps", "rule_values", "threshold_rules", "no_data_policy", "rule_errors", "rule_transitions", "instant_vector"],
)
def test_of_samples_in_one_millisecond_the_first_counts(spark, folder, name):
    # Two events of every kind at a time, the later of them with the smaller value in every second case.
    # The mark of `instant_vector` is on day 14.
    start, rows = datetime(2024, 1, 14, 22, tzinfo=timezone.utc), []
    for n in range(200):
        at = start + timedelta(seconds=30 * n)
        first, second = (5.0, 45.0) if n % 4 < 2 else (45.0, 5.0)
        # Equal remainders of 2, 3, 4 and 7 give both the same labels.
        rows.append((84 * n + n % 4, at + timedelta(microseconds=700), n % 3, KINDS[n % 5], first, "{}"))
        rows.append((84 * n + 84 * 400 + n % 4, at + timedelta(microseconds=100), n % 3, KINDS[n % 5], second, "{}"))
    assert against_sql(spark, folder, name, "events", EVENTS, rows) is None
