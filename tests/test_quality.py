import pytest
from pyspark.sql import functions as F

from rillmark.functions.severity import scoped_severity
from rillmark.operators import alerts, quality
from rillmark.spec import CheckSpec

NOW = 1_700_000_000_000
SCHEMA = "order_id int, ship_city string, cdc_op string, cdc_ts_ms long"


def report(spark, rows, as_of=NOW, keys=("order_id",), schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    return {r["check_name"]: r for r in quality.dq_report(df, list(keys), as_of, **kw).collect()}


def test_valid_rows_pass_all_checks(spark):
    got = report(spark, [(i, "x", "cur"[i % 3], NOW - 1000) for i in range(6)])
    assert set(got) == {"non_empty", "null_pk:order_id", "unique_pk:order_id", "valid_cdc_op", "freshness"}
    assert all(r["passed"] and r["severity"] is None for r in got.values())


def test_all_null_keys_are_critical(spark):
    got = report(spark, [(None, "x", op, NOW) for op in "curcu"])
    bad = got["null_pk:order_id"]
    assert (bad["violation_rows"], bad["total_rows"]) == (5, 5)
    assert (bad["severity"], bad["sev_label"], bad["violation_pct"]) == ("critical", "SEV-1", "100.00%")
    # Null keys are no repeated keys.
    assert got["unique_pk:order_id"]["passed"]


def test_repeated_keys(spark):
    rows = [(1, "a", "c", NOW), (1, "b", "u", NOW), (2, "c", "c", NOW)]
    bad = report(spark, rows)["unique_pk:order_id"]
    assert (bad["violation_rows"], bad["severity"]) == (2, "critical")
    rows += [(i, "d", "c", NOW) for i in (3, 4, 5)]
    assert report(spark, rows)["unique_pk:order_id"]["severity"] == "error"


def test_invalid_operation(spark):
    bad = report(spark, [(1, "a", "d", NOW), (2, "b", "c", NOW)])["valid_cdc_op"]
    assert (bad["violation_rows"], bad["severity"]) == (1, "error")
    # A null operation passes.
    assert report(spark, [(1, "a", None, NOW)])["valid_cdc_op"]["passed"]


def test_empty_batch_stops_later_checks(spark):
    got = report(spark, [])
    assert list(got) == ["non_empty"]
    assert (got["non_empty"]["severity"], got["non_empty"]["violation_pct"]) == ("error", "N/A")


@pytest.mark.parametrize("age_s,passed", [(900, True), (901, False)])
def test_freshness_limit_is_inclusive(spark, age_s, passed):
    got = report(spark, [(1, "a", "c", NOW - age_s * 1000)])["freshness"]
    assert got["passed"] is passed
    assert got["severity"] == (None if passed else "warning")


def test_composite_key_reports_the_null_column_only(spark):
    rows = [(1, None, "c", NOW), (1, 2, "c", NOW)]
    got = report(spark, rows, keys=("a", "b"), schema="a int, b int, cdc_op string, cdc_ts_ms long")
    assert got["null_pk:a"]["passed"] and not got["null_pk:b"]["passed"]
    assert "unique_pk:a+b" in got


def test_absent_columns_leave_their_checks_out(spark):
    got = report(spark, [(1,)], schema="order_id int")
    assert set(got) == {"non_empty", "null_pk:order_id", "unique_pk:order_id"}


CASES = [
    ("null_pk", 5, 5, "critical", "SEV-1"),
    ("null_pk", 2, 5, "error", "SEV-2"),
    ("null_pk", 1, 2, "critical", "SEV-1"),
    ("duplicate_pk", 49, 100, "error", "SEV-2"),
    ("duplicate_pk", 50, 100, "critical", "SEV-1"),
    ("invalid_cdc_op", 1, 100, "error", "SEV-2"),
    ("invalid_cdc_op", 1, 101, "warning", "SEV-3"),
    ("empty_table", 0, 0, "error", "SEV-2"),
    ("null_pk", 0, 0, "critical", "SEV-1"),
    ("invalid_cdc_op", 0, 0, "error", "SEV-2"),
    ("stale_data", 1, 10, "warning", "SEV-3"),
    ("something_else", 1, 10, "error", "SEV-2"),
]


def test_severity_boundaries(spark):
    df = spark.createDataFrame([c[:3] for c in CASES], "k string, bad long, total long")
    level = scoped_severity(F.col("k"), F.col("bad"), F.col("total"))
    got = {(r.k, r.bad, r.total): (r.s, r.l) for r in df.select(
        "*", level["severity"].alias("s"), level["sev_label"].alias("l")).collect()}
    assert got == {c[:3]: c[3:] for c in CASES}


def test_gate_blocks_on_all_but_old_data(spark):
    old = spark.createDataFrame([(1, "a", "c", NOW - 10**6)], SCHEMA)
    rep = quality.dq_report(old, ["order_id"], NOW)
    assert tuple(quality.gate(rep).first()) == (True, False)
    assert tuple(quality.gate(rep, ()).first()) == (False, False)
    bad = spark.createDataFrame([(None, "a", "c", NOW)], SCHEMA)
    assert not quality.gate(quality.dq_report(bad, ["order_id"], NOW)).first()["may_write"]


def test_user_checks(spark):
    checks = [CheckSpec("mean", "range", F.avg("order_id"), lambda v: v > 1.5),
              CheckSpec("low", "range", F.min("order_id"), lambda v: v > 1)]
    got = report(spark, [(1, "a", "c", NOW), (3, "b", "c", NOW)], checks=checks)
    assert got["mean"]["passed"]
    assert not got["low"]["passed"] and got["low"]["violation_rows"] == 2


def test_change_log_report_keeps_repeats_as_information(spark):
    df = spark.createDataFrame([(1, "a", "c", NOW), (1, "b", "u", NOW)], SCHEMA)
    got = {r["check_name"]: r for r in quality.as_change_log(quality.dq_report(df, ["order_id"], NOW)).collect()}
    row = got["unique_pk:order_id"]
    assert row["passed"] and row["violation_rows"] == 2 and row["severity"] is None


def test_failure_events_of_a_report(spark):
    df = spark.createDataFrame([(None, "a", "c", NOW)], SCHEMA)
    ev = alerts.check_failure_events(quality.dq_report(df, ["order_id"], NOW), "orders", NOW, 4, "url").collect()
    assert len(ev) == 1
    assert ev[0]["dedup_key"] == "cdc-orders-null_pk" and ev[0]["severity"] == "critical"
    assert ev[0]["summary"].startswith("[CDC DQ SEV-1] 'orders': null_pk:order_id FAILED — 1/1 rows (100.00%) | ")
    empty = quality.dq_report(df.where("false"), ["order_id"], NOW)
    ev = alerts.check_failure_events(empty, "orders", NOW).collect()
    assert ev[0]["summary"] == "[CDC DQ SEV-2] 'orders': non_empty FAILED — table has 0 rows"


def test_one_scan_and_one_keyed_shuffle(spark, folder):
    spark.range(100).selectExpr("id as order_id", "'c' as cdc_op", "id as cdc_ts_ms").write.parquet(folder + "/t")
    rep = quality.dq_report(spark.read.parquet(folder + "/t"), ["order_id"], NOW)
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
