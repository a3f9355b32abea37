"""Batch runs, bronze tables and the catalog."""

import json

import pytest

from rillmark.__main__ import main
from rillmark.operators import series
from rillmark.plans.batch_run import RunConfig, run_all, run_table
from rillmark.sinks import bronze, state
from rillmark.sources import catalog
from rillmark.spec import TableSpec, replicated_tables

ROW = "struct<id:int,v:string>"
FEED = f"op string, ts_ms long, before {ROW}, after {ROW}, seq long"
SPEC = TableSpec("items", ("id",), "id INT, v STRING")
NOW = 1_700_000_000_000


def ev(op, ts, key, v=None, seq=0):
    row = (key, v)
    return (op, ts, row if op == "d" else None, None if op == "d" else row, seq)


def config(folder, **kw):
    return RunConfig(folder + "/raw", folder + "/bronze", folder + "/state", ties=("seq",), **kw)


def put(spark, folder, rows, table="items"):
    spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(f"{folder}/raw/{table}")


def test_two_runs_take_only_new_events(spark, folder):
    cfg = config(folder)
    put(spark, folder, [ev("c", NOW - 5000, 1, "a"), ev("u", NOW - 4000, 1, "b"), ev("d", NOW - 3000, 9)])
    out = run_table(spark, SPEC, cfg, NOW)
    assert (out["status"], out["rows_read"], out["rows_deduped"], out["rows_written"]) == ("ok", 2, 1, 1)
    assert out["mark_ms"] == NOW - 3000 and out["mark_saved"]
    assert run_table(spark, SPEC, cfg, NOW)["status"] == "no_new_events"
    put(spark, folder, [ev("u", NOW - 1000, 1, "c"), ev("c", NOW - 1000, 2, "x")])
    out = run_table(spark, SPEC, cfg, NOW + 1000)
    assert out["rows_written"] == 2
    rows = spark.read.parquet(folder + "/bronze/items").collect()
    assert sorted(r.v for r in rows) == ["b", "c", "x"]
    assert {(r.year, r.month, r.day) for r in rows} == {(2023, 11, 14)}
    assert state.load_mark(spark, cfg.path("marks"), "items") == NOW - 1000


def test_a_failed_gate_writes_nothing_and_keeps_the_mark(spark, folder):
    cfg = config(folder)
    put(spark, folder, [ev("c", NOW, None, "a"), ev("c", NOW, 2, "b")])
    out = run_table(spark, SPEC, cfg, NOW)
    assert out["status"] == "gate_failed" and out["rows_written"] == 0 and out["rows_rejected"] == 1
    assert state.load_mark(spark, cfg.path("marks"), "items") is None
    msg = json.loads(spark.read.parquet(cfg.path("outbox")).first()["value"])
    assert msg["error_type"] == "null_pk" and msg["severity"] == "critical"


def test_old_data_blocks_only_on_request(spark, folder):
    put(spark, folder, [ev("c", NOW - 10**7, 1, "a")])
    assert run_table(spark, SPEC, config(folder, freshness_blocks=True), NOW)["status"] == "gate_failed"
    assert run_table(spark, SPEC, config(folder), NOW)["status"] == "ok"


def test_only_deletes_move_the_mark(spark, folder):
    put(spark, folder, [ev("d", NOW, 1)])
    out = run_table(spark, SPEC, config(folder), NOW)
    assert out["status"] == "only_deletes" and out["mark_ms"] == NOW


def test_one_table_does_not_stop_the_others(spark, folder):
    cfg = config(folder)
    bad = TableSpec("broken", ("nope",), "nope INT")
    put(spark, folder, [ev("c", NOW, 1, "a")], "broken")
    put(spark, folder, [ev("c", NOW, 1, "a")])
    missing = TableSpec("missing", ("id",), "id INT")
    got = {o["table"]: o for o in run_all(spark, [bad, missing, SPEC], cfg, NOW)}
    assert (got["broken"]["status"], got["broken"]["failed_step"]) == ("crashed", "profile")
    assert got["missing"]["status"] == "unreadable" and got["items"]["status"] == "ok"
    again = {o["table"]: o for o in run_all(spark, [bad, SPEC], cfg, NOW + 1)}
    assert again["broken"]["consecutive_failures"] == 2 and again["items"]["consecutive_failures"] == 0
    values = [json.loads(r["value"]) for r in spark.read.parquet(cfg.path("outbox")).collect()]
    kinds = {(v["table"], v["error_type"], v["event_action"]) for v in values}
    assert ("broken", "unhandled_exception", "trigger") in kinds and ("items", "stale_data", "resolve") in kinds
    samples = spark.read.parquet(cfg.path("metrics"))
    last = series.instant_vector(series.matching(samples, "cdc_last_run_timestamp_seconds"), NOW + 1)
    assert {r.labels["table"] for r in last.collect()} == {"items"}
    assert series.matching(samples, "cdc_dq_check_status", {"table": "items"}).count() == 5


def test_orders_with_day_numbers_and_log_positions(spark, folder):
    row = "struct<order_id:int,customer_id:string,order_date:int,freight:double>"
    schema = f"op string, ts_ms long, after {row}, source struct<lsn:long>"
    rows = [("r", NOW, (1, "ALFKI", 9000, 32.38), (1,)), ("u", NOW, (1, "BERGS", 9001, 32.4), (3,)),
            ("u", NOW, (1, "CHOPS", 9002, 32.5), (2,))]
    spark.createDataFrame(rows, schema).write.parquet(folder + "/raw/orders")
    cfg = RunConfig(folder + "/raw", folder + "/bronze", folder + "/state", seq_path="source.lsn")
    spec = replicated_tables()["orders"]
    out = run_table(spark, spec, cfg, NOW)
    assert (out["status"], out["mark_state"], out["rows_written"]) == ("ok", "none", 1)
    bronze_rows = spark.read.parquet(folder + "/bronze/orders")
    assert [(r.order_id, r.customer_id, str(r.order_date)) for r in bronze_rows.collect()] == [(1, "BERGS", "1994-08-24")]
    # A key that does not fit a SMALLINT counts as a missing key; nothing is stored under a wrapped one.
    spark.createDataFrame([("c", NOW + 1, (40000, "X", 1, 1.0), (4,))], schema).write.mode("append").parquet(
        folder + "/raw/orders")
    out = run_table(spark, spec, cfg, NOW + 1)
    assert (out["status"], out["mark_state"], out["rows_rejected"]) == ("gate_failed", "loaded", 1)


def test_broken_state_means_full_backfill(spark, folder):
    assert state.load_mark(spark, folder + "/none", "t") is None
    state.save_mark(spark, folder + "/marks", "t", 5, 1)
    state.save_mark(spark, folder + "/marks", "t", 9, 2)
    state.save_mark(spark, folder + "/marks", "u", 7, 3)
    assert state.load_mark(spark, folder + "/marks", "t") == 9


@pytest.fixture
def database(spark, folder):
    bronze.create_database(spark, "lake", folder + "/bronze")
    yield "lake"
    spark.sql("DROP DATABASE lake CASCADE")


def test_tables_and_partitions(spark, folder, database):
    specs = replicated_tables()
    made = bronze.create_tables(spark, database, folder + "/bronze", specs.values())
    assert set(made.values()) == {"created"}
    assert set(bronze.create_tables(spark, database, folder + "/bronze", specs.values()).values()) == {"exists"}
    assert {r[0] for r in catalog.databases(spark).collect()} >= {"lake"}
    assert {r[0] for r in catalog.tables(spark, database).collect()} == set(specs)
    assert [f.dataType.simpleString() for f in spark.table("lake.order_details").schema.fields] == [
        "smallint", "smallint", "float", "smallint", "float", "bigint", "string", "int", "int", "int"]
    assert catalog.table_exists(spark, database, "orders") and not catalog.table_exists(spark, database, "x")


def test_a_run_registers_its_partition(spark, folder, database):
    bronze.create_tables(spark, database, folder + "/bronze", [SPEC])
    put(spark, folder, [ev("c", NOW, i, "a") for i in range(30)])
    out = run_table(spark, SPEC, config(folder, database=database), NOW)
    assert out["partition_registered"]
    assert [tuple(r) for r in catalog.partitions(spark, database, "items").collect()] == [(2023, 11, 14)]
    assert spark.table("lake.items").count() == 30 and catalog.browse(spark, database, "items").count() == 20
    path = folder + "/bronze/items"
    assert bronze.register_partition(spark, database, "items", path, 2023, 11, 14)
    assert not bronze.register_partition(spark, database, "no_table", path, 2023, 11, 14)


def test_compaction_keeps_rows(spark, folder):
    path = folder + "/t"
    for n in range(4):
        df = spark.range(n * 10, n * 10 + 10).selectExpr("id", "2024 as year", "1 as month", f"{n % 2 + 1} as day")
        bronze.append(df.repartition(3), path)
    before = len(spark.read.parquet(path).where("day = 1").inputFiles())
    assert bronze.compact_day(spark, path, folder + "/staging", 2024, 1, 1) == 20
    after = spark.read.parquet(path)
    assert after.count() == 40 and after.select("id").distinct().count() == 40
    day = [f for f in after.inputFiles() if "day=1" in f]
    assert len(day) == 1 < before


def test_a_log_day_is_compacted(spark, folder):
    path = folder + "/log"
    for n in range(3):
        state.append_rows(spark.range(n, n + 1), path, NOW)
    state.append_rows(spark.range(9, 10), path, NOW + 86_400_000)
    assert bronze.compact(spark, path, folder + "/staging", {"log_day": "20231114"}) == 3
    log = state.log_rows(spark, path, "id long")
    assert sorted(r.id for r in log.collect()) == [0, 1, 2, 9] and len(log.inputFiles()) == 2
    assert state.log_rows(spark, path, "id long", NOW + 86_400_000).count() == 1


def test_replays_replace_their_partition(spark, folder):
    df = spark.range(10).selectExpr("id", "2024 as year", "1 as month", "1 as day")
    bronze.replace_partitions(df, folder + "/t")
    bronze.replace_partitions(df.withColumn("day", df.day + 1), folder + "/t")
    bronze.replace_partitions(df, folder + "/t")
    assert spark.read.parquet(folder + "/t").count() == 20


def test_command_line(spark, folder, capsys):
    args = ["--bronze", folder + "/bronze"]
    assert main(["init", "--database", "shop", *args], spark) == 0
    row = "struct<product_id:smallint,product_name:string>"
    feed = spark.createDataFrame([("c", NOW, None, (1, "Tea"), 0)],
                                 f"op string, ts_ms long, before {row}, after {row}, seq long")
    for table in ("products",):
        feed.write.parquet(f"{folder}/raw/{table}")
    # The other tables have no source yet, which is reported.
    code = main(["run", "--raw", folder + "/raw", "--state", folder + "/state", "--database", "shop", *args], spark)
    assert code == 1
    said = capsys.readouterr().out
    assert "products ok 1" in said and "orders unreadable" in said
    assert [r.product_name for r in spark.table("shop.products").collect()] == ["Tea"]
    spark.sql("DROP DATABASE shop CASCADE")


def test_a_catalog_fault_neither_stops_nor_repeats_a_run(spark, folder):
    cfg = config(folder, database="no_such_database")
    put(spark, folder, [ev("c", NOW, 1, "a")])
    out = run_table(spark, SPEC, cfg, NOW)
    assert (out["status"], out["mark_saved"], out["partition_registered"]) == ("ok", True, False)
    assert "not registered" in out["message"]
    assert run_table(spark, SPEC, cfg, NOW + 1)["status"] == "no_new_events"
    assert spark.read.parquet(folder + "/bronze/items").count() == 1


def test_a_mark_that_is_not_saved_or_read_is_a_failure(spark, folder, monkeypatch):
    cfg = config(folder)
    put(spark, folder, [ev("c", NOW, 1, "a")])
    with monkeypatch.context() as m:
        m.setattr(state, "save_mark", lambda *a, **k: False)
        assert run_all(spark, [SPEC], cfg, NOW)[0]["consecutive_failures"] == 1
    monkeypatch.setattr(state, "read_mark", lambda *a: ("unreadable", None))
    out = run_all(spark, [SPEC], cfg, NOW + 1)[0]
    assert (out["status"], out["failed_step"], out["consecutive_failures"]) == ("crashed", "load_mark", 2)
    assert run_table(spark, SPEC, config(folder, backfill_unreadable_mark=True), NOW + 2)["status"] == "ok"


def test_failures_older_than_the_recent_log_still_count(spark, folder):
    cfg = config(folder)
    assert run_all(spark, [SPEC], cfg, NOW)[0]["consecutive_failures"] == 1
    assert run_all(spark, [SPEC], cfg, NOW + 90 * 86_400_000)[0]["consecutive_failures"] == 2


def test_misfit_and_late_values_are_counted(spark, folder):
    row = "struct<id:bigint,v:string>"
    spec = TableSpec("items", ("id",), "id INT, v SMALLINT")
    feed = f"op string, ts_ms long, after {row}"
    spark.createDataFrame([("c", NOW, (1, "40000")), ("c", NOW, (2, "7"))], feed).write.parquet(folder + "/raw/items")
    cfg = RunConfig(folder + "/raw", folder + "/bronze", folder + "/state")
    out = run_table(spark, spec, cfg, NOW)
    assert (out["status"], out["values_misfit"], out["rows_late"]) == ("ok", 1, 0)
    spark.createDataFrame([("c", NOW - 5, (3, "1")), ("c", NOW + 5, (4, "1"))], feed).write.mode("append").parquet(folder + "/raw/items")
    out = run_table(spark, spec, cfg, NOW + 5)
    assert (out["rows_written"], out["rows_late"]) == (1, 3)


def test_a_crash_still_reports_how_old_the_data_is(spark, folder, monkeypatch):
    cfg = config(folder, dashboard_url="http://d")
    put(spark, folder, [ev("c", NOW, 1, "a")])
    run_all(spark, [SPEC], cfg, NOW)
    put(spark, folder, [ev("c", NOW + 1, 2, "a")])
    monkeypatch.setattr(bronze, "append", lambda *a: 1 / 0)
    out = run_all(spark, [SPEC], cfg, NOW + 10**7)[0]
    assert (out["status"], out["failed_step"], out["mark_ms"]) == ("crashed", "write", NOW)
    sent = [json.loads(r["value"]) for r in spark.read.parquet(cfg.path("outbox")).collect()]
    stale = next(m for m in sent if m["error_type"] == "stale_data" and m["event_action"] == "trigger" and m["component"] == "spark/freshness_check")
    assert stale["custom_details"] == {
        "consecutive_failures": 1, "freshness_gap_seconds": 10_000, "threshold_seconds": cfg.freshness_limit_s, "dashboard_url": "http://d",
    }
    crash = next(m for m in sent if m["error_type"] == "unhandled_exception")
    assert crash["custom_details"]["dashboard_url"] == "http://d" and out["duration_s"] > 0


def test_compaction_refuses_a_partition_that_changes(spark, folder, monkeypatch):
    path, rows = folder + "/t", spark.createDataFrame([(1, 2023, 11, 14)], "id int, year int, month int, day int")
    rows.write.partitionBy("year", "month", "day").parquet(path)
    whole = bronze.balanced

    def late(df, by):
        rows.write.mode("append").partitionBy("year", "month", "day").parquet(path)
        return whole(df, by)

    monkeypatch.setattr(bronze, "balanced", late)
    with pytest.raises(RuntimeError):
        bronze.compact_day(spark, path, folder + "/staging", 2023, 11, 14)
    assert spark.read.parquet(path).count() == 2


def test_a_run_repeated_after_a_fault_stores_its_rows_once(spark, folder, monkeypatch):
    cfg = config(folder)
    put(spark, folder, [ev("c", NOW, 1, "a"), ev("c", NOW, 2, "a")])
    assert run_table(spark, SPEC, cfg, NOW)["status"] == "ok"
    put(spark, folder, [ev("u", NOW + 1, 1, "b")])
    with monkeypatch.context() as m:
        m.setattr(state, "save_mark", lambda *a, **k: False)
        assert run_table(spark, SPEC, cfg, NOW + 2)["status"] == "mark_failed"
    put(spark, folder, [ev("c", NOW + 3, 3, "c")])
    out = run_table(spark, SPEC, cfg, NOW + 86_400_000)
    assert (out["status"], out["rows_written"]) == ("ok", 2)
    rows = spark.read.parquet(folder + "/bronze/items").collect()
    assert sorted((r.id, r.v) for r in rows) == [(1, "a"), (1, "b"), (2, "a"), (3, "c")]
    assert run_table(spark, SPEC, cfg, NOW + 86_400_001)["status"] == "no_new_events"


def test_deletes_are_stored_on_request_and_order_by_seq(spark, folder):
    cfg = RunConfig(folder + "/raw", folder + "/bronze", folder + "/state", keep_deletes=True)
    put(spark, folder, [ev("c", NOW, 1, "a", 1), ev("u", NOW, 1, "b", 2), ev("d", NOW, 2, None, 5), ev("c", NOW, 2, "x", 4)])
    out = run_table(spark, SPEC, cfg, NOW)
    assert (out["rows_read"], out["rows_deduped"], out["rows_written"]) == (3, 2, 2)
    rows = {(r.id, r.v, r.cdc_op, r.seq) for r in spark.read.parquet(folder + "/bronze/items").collect()}
    assert rows == {(1, "b", "u", 2), (2, None, "d", 5)}
    put(spark, folder, [ev("d", NOW + 1, 1)])
    assert run_table(spark, SPEC, cfg, NOW + 1)["status"] == "only_deletes"
    assert spark.read.parquet(folder + "/bronze/items").count() == 3


def test_a_broken_file_is_an_outcome(spark, folder):
    cfg = config(folder)
    put(spark, folder, [ev("c", NOW, 1, "a")])
    (path,) = spark.read.parquet(folder + "/raw/items").inputFiles()
    with open(path.removeprefix("file://"), "r+b") as f:
        f.seek(4)
        f.write(b"\xff" * 60)
    assert run_table(spark, SPEC, cfg, NOW)["status"] == "unreadable"
