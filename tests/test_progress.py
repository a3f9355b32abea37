"""What streams report and register, and the upkeep of what they store."""

import json
import os
import random
import time
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from rillmark.__main__ import main
from rillmark.operators import changes, quality
from rillmark.plans.batch_run import RunConfig
from rillmark.sinks import bronze, state
from rillmark.sources import catalog
from rillmark.spec import TableSpec
from rillmark.streaming import ingest

ROW = "struct<id:int,n:int,v:string>"
FEED = f"op string, ts_ms long, before {ROW}, after {ROW}, seq long"
SPEC = TableSpec("items", ("id",), "id SMALLINT, n SMALLINT, v STRING")
T0 = 1_700_000_000_000
DAY = 86_400_000


def rows(seed, n=120, days=3):
    rnd, out = random.Random(seed), []
    for i in range(n):
        row = (rnd.choice([None, 40_000, *range(12)]), rnd.choice([1, 2, 70_000]), f"v{i}")
        op = rnd.choice(["c", "u", "u", "r", "d", "?", None])
        out.append((op, T0 + rnd.randrange(days) * DAY + i * 50, row if op == "d" else None, rnd.choice([None, row, row, row]) if op != "d" else None, i))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_figures_of_the_write_equal_those_of_further_passes(spark, folder, seed):
    df = spark.createDataFrame(rows(seed), FEED).repartition(3)
    figures = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0).store(df, 0, True)
    seen = df.select("after.id", F.col("ts_ms").alias("cdc_ts_ms"), F.col("op").alias("cdc_op"), F.col("after").isNotNull().alias("has"))
    exact = quality.batch_profile(changes.with_declared_keys(seen, SPEC), ["id"], only=F.col("has")).first().asDict()
    for name in ("bad_ops", "storable_keys", "newest_ms", "feed_newest_ms", "nulls_id", "total", "keys", "single_keys"):
        assert figures[name] == exact[name], name
    assert figures["total"] - figures["unkeyed"] == exact["keyed_rows"]
    flat = changes.flatten(changes.storable(df))
    assert figures["misfits"] == changes.conform(flat, SPEC.stored_schema()).agg(F.sum("n_bad")).first()[0]
    assert figures["unusable"] == ingest.unusable(df, SPEC).count()
    stored = spark.read.parquet(folder + "/bronze")
    assert figures["written"] == stored.count() == stored.select("id").distinct().count()
    writer = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0)
    days = {date(r.year, r.month, r.day) for r in stored.select("year", "month", "day").distinct().collect()}
    assert set(writer.days(spark, 0, figures)) == days
    assert set(writer.days(spark, 0, figures | {"first_day": -5})) == days  # outside the bitmap: read


def test_a_batch_is_scanned_once(spark, folder):
    path = folder + "/in"
    spark.createDataFrame([r for r in rows(4) if r[0] in ("c", "u") and r[3] and r[3][0] in range(12)], FEED).write.parquet(path)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.read.parquet(path)
    total = df.count()
    counted = df.mapInArrow(count, df.schema)
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0)
    write(counted, 0)
    write(counted, 1)
    assert seen.value == 2 * total


def outcomes(spark, folder):
    log = state.log_rows(spark, folder + "/state/outcomes", state.OUTCOME_SCHEMA)
    return {r.batch_id: r for r in log.collect()}


def test_batches_report_marks_late_events_and_alerts(spark, folder):
    ev = lambda op, ts, key, n=1, seq=0: (op, ts, (key, n, "v") if op == "d" else None, None if op == "d" else (key, n, "v"), seq)
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0 + 1000, dashboard_url="http://d")
    write(spark.createDataFrame([ev("c", T0, 1), ev("u", T0 + 5, 1, 70_000), ev("c", T0 + 5, None)], FEED), 0)
    write(spark.createDataFrame([ev("c", T0 + 3, 2), ev("d", T0 + 9, 1)], FEED), 1)
    write(spark.createDataFrame([ev("d", T0 + 8, 2)], FEED), 2)
    write(spark.createDataFrame([], FEED), 3)
    got = outcomes(spark, folder)
    assert sorted(got) == [0, 1, 2]
    figures = lambda b: tuple(got[b][c] for c in ("status", "rows_read", "rows_late", "values_misfit", "rows_rejected", "rows_written", "mark_ms", "dq_passed"))
    assert figures(0) == ("ok", 3, 0, 1, 1, 1, T0 + 5, False)
    assert figures(1) == ("ok", 1, 1, 0, 0, 2, T0 + 9, True)
    assert figures(2) == ("only_deletes", 0, 1, 0, 0, 1, T0 + 9, None)
    assert state.load_mark(spark, folder + "/state/marks", "items") == T0 + 9
    # Another process goes on from the mark that was saved.
    again = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0 + 10**7)
    again(spark.createDataFrame([ev("c", T0 + 7, 5)], FEED), 4)
    assert outcomes(spark, folder)[4]["rows_late"] == 1
    sent = [json.loads(r.value) for r in spark.read.parquet(folder + "/state/outbox").collect()]
    kinds = {(m["event_action"], m["error_type"]) for m in sent}
    assert {("trigger", "null_pk"), ("trigger", "stale_data"), ("resolve", "stale_data")} <= kinds
    null_pk = next(m for m in sent if m["error_type"] == "null_pk")
    assert null_pk["custom_details"]["dashboard_url"] == "http://d"
    gauges = {r.metric for r in spark.read.parquet(folder + "/state/metrics").collect()}
    assert {"cdc_rows_written_total", "cdc_dq_check_status", "cdc_freshness_gap_seconds"} <= gauges


def test_a_batch_repeated_after_a_restart_takes_its_own_place(spark, folder):
    path = folder + "/bronze"
    first = [("c", T0 + d * DAY, None, (k, 1, "a"), k) for k in range(4) for d in (0, 1)]
    other = [("c", T0 + d * DAY, None, (9, 1, "b"), 9) for d in (0, 2)]
    one = ingest.bronze_writer(SPEC, path, folder + "/state", lambda: T0)
    one(spark.createDataFrame(other, FEED), 0)
    one(spark.createDataFrame(first, FEED), 1)
    before = sorted(map(repr, spark.read.parquet(path).collect()))
    for _ in range(2):
        ingest.bronze_writer(SPEC, path, folder + "/state", lambda: T0)(spark.createDataFrame(first, FEED), 1)
        assert sorted(map(repr, spark.read.parquet(path).collect())) == before


def test_replayed_events_stay_when_others_follow(spark, folder):
    small = TableSpec("items", ("id",), "id TINYINT, n INT, v STRING")
    args = (folder + "/bronze", folder + "/state")
    ingest.bronze_writer(small, *args, lambda: T0)(spark.createDataFrame([("c", T0, None, (300, 1, "a"), 0), ("c", T0, None, (None, 1, "x"), 0)], FEED), 0)
    schema = spark.createDataFrame([], FEED).schema
    assert ingest.replay_quarantine(spark, SPEC, *args, schema) == 1
    ingest.bronze_writer(small, *args, lambda: T0)(spark.createDataFrame([("c", T0, None, (400, 1, "b"), 0)], FEED), 1)
    assert ingest.replay_quarantine(spark, SPEC, *args, schema) == 1
    assert ingest.replay_quarantine(spark, SPEC, *args, schema) == 1
    assert sorted(r.id for r in spark.read.schema("id int").parquet(args[0]).collect()) == [300, 400]
    assert ingest.replay_quarantine(spark, SPEC, folder + "/x", folder + "/y", schema) == 0


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_streamed_bronze_is_in_the_catalog(spark, folder):
    bronze.create_database(spark, "streamed", folder + "/bronze")
    try:
        bronze.create_tables(spark, "streamed", folder + "/bronze", [SPEC])
        path, cp = folder + "/bronze/items", folder + "/cp"
        write = ingest.bronze_writer(SPEC, path, folder + "/state", lambda: T0, database="streamed")
        schema = spark.createDataFrame([], FEED).schema
        for day in (0, 1, 1):
            events = [("c", T0 + day * DAY, None, (k + 10 * day, 1, "a"), k) for k in range(5)]
            spark.createDataFrame(events, FEED).coalesce(1).write.mode("append").parquet(folder + "/in")
            finish(ingest.keep_bronze(ingest.file_stream(spark, folder + "/in", schema), write, cp, once=True))
        days = sorted(map(tuple, catalog.partitions(spark, "streamed", "items").collect()))
        assert days == [(2023, 11, 14), (2023, 11, 15)]
        table = spark.table("streamed.items")
        assert table.count() == 15 and [f.name for f in table.schema.fields][:5] == ["id", "n", "v", "cdc_ts_ms", "cdc_op"]
        assert all(o.partition_registered for o in outcomes(spark, folder).values())
        assert changes.current_state(table, SPEC).count() == 10
        # Retention takes the old day out of catalog and storage.
        assert bronze.expire(spark, path, date(2023, 11, 15), "streamed", "items") == [date(2023, 11, 14)]
        assert [tuple(r) for r in catalog.partitions(spark, "streamed", "items").collect()] == [(2023, 11, 15)]
        assert bronze.stored_days(spark, path) == [date(2023, 11, 15)] and spark.table("streamed.items").count() == 10
        assert bronze.expire(spark, path, date(2023, 11, 15), "streamed", "items") == []
    finally:
        spark.sql("DROP DATABASE streamed CASCADE")


def test_a_missing_table_is_told_and_stops_nothing(spark, folder):
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0, database="nowhere")
    write(spark.createDataFrame([("c", T0, None, (1, 1, "a"), 0)], FEED), 0)
    out = outcomes(spark, folder)[0]
    assert (out.status, out.partition_registered, out.message) == ("ok", False, "1 days were not registered")
    assert spark.read.parquet(folder + "/bronze").count() == 1


def test_a_stream_that_crashes_is_reported(spark, folder):
    watch, config = ingest.StreamWatch(), RunConfig("", "", folder + "/state")
    assert isinstance(watch, StreamingQueryListener) and watch.flush(spark, config, T0) == 0
    good, bad = TableSpec("good", ("id",), "id INT, n INT, v STRING"), TableSpec("bad", ("id",), "id INT, n INT, v STRING")
    for spec in (good, bad):
        spark.createDataFrame([("c", T0, None, (1, 1, "a"), 0)], FEED).write.parquet(f"{folder}/raw/{spec.name}")
    spark.streams.addListener(watch)
    try:
        state.save_mark(spark, folder + "/state/marks", "bad", T0 - 5)
        # A file where the table's folder should be makes its writes fail.
        os.makedirs(folder + "/bronze")
        with open(folder + "/bronze/bad", "w") as f:
            f.write("x")
        running = ingest.keep_all_bronze(spark, [good, bad], folder + "/raw", folder + "/bronze", folder + "/state", lambda: T0, once=True)
        finish(running["good"])
        with pytest.raises(Exception):  # noqa: B017 - whatever the store says
            running["bad"].awaitTermination()
        told = 0
        for _ in range(100):
            told += watch.flush(spark, config, T0 + 1)
            if told:
                break
            time.sleep(0.1)
        assert told == 1
    finally:
        spark.streams.removeListener(watch)
    log = state.log_rows(spark, folder + "/state/outcomes", state.OUTCOME_SCHEMA)
    crashed = log.where("status = 'crashed'").collect()
    assert [(r.table, r.failed_step, r.consecutive_failures, r.mark_ms) for r in crashed] == [("bad", "stream", 1, T0 - 5)]
    sent = [json.loads(r.value) for r in spark.read.parquet(folder + "/state/outbox").collect()]
    assert ("bad", "unhandled_exception") in {(m["table"], m["error_type"]) for m in sent}
    assert watch.newest["good"][1] == 1


def test_compaction_reads_the_files_it_listed(spark, folder, monkeypatch):
    """Rows that arrive while a day is copied are neither lost nor stored twice."""
    path = folder + "/t"
    df = spark.range(20).selectExpr("id", "2024 as year", "1 as month", "1 as day")
    bronze.append(df.repartition(4), path)
    whole = bronze.balanced

    def late(rows, by):
        bronze.append(df.where("id < 3"), path)
        return whole(rows, by)

    with monkeypatch.context() as m:
        m.setattr(bronze, "balanced", late)
        with pytest.raises(RuntimeError):
            bronze.compact_day(spark, path, folder + "/staging", 2024, 1, 1)
    assert spark.read.parquet(path).count() == 23
    assert bronze.compact_day(spark, path, folder + "/staging", 2024, 1, 1) == 23
    assert len(spark.read.parquet(path).inputFiles()) == 1 and spark.read.parquet(path).count() == 23


def test_commands_for_streams_and_upkeep(spark, folder, capsys):
    row = "struct<product_id:bigint,product_name:string>"
    schema = f"op string, ts_ms long, before {row}, after {row}, seq long"
    events = [("c", T0, None, (1, "Tea"), 0), ("c", T0, None, (99_999, "Jar"), 1)]
    spark.createDataFrame(events, schema).write.parquet(folder + "/raw/products")
    where = ["--bronze", folder + "/bronze", "--state", folder + "/state"]
    only = ["--tables", "products"]
    assert main(["stream", "--raw", folder + "/raw", "--once", *where, *only], spark) == 0
    assert main(["replay", *where, *only], spark) == 0
    assert main(["compact", "--day", "2023-11-14", *where, *only], spark) == 0
    assert spark.read.parquet(folder + "/bronze/products").select("product_name").first()[0] == "Tea"
    assert main(["expire", "--keep-days", "30", "--bronze", folder + "/bronze", *only], spark) == 0
    said = capsys.readouterr().out
    assert "products ok" in said and "products 1 still aside" in said and "products 1 rows" in said and "products 1 days dropped" in said
    assert bronze.stored_days(spark, folder + "/bronze/products") == []
    with pytest.raises(SystemExit):
        main(["compact", "--day", "2999-01-01", *where, *only], spark)


def test_rows_per_key_without_keys_or_values(spark):
    df = spark.createDataFrame([(None, None, None, None, None)] * 3, FEED)
    got = ingest.per_key(df, SPEC, ("seq",), True, T0).collect()
    assert [(r.row, r.events, r.n, r.n_unusable, r.n_late) for r in got] == [(None, 3, 0, 3, 0)]
    assert ingest.stream_rows(df, SPEC, ("seq",), True).where(F.lit(True)).count() == 0
