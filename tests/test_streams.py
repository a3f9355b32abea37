"""Streams against their batch twins."""

import random

import pytest

from rillmark.operators import alerts, changes
from rillmark.operators.rules import sustained
from rillmark.sources.messages import file_messages
from rillmark.spec import TableSpec
from rillmark.streaming import batched, ingest
from rillmark.streaming.delivery import delivery_writer

ROW = "struct<id:int,v:string>"
FEED = f"op string, ts_ms long, before {ROW}, after {ROW}, seq long"
SPEC = TableSpec("items", ("id",), "id INT, v STRING")
T0 = 1_700_000_000_000


def parts(spark, df, path, n, order):
    """Writes rows as n files in time order, so a stream can take them one by one."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // n)
    for i in range(n):
        spark.createDataFrame(rows[i * size:(i + 1) * size], df.schema).coalesce(1).write.mode("append").parquet(path)
    return df.schema


def stream(spark, path, schema):
    return ingest.file_stream(spark, path, schema, files_per_trigger=1)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def change_rows(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(120):
        key, op = rnd.randrange(10), rnd.choice("cuurd")
        row = (key, f"v{i}")
        rows.append((op, T0 + i * 50, row if op == "d" else None, None if op == "d" else row, i))
    return rows


@pytest.mark.parametrize("seed,files", [(1, 1), (2, 5)])
def test_bronze_stream_equals_batch_state(spark, folder, seed, files):
    df = spark.createDataFrame(change_rows(seed), FEED)
    schema = parts(spark, df, folder + "/in", files, "seq")
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0)
    finish(ingest.keep_bronze(stream(spark, folder + "/in", schema), write, folder + "/cp", once=True))
    got = {(r.id, r.v) for r in ingest.live_rows(spark.read.parquet(folder + "/bronze"), SPEC).collect()}
    want = {(r.id, r.v) for r in changes.current_state_with_deletes(df, ["id"]).collect()}
    assert got == want


def test_a_replayed_batch_changes_nothing(spark, folder):
    df = spark.createDataFrame(change_rows(3), FEED)
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0)
    write(df, 0)
    once = spark.read.parquet(folder + "/bronze").count()
    write(df, 0)
    assert spark.read.parquet(folder + "/bronze").count() == once


def test_a_bad_batch_is_set_aside(spark, folder):
    rows = [("c", T0, None, (None, "a"), 0), ("c", T0, None, (1, "b"), 1)]
    write = ingest.bronze_writer(SPEC, folder + "/bronze", folder + "/state", lambda: T0)
    write(spark.createDataFrame(rows, FEED), 0)
    assert [tuple(r.after) for r in spark.read.parquet(folder + "/state/quarantine/items").collect()] == [(None, "a")]
    sent = spark.read.parquet(folder + "/state/outbox")
    # The failed check, and that the data is fresh again.
    assert sent.where(sent.value.contains("null_pk")).count() == 1 and sent.count() == 2
    write(spark.createDataFrame([("c", T0, None, (2, "b"), 1)], FEED), 1)
    assert sorted(r.id for r in spark.read.parquet(folder + "/bronze").collect()) == [1, 2]


def test_events_set_aside_come_back_when_they_fit(spark, folder):
    small = TableSpec("items", ("id",), "id SMALLINT, v STRING")
    rows = [("c", T0, None, (40_000, "a"), 0), ("c", T0, None, (1, "b"), 1), ("c", T0, None, (None, "c"), 2)]
    df = spark.createDataFrame(rows, FEED)
    ingest.bronze_writer(small, folder + "/bronze", folder + "/state", lambda: T0)(df, 0)
    assert [r.id for r in spark.read.parquet(folder + "/bronze").collect()] == [1]
    for _ in range(2):
        assert ingest.replay_quarantine(spark, SPEC, folder + "/bronze", folder + "/state", df.schema) == 1
        ids = spark.read.option("mergeSchema", "true").schema("id int, v string").parquet(folder + "/bronze")
        assert ids.count() == 2


def test_landing_folders(spark, folder):
    df = spark.createDataFrame([("orders", T0 + i * 43_200_000, i) for i in range(4)], "table string, ts_ms long, n int")
    schema = parts(spark, df, folder + "/in", 1, "n")
    finish(ingest.land_raw(stream(spark, folder + "/in", schema), folder + "/raw", folder + "/cp", once=True, rows_per_file=1))
    out = spark.read.parquet(folder + "/raw")
    assert out.count() == 4 and out.select("table", "year", "month", "day").distinct().count() == 3
    assert len(out.inputFiles()) == 4


def alert_rows(seed):
    rnd = random.Random(seed)
    return [(f"k{rnd.randrange(4)}", rnd.choice(["trigger", "trigger", "resolve"]), T0 + i * 1000, i) for i in range(100)]


ALERTS = "dedup_key string, event_action string, ts_ms long, seq long"


@pytest.mark.parametrize("files", [1, 4])
def test_incidents_over_batches(spark, folder, files):
    df = spark.createDataFrame(alert_rows(files), ALERTS)
    schema = parts(spark, df, folder + "/in", files, "seq")
    write = batched.incident_writer(folder + "/s", chunk_ms=7000)
    finish(ingest.keep_bronze(stream(spark, folder + "/in", schema), write, folder + "/cp", once=True))
    got = {tuple(r) for r in batched.output(spark, folder + "/s", batched.INCIDENT_OUTPUT).collect()}
    want = {(r.dedup_key, r.opened_ms, r.resolved_ms, r.triggers, r.state)
            for r in alerts.incidents(df).where("state = 'resolved'").collect()}
    assert got == want and got


def test_incidents_replay_and_expiry(spark, folder):
    root = folder + "/s"
    write = batched.incident_writer(root, ttl_ms=5000)
    one = spark.createDataFrame([("a", "trigger", T0, 0), ("b", "trigger", T0, 1)], ALERTS)
    two = spark.createDataFrame([("b", "resolve", T0 + 6000, 2)], ALERTS)
    write(one, 0)
    write(two, 1)
    write(two, 1)
    got = {(r.dedup_key, r.state) for r in batched.output(spark, root, batched.INCIDENT_OUTPUT).collect()}
    assert got == {("b", "resolved"), ("a", "expired")}


@pytest.mark.parametrize("files", [1, 5])
def test_sustained_over_batches(spark, folder, files):
    rnd = random.Random(files)
    rows = [(f"s{i % 3}", T0 + i * 1000, rnd.random() < 0.8) for i in range(150)]
    df = spark.createDataFrame(rows, "series string, ts_ms long, breach boolean")
    schema = parts(spark, df, folder + "/in", files, "ts_ms")
    write = batched.sustained_writer(folder + "/s", 9000, chunk_ms=5000)
    finish(ingest.keep_bronze(stream(spark, folder + "/in", schema), write, folder + "/cp", once=True))
    got = {tuple(r) for r in batched.output(spark, folder + "/s", batched.FIRING_OUTPUT).collect()}
    runs = sustained(df, ["series"], "breach", 9000).where("state = 'firing'").collect()
    assert got == {(r.series, r.start_ms, r.start_ms + 9000) for r in runs} and got


@pytest.mark.parametrize("files", [1, 5])
def test_repeats_over_batches(spark, folder, files):
    rnd = random.Random(files)
    rows = [(f"g{rnd.randrange(3)}", T0 + i * 777) for i in range(150)]
    df = spark.createDataFrame(rows, "group_key string, ts_ms long")
    schema = parts(spark, df, folder + "/in", files, "ts_ms")
    write = batched.repeat_writer(folder + "/s", 20_000, 1)
    finish(ingest.keep_bronze(stream(spark, folder + "/in", schema), write, folder + "/cp", once=True))
    got = {tuple(r) for r in batched.output(spark, folder + "/s", batched.NOTIFY_OUTPUT).collect()}
    want = {tuple(r) for r in alerts.notifications(df, ["group_key"], repeat_ms=20_000, tick_ms=1).collect()}
    assert got == want


def collect_stream(spark, df, folder):
    query = (df.writeStream.format("parquet").option("path", folder + "/out")
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    finish(query)
    return {tuple(r) for r in spark.read.parquet(folder + "/out").collect()}


def test_message_source_and_rejects(spark, folder):
    rows = [("a", "k", '{"event_action":"trigger","error_type":"null_pk","dedup_key":"d"}', T0),
            ("b", "k", "broken", T0), ("b", "k", '{"event_action":"other"}', T0)]
    spark.createDataFrame(rows, "topic string, key string, value string, ts_ms long").write.parquet(folder + "/in")
    seen = []

    def handle(batch, batch_id):
        events, rejects = alerts.parse_events(batch)
        known, other = alerts.split_actions(events)
        seen.append((known.count(), other.count(), rejects.count()))

    finish(ingest.keep_bronze(file_messages(spark, folder + "/in", stream=True), handle, folder + "/cp", once=True))
    assert seen == [(1, 1, 1)]


def test_simple_repeat_filter(spark, folder):
    df = spark.createDataFrame([("a", T0), ("a", T0 + 1000), ("b", T0)], "dedup_key string, ts_ms long")
    schema = parts(spark, df, folder + "/in", 1, "ts_ms")
    out = batched.without_repeats(stream(spark, folder + "/in", schema)).select("dedup_key")
    assert collect_stream(spark, out, folder) == {("a",), ("b",)}


def test_delivery_stream(spark, folder):
    rows = [("a", "k", '{"event_action":"trigger","error_type":"null_pk","table":"t"}', T0),
            ("b", "k", "broken", T0), ("b", "k", '{"event_action":"other"}', T0)]
    df = spark.createDataFrame(rows, "topic string, key string, value string, ts_ms long")
    write = delivery_writer(folder, {"a": "key-a"})
    write(df, 0)
    write(df, 0)
    out = spark.read.parquet(folder + "/outbox").collect()
    assert [(r.dedup_key, r.dry_run) for r in out] == [("cdc-t-null_pk", False)]
    assert spark.read.parquet(folder + "/rejects").count() == 1
    assert spark.read.parquet(folder + "/ignored").count() == 1


def test_one_query_per_table(spark, folder):
    for name in ("items", "others"):
        spark.createDataFrame(change_rows(5), FEED).write.parquet(f"{folder}/raw/{name}")
    specs = [SPEC, TableSpec("others", ("id",), "id INT, v STRING")]
    started = ingest.keep_all_bronze(spark, specs, folder + "/raw", folder + "/bronze", folder + "/state",
                                     lambda: T0, once=True)
    for query in started.values():
        finish(query)
    assert set(started) == {"items", "others"}
    assert spark.read.parquet(folder + "/bronze/others").count() > 0


def test_numbers_over_the_declared_type_never_wrap(spark, folder):
    row = "struct<id:int,n:int>"
    rows = [("c", T0, None, (2, 40_000), 1), ("c", T0, None, (3, 5), 2)]
    spark.createDataFrame(rows, f"op string, ts_ms long, before {row}, after {row}, seq long").write.parquet(folder + "/raw/small")
    spec = TableSpec("small", ("id",), "id SMALLINT, n SMALLINT")
    started = ingest.keep_all_bronze(spark, [spec], folder + "/raw", folder + "/bronze", folder + "/state", lambda: T0, once=True)
    finish(started["small"])
    got = {r.id: r.n for r in spark.read.parquet(folder + "/bronze/small").collect()}
    assert got == {2: None, 3: 5}


def test_a_silence_ends_a_breach(spark, folder):
    day = 86_400_000
    write = batched.sustained_writer(folder, 120_000, max_gap_ms=60_000)
    for i, at in enumerate((T0, T0 + 10 * day)):
        write(spark.createDataFrame([("s", at, True)], "series string, ts_ms long, breach boolean"), i)
    try:
        assert spark.read.parquet(folder + "/out").count() == 0
    except Exception as error:  # nothing was ever sent
        assert "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)
