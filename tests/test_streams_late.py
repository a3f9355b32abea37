"""Streams over batches whose times overlap, and changes without a further event."""

import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators import alerts
from rillmark.streaming import batched, ingest

T0 = 1_700_000_040_000  # a full minute
MINUTE = 60_000
ALERTS = "dedup_key string, event_action string, ts_ms long, seq long"
CHANGES = "group_key string, ts_ms long, changed boolean"


def put_out(spark, root, schema):
    return sorted(tuple(r) for r in batched.output(spark, root, schema).collect())


def test_a_late_resolve_closes_what_was_open_at_its_time(spark, folder):
    write = batched.incident_writer(folder)
    first = [("a", "trigger", T0, 0), ("a", "trigger", T0 + 2000, 2)]
    write(spark.createDataFrame(first, ALERTS), 0)
    write(spark.createDataFrame([("a", "resolve", T0 + 1000, 1)], ALERTS), 1)
    write(spark.createDataFrame([("a", "resolve", T0 + 3000, 3)], ALERTS), 2)
    assert put_out(spark, folder, batched.INCIDENT_OUTPUT) == [
        ("a", T0, T0 + 1000, 1, "resolved"), ("a", T0 + 2000, T0 + 3000, 1, "resolved"),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_incidents_over_files_with_overlapping_times(spark, folder, seed):
    rnd = random.Random(seed)
    rows = [(f"k{rnd.randrange(4)}", rnd.choice(["trigger", "trigger", "resolve"]), T0 + i * 500 // 3 * 3, i) for i in range(150)]
    rows += [("k0", a, T0 + 30_000, 900 + i) for i, a in enumerate(("trigger", "resolve", "trigger", "resolve"))]
    arrives = sorted(rows, key=lambda r: r[2] + rnd.randrange(9000))
    for i in range(5):
        part = spark.createDataFrame(arrives[i * 31:(i + 1) * 31], ALERTS).coalesce(1)
        part.write.mode("append").parquet(folder + "/in")
    write = batched.incident_writer(folder + "/s", chunk_ms=7000, late_ms=20_000, hold_back=True)
    feed = ingest.file_stream(spark, folder + "/in", ALERTS, files_per_trigger=1)
    query = ingest.keep_bronze(feed, write, folder + "/cp", once=True)
    query.awaitTermination()
    assert query.exception() is None
    for _ in range(2):  # the last call can run again
        write(spark.createDataFrame([], ALERTS), 5, final=True)
    want = alerts.incidents(spark.createDataFrame(rows, ALERTS)).where("state = 'resolved'")
    want = sorted(tuple(r) for r in want.select("dedup_key", "opened_ms", "resolved_ms", "triggers", "state").collect())
    assert put_out(spark, folder + "/s", batched.INCIDENT_OUTPUT) == want and want


def test_old_triggers_of_an_open_incident_are_one_row(spark, folder):
    write = batched.incident_writer(folder, late_ms=1000)
    write(spark.createDataFrame([("a", "trigger", T0 + i, i) for i in range(50)], ALERTS), 0)
    write(spark.createDataFrame([("b", "trigger", T0 + 9000, 60)], ALERTS), 1)
    kept = spark.read.parquet(batched._slot(folder, 1)).where("event_action = 'trigger'")
    assert {(r.dedup_key, r.ts_ms, r.weight, r.last_ms) for r in kept.collect()} == {
        ("a", T0, 50, T0 + 49), ("b", T0 + 9000, 1, T0 + 9000),
    }


def test_a_late_event_is_not_sent_again(spark, folder):
    write = batched.repeat_writer(folder, 10 * MINUTE)
    for i, (group, at) in enumerate([("a", T0), ("b", T0 + 11 * MINUTE), ("a", T0 + 2 * MINUTE)]):
        write(spark.createDataFrame([(group, at)], "group_key string, ts_ms long"), i)
    assert put_out(spark, folder, batched.NOTIFY_OUTPUT) == [("a", T0), ("b", T0 + 11 * MINUTE)]


@pytest.mark.parametrize("name", ["a", None])
def test_a_change_is_sent_without_a_further_event(spark, folder, name):
    write = batched.repeat_writer(folder, 240 * MINUTE)
    batches = [(name, T0, False), (name, T0 + MINUTE, True), ("b", T0 + 4 * MINUTE, False), ("b", T0 + 6 * MINUTE, False), (name, T0 + 7 * MINUTE, False)]
    for i, row in enumerate(batches):
        write(spark.createDataFrame([row], CHANGES), i)
    got = batched.output(spark, folder, batched.NOTIFY_OUTPUT).where(F.col("group_key").eqNullSafe(F.lit(name)))
    assert sorted(r.notified_ms for r in got.collect()) == [T0, T0 + 5 * MINUTE]


def plain(rows, repeat, interval, tick, until):
    out, by = [], {}
    for group, at, changed in rows:
        ticks = by.setdefault(group, {})
        at = -(-at // tick) * tick
        ticks[at] = ticks.get(at, False) or changed
    for group, ticks in by.items():
        last, pending = None, False
        for at in range(min(ticks), until + 1, tick):
            there = at in ticks
            pending = pending or ticks.get(at, False)
            if (there and (last is None or at - last >= repeat)) or (pending and last is not None and at - last >= interval):
                out.append((group, at))
                last, pending = at, False
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_on_time_against_plain_ticks(spark, folder, seed):
    rnd = random.Random(seed)
    rows = sorted(((f"g{rnd.randrange(3)}", T0 + rnd.randrange(90 * MINUTE), rnd.random() < 0.2) for _ in range(60)), key=lambda r: r[1])
    until = T0 + 120 * MINUTE
    want = plain(rows, 30 * MINUTE, 5 * MINUTE, MINUTE, until)
    df = spark.createDataFrame(rows, CHANGES)
    got = alerts.notifications(
        df, ["group_key"], repeat_ms=30 * MINUTE, tick_ms=MINUTE, changed=F.col("changed"),
        interval_ms=5 * MINUTE, timed=True, until_ms=until,
    )
    assert sorted(tuple(r) for r in got.collect()) == want
    write = batched.repeat_writer(folder, 30 * MINUTE)
    tick = lambda r: -(-r[1] // MINUTE)
    bounds = [tick(rows[20]), tick(rows[40])]  # no tick is cut in two
    for i in range(3):
        part = [r for r in rows if sum(tick(r) > b for b in bounds) == i]
        write(spark.createDataFrame(part, CHANGES), i)
    write(spark.createDataFrame([("end", until, False)], CHANGES), 3)
    assert [r for r in put_out(spark, folder, batched.NOTIFY_OUTPUT) if r[0] != "end"] == want
