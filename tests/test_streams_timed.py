"""Streams with timers in the state store, against their batch twins and plain rules."""

import random

import pytest
from pyspark.sql import functions as F

from rillmark.operators import alerts
from rillmark.operators.rules import sustained
from rillmark.streaming import ingest, timed

T0 = 1_700_000_040_000  # a whole minute
ALERTS = "dedup_key string, event_action string, ts_ms long, seq long"


def run(spark, folder, make, rows, schema, files, late_by=0, end=10**8):
    """Runs a stream over files whose rows come up to `late_by` ms late, and one row long after all others."""
    rnd = random.Random(len(rows))
    at = schema.split(", ").index("ts_ms long")
    arriving = sorted(rows, key=lambda r: r[at] + rnd.randrange(late_by + 1))
    size = -(-len(rows) // files)
    parts = [arriving[i * size:(i + 1) * size] for i in range(files)]
    last = list(rows[0])
    last[0], last[at] = "~end", max(r[at] for r in rows) + end
    for part in [*parts, [tuple(last)]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder + "/in")
    df = spark.read.parquet(folder + "/in")
    out = make(ingest.file_stream(spark, folder + "/in", df.schema, files_per_trigger=1))
    query = (out.writeStream.format("parquet").option("path", folder + "/out")
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    assert query.exception() is None
    found = spark.read.schema(out.schema).parquet(folder + "/out").collect()
    return sorted((tuple(r) for r in found if r[0] != "~end"), key=repr), query


def test_incidents_with_late_events_equal_the_batch(spark, folder):
    rnd = random.Random(1)
    rows = [(f"k{rnd.randrange(4)}", rnd.choice(["trigger", "trigger", "resolve"]), T0 + i * 1000, i) for i in range(120)]
    rows += [("k1", "resolve", T0 + 5000, 900), ("k1", "trigger", T0 + 5000, 901)]
    got, _ = run(spark, folder, lambda s: timed.incidents(s, ttl_ms=10**12, late="20 seconds"), rows, ALERTS, 4, 15_000)
    want = alerts.incidents(spark.createDataFrame(rows, ALERTS)).where("state = 'resolved'")
    assert got == sorted((tuple(r) for r in want.select("dedup_key", "opened_ms", "resolved_ms", "triggers", "state").collect()), key=repr)
    assert got


def test_silent_incidents_expire_without_a_further_event(spark, folder):
    rows = [("a", "trigger", T0, 0), ("a", "trigger", T0 + 4000, 1), ("b", "trigger", T0, 2), ("b", "resolve", T0 + 5000, 3)]
    got, _ = run(spark, folder, lambda s: timed.incidents(s, ttl_ms=5000, late="1 second"), rows, ALERTS, 2)
    assert got == [("a", T0, None, 2, "expired"), ("b", T0, T0 + 5000, 1, "resolved")]


def test_sustained_breaches_with_late_samples_equal_the_batch(spark, folder):
    rnd = random.Random(5)
    rows = [(f"s{i % 3}", T0 + i * 1000 + (20_000 if i > 90 else 0), rnd.random() < 0.85) for i in range(150)]
    schema = "series string, ts_ms long, breach boolean"
    got, _ = run(spark, folder, lambda s: timed.sustained(s, 9000, 8000, "20 seconds"), rows, schema, 5, 15_000)
    runs = sustained(spark.createDataFrame(rows, schema), ["series"], "breach", 9000, max_gap_ms=8000, chunk_ms=5000)
    want = [(r.series, r.start_ms, r.start_ms + 9000) for r in runs.where("state = 'firing'").collect()]
    assert got == sorted(want, key=repr) and got


NOTICES = "group_key string, ts_ms long, changed boolean"


@pytest.mark.parametrize("changes", [False, True])
def test_notifications_with_late_events_equal_the_batch(spark, folder, changes):
    rnd = random.Random(7)
    rows = [(f"g{rnd.randrange(3)}", T0 + i * 777, changes and rnd.random() < 0.2) for i in range(150)]
    got, _ = run(
        spark, folder, lambda s: timed.notifications(s, 40_000, 1000, 7000, 0, "20 seconds"), rows, NOTICES, 4, 15_000
    )
    want = alerts.notifications(
        spark.createDataFrame(rows, NOTICES), ["group_key"], repeat_ms=40_000, tick_ms=1000, interval_ms=7000,
        changed=F.col("changed"), timed=True,
    )
    assert got == sorted((tuple(r) for r in want.collect()), key=repr) and got


def test_a_new_group_waits_for_its_first_notification(spark, folder):
    minute = 60_000
    rows = [("g", T0 + 1000, True), ("g", T0 + 20_000, True), ("h", T0 + 40_000, False), ("g", T0 + 2 * minute, True)]
    got, _ = run(spark, folder, lambda s: timed.notifications(s, late="1 second"), rows, NOTICES, 3, end=20 * minute)
    # Half a minute after the first event, at the next tick; the change after it waits for the interval.
    assert got == [("g", T0 + minute), ("g", T0 + 6 * minute), ("h", T0 + 2 * minute)]


def plain_notices(events, until, repeat, tick, interval, wait):
    """Tick by tick, as one would say it."""
    out, sent, pending, first = [], None, False, None
    for now in range(min(events)[0] // tick * tick, until + 1, tick):
        here = [e for e in events if now - tick < e[0] <= now]
        if sent is not None and now > sent + repeat and not pending:
            sent = None
        if sent is None and first is None and here:
            first = -(-(min(e[0] for e in here) + wait) // tick) * tick
        if first is not None:
            if now >= first:
                out.append(now)
                sent, pending, first = now, False, None
            continue
        if sent is None:
            continue
        pending = pending or any(e[1] for e in here)
        if (here and now - sent >= repeat) or (pending and now - sent >= interval):
            out.append(now)
            sent, pending = now, False
    return out


def test_the_rules_of_a_group_step_by_step():
    rnd = random.Random(3)
    for _ in range(200):
        machine = timed.Notices(rnd.choice([20, 40]), rnd.choice([1, 2, 4]), rnd.choice([6, 10]), rnd.choice([0, 3, 9]))
        events = sorted((rnd.randrange(120), i, rnd.random() < 0.3) for i in range(rnd.randrange(1, 25)))
        cut = rnd.randrange(len(events) + 1)
        state, out = None, []
        # In two steps, as two batches would take them.
        middle = machine.time(events[cut - 1]) if cut else 0
        for part, until in (([e for e in events if machine.time(e) <= middle], middle), ([e for e in events if machine.time(e) > middle], 400)):
            state, more = timed.advance(machine, state, part, until)
            out += more
        want = plain_notices([(e[0], e[2]) for e in events], 400, machine.repeat_ms, machine.tick_ms, machine.interval_ms, machine.wait_ms)
        assert [t for (t,) in out] == want


IDLE = 100_000


def test_idle_keys_cost_a_batch_nothing(spark, folder):
    many = spark.range(IDLE).selectExpr(
        "concat('k', id) as dedup_key", "'trigger' as event_action", f"{T0} + id % 10 as ts_ms", "id as seq"
    )
    many.coalesce(1).write.parquet(folder + "/in")
    few = spark.createDataFrame([("k5", "resolve", T0 + 60_000, 10**9)], ALERTS)
    later = spark.createDataFrame([("x", "trigger", T0 + 600_000, 10**9)], ALERTS)
    for df in (few, later):
        df.coalesce(1).write.mode("append").parquet(folder + "/in")
    out = timed.incidents(
        ingest.file_stream(spark, folder + "/in", many.schema, files_per_trigger=1), ttl_ms=10**9, late="1 second"
    )
    query = (out.writeStream.format("parquet").option("path", folder + "/out")
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
    query.awaitTermination()
    steps = {p["batchId"]: p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]}
    last = steps[max(steps)]
    assert last["numRowsTotal"] >= IDLE
    # Batches after the one that met all keys write what they touch: a few rows, whatever is idle.
    assert last["numRowsUpdated"] + last["numRowsRemoved"] < 20
    found = spark.read.parquet(folder + "/out").collect()
    assert [(r.dedup_key, r.resolved_ms) for r in found] == [("k5", T0 + 60_000)]
