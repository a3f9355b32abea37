import random
import re

import pytest
from pyspark.sql import functions as F

from rillmark.operators import alerts, series
from rillmark.operators.timeline import events_since_last, fitting_chunk, islands, running_total


def feed(seed, n=400, keys=3, span=5000):
    """Random rows of which one key holds most."""
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(keys)}"
    return rnd, [(key(), rnd.randrange(1, span), i) for i in range(n)]


@pytest.mark.parametrize("seed,chunk", [(1, 10), (2, 97), (3, 1000), (4, 100_000)])
def test_running_total(spark, seed, chunk):
    _, rows = feed(seed)
    df = spark.createDataFrame(rows, "k string, ts_ms long, n int")
    got = {(r.k, r.ts_ms): r.t for r in running_total(df, ["k"], "ts_ms", F.col("n"), "t", chunk).collect()}
    want = {}
    for k, t, _ in rows:
        want[k, t] = sum(n for kk, tt, n in rows if kk == k and tt <= t)
    assert got == want


@pytest.mark.parametrize("seed,chunk,gap", [(1, 10, None), (2, 97, None), (3, 300, 20), (4, 100_000, 5), (5, 7, 30)])
def test_islands(spark, seed, chunk, gap):
    rnd, rows = feed(seed)
    p = rnd.choice([0.3, 0.5, 0.9])
    flags = {(k, t): rnd.random() < p for k, t, _ in rows}
    df = spark.createDataFrame([(k, t, f) for (k, t), f in flags.items()], "k string, ts_ms long, f boolean")
    got = {tuple(r) for r in islands(df, ["k"], "ts_ms", "f", gap, chunk).collect()}
    want, last = set(), None
    for (k, t), f in sorted(flags.items()):
        if last and last[0] == k and last[1] == f and (gap is None or t - last[3] <= gap):
            last = (k, f, last[2], t, last[4] + 1)
        else:
            want.add(last)
            last = (k, f, t, t, 1)
    want.add(last)
    assert got == want - {None}


@pytest.mark.parametrize("seed,chunk", [(1, 10), (2, 97), (3, 1000), (4, 100_000), (5, 3)])
def test_incidents(spark, seed, chunk):
    rnd, rows = feed(seed)
    p = rnd.choice([0.2, 0.5, 0.8])
    rows = [(k, t, i, "resolve" if rnd.random() < p else "trigger") for k, t, i in rows]
    df = spark.createDataFrame(rows, "dedup_key string, ts_ms long, seq long, event_action string")
    got = {(r.dedup_key, r.opened_ms, r.resolved_ms, r.triggers, r.last_trigger_ms)
           for r in alerts.incidents(df, chunk_ms=chunk).collect()}
    want, open_ = set(), {}
    for k, t, _, a in sorted(rows, key=lambda r: (r[1], r[2])):
        if a == "trigger":
            o = open_.get(k)
            open_[k] = (o[0], o[1] + 1, t) if o else (t, 1, t)
        elif k in open_:
            o = open_.pop(k)
            want.add((k, o[0], t, o[1], o[2]))
    want |= {(k, o[0], None, o[1], o[2]) for k, o in open_.items()}
    assert got == want


@pytest.mark.parametrize("seed,chunk", [(1, 10), (2, 97), (3, 1000), (4, 100_000), (5, 3)])
def test_events_since_last(spark, seed, chunk):
    rnd, rows = feed(seed)
    rows = [(k, t, i, rnd.choice(["fail", "fail", "ok", "skip"])) for k, t, i in rows]
    df = spark.createDataFrame(rows, "k string, ts_ms long, seq long, s string")
    got = {r.seq: r.c for r in events_since_last(
        df, ["k"], "ts_ms", ["seq"], F.col("s") == "fail", F.col("s") == "ok", "c", chunk).collect()}
    want, streak = {}, {}
    for k, t, i, s in sorted(rows, key=lambda r: (r[1], r[2])):
        streak[k] = 0 if s == "ok" else streak.get(k, 0) + (s == "fail")
        want[i] = streak[k]
    assert got == want


@pytest.mark.parametrize("seed,window,chunk", [(1, 50, 50), (2, 100, 230), (3, 300, 1000), (4, 10, 100_000)])
def test_counter_rate(spark, seed, window, chunk):
    rnd, rows = feed(seed, n=250)
    points = {}
    for k, t, _ in rows:
        points[k, t] = float(rnd.randrange(30))
    df = spark.createDataFrame([(k, t, v) for (k, t), v in points.items()], "k string, ts_ms long, value double")
    got = {(r.k, r.ts_ms): r.increase for r in series.counter_rate(df, ["k"], window, chunk).collect()}
    for (k, t) in points:
        inside = sorted((tt, v) for (kk, tt), v in points.items() if kk == k and t - window <= tt <= t)
        steps = [b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(inside, inside[1:])]
        assert got[k, t] == pytest.approx(sum(steps))
    assert len(got) == len(points)


@pytest.mark.parametrize("seed", [1, 2])
def test_values_at_steps(spark, seed):
    rnd, rows = feed(seed, n=150)
    points = {(k, t): float(rnd.randrange(100)) for k, t, _ in rows}
    df = spark.createDataFrame([(k, t, v) for (k, t), v in points.items()], "k string, ts_ms long, value double")
    start, end, step, back = 400, 4400, 60, 150
    got = {(r.k, r.tick_ms): r.value for r in series.at_steps(df, ["k"], start, end, step, back).collect()}
    want = {}
    for tick in range(start, end + 1, step):
        for k in {k for k, _ in points}:
            near = [(t, v) for (kk, t), v in points.items() if kk == k and tick - back < t <= tick]
            if near:
                want[k, tick] = max(near)[1]
    assert got == want


@pytest.mark.parametrize("seed,tick,repeat", [(1, 10, 200), (2, 1, 50), (3, 60, 60)])
def test_notifications(spark, seed, tick, repeat):
    _, rows = feed(seed)
    df = spark.createDataFrame(rows, "k string, ts_ms long, n int")
    got = {tuple(r) for r in alerts.notifications(df, ["k"], repeat_ms=repeat, tick_ms=tick).collect()}
    want, last = set(), {}
    for k, t, _ in sorted(rows, key=lambda r: r[1]):
        at = -(-t // tick) * tick
        if k not in last or at - last[k] >= repeat:
            last[k] = at
            want.add((k, at))
    assert got == want


@pytest.mark.parametrize("seed,tick,repeat,interval", [(1, 10, 400, 50), (2, 1, 900, 100), (3, 60, 600, 60)])
def test_notifications_on_change(spark, seed, tick, repeat, interval):
    rnd, rows = feed(seed)
    rows = [(k, t, rnd.random() < 0.1) for k, t, _ in rows]
    df = spark.createDataFrame(rows, "k string, ts_ms long, c boolean")
    got = {tuple(r) for r in alerts.notifications(
        df, ["k"], repeat_ms=repeat, tick_ms=tick, changed=F.col("c"), interval_ms=interval).collect()}
    merged = {}
    for k, t, c in rows:
        at = -(-t // tick) * tick
        merged[k, at] = merged.get((k, at), False) or c
    want, last, waiting = set(), {}, {}
    for (k, at), c in sorted(merged.items(), key=lambda r: r[0][1]):
        fresh = waiting.get(k, False) or c
        gap = at - last[k] if k in last else repeat
        if gap >= repeat or (fresh and gap >= interval):
            last[k], waiting[k] = at, False
            want.add((k, at))
        else:
            waiting[k] = fresh
    assert got == want


def test_fitting_chunk(spark):
    hour = 3_600_000
    # 9,000 rows in the first hour, 1,000 in the next nine.
    df = spark.range(10_000).selectExpr("'k' as k", f"if(id < 9000, id * 400, {hour} + (id - 9000) * 32400) as ts_ms")
    assert fitting_chunk(df, ["k"], "ts_ms", rows_per_chunk=900) == hour // 10
    assert fitting_chunk(df, ["k"], "ts_ms", rows_per_chunk=10_000, most_ms=7) == 7
    assert fitting_chunk(df.where("ts_ms < 0"), ["k"], "ts_ms", most_ms=7) == 7


def test_no_shuffle_is_by_the_key_alone(spark):
    """A hot key's rows go to many tasks: every shuffle of rows also has the chunk."""
    df = spark.range(2000).selectExpr("id % 2 as k", "id as ts_ms", "id % 7 < 3 as f", "id as seq",
                                      "if(id % 3 = 0, 'resolve', 'trigger') as event_action")
    for out in (islands(df, ["k"], "ts_ms", "f", chunk_ms=100), alerts.incidents(df, key="k", chunk_ms=100)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        moves = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert moves and all("_chunk" in m or "_group" in m for m in moves), moves
