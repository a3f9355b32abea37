import pytest
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions import text
from rillmark.operators import rules, series
from rillmark.sources.messages import SAMPLE_SCHEMA
from rillmark.spec import RuleSpec, Selector, default_rules

MIN = 60_000


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE_SCHEMA)


def values(df):
    return {series_key(r["labels"]): r["value"] for r in df.collect()}


def series_key(labels):
    return ",".join(f"{k}={v}" for k, v in sorted(labels.items()))


def test_instant_vector_and_lookback(spark):
    df = samples(spark, [("m", {"a": "1"}, 1000, 1.0), ("m", {"a": "1"}, 2000, 2.0), ("m", {"a": "2"}, 500, 9.0)])
    assert values(series.instant_vector(df, 2000, 1500)) == {"a=1": 2.0}
    assert values(series.instant_vector(df, 1999, 1499)) == {"a=1": 1.0}
    assert values(series.instant_vector(df, 2000, 1501)) == {"a=1": 2.0, "a=2": 9.0}


def test_label_order_does_not_matter(spark):
    df = samples(spark, [("m", {"a": "1", "b": "2"}, 1, 1.0), ("m", {"b": "2", "a": "1"}, 2, 5.0)])
    assert values(series.instant_vector(df, 2)) == {"a=1,b=2": 5.0}


def test_matchers_are_anchored(spark):
    df = samples(spark, [("m", {"t": "ab"}, 1, 1.0), ("m", {"t": "b"}, 1, 2.0), ("m", {}, 1, 3.0)])
    assert series.matching(df, "m", matches={"t": "b"}).count() == 1
    assert series.matching(df, "m", matches={"t": ".+"}).count() == 2
    assert series.matching(df, "m", equals={"t": ""}).count() == 1


def test_folds(spark):
    vec = series.instant_vector(samples(spark, [("m", {"t": "x", "i": str(i)}, 1, float(i)) for i in range(4)]), 1)
    assert values(series.fold_by(vec, "sum", ["t"])) == {"t=x": 6.0}
    assert values(series.fold_by(vec, "avg")) == {"": 1.5}
    assert series.fold_by(vec.where("false"), "max").count() == 0


def test_joins(spark):
    gap = samples(spark, [("g", {"table": "a", "x": "1"}, 1, 4.0), ("g", {"table": "b", "x": "1"}, 1, 5.0)])
    run = samples(spark, [("r", {"table": "a"}, 1, 1000.0), ("r", {"table": "b"}, 1, 10.0)])
    mask = series.ran_recently(series.instant_vector(run, 1_200_000, 10**9), 1_200_000, 600)
    got = series.times_on(series.instant_vector(gap, 1), mask, ["table"])
    assert values(got) == {"table=a,x=1": 4.0, "table=b,x=1": 0.0}
    one = series.fold_by(series.instant_vector(gap, 1), "avg")
    assert values(series.times_scalar(one, series.fold_by(mask, "max"))) == {"": 4.5}
    assert series.times_scalar(one, one.where("false")).count() == 0


def test_ratio_by_zero_is_null(spark):
    a = samples(spark, [("n", {"i": "1"}, 1, 4.0), ("n", {"i": "2"}, 1, 4.0)])
    b = samples(spark, [("d", {"i": "1"}, 1, 2.0), ("d", {"i": "2"}, 1, 0.0)])
    got = values(series.ratio(series.instant_vector(a, 1), series.instant_vector(b, 1)))
    assert got == {"i=1": 2.0, "i=2": None}


def test_absent_or_and_bool(spark):
    vec = series.instant_vector(samples(spark, [("m", {"i": "1"}, 1, 0.0)]), 1)
    assert series.absent(vec).count() == 0
    assert values(series.absent(vec.where("false"), {"i": "9"})) == {"i=9": 1.0}
    other = series.instant_vector(samples(spark, [("m", {"i": "1"}, 1, 7.0), ("m", {"i": "2"}, 1, 8.0)]), 1)
    assert values(series.either(vec, other)) == {"i=1": 0.0, "i=2": 8.0}
    assert values(series.as_bool(other, "gt", 7.0)) == {"i=1": 0.0, "i=2": 1.0}
    assert values(series.keep_where(other, "gt", 7.0)) == {"i=2": 8.0}


def test_reducers(spark):
    df = samples(spark, [("m", {}, 1, 3.0), ("m", {}, 2, 1.0), ("m", {}, 3, None)])
    one = lambda r: values(series.reduce_series(df, 3, 10, r))[""]
    assert (one("last"), one("lastNotNull"), one("max")) == (None, 1.0, 3.0)
    with pytest.raises(ValueError):
        series.reduce_series(df, 3, 10, "median")


def test_bands(spark):
    df = spark.createDataFrame([(None,), (0.79,), (0.8,), (0.95,)], "v double")
    got = [r[0] for r in df.select(series.band(F.col("v"), "pass_through")).collect()]
    assert got == ["No Data", "red", "yellow", "green"]
    got = [r[0] for r in df.select(series.band(F.col("v") * 1000, "spark_status")).collect()]
    assert got == ["No Data / DOWN", "red", "red", "red"]


def test_jmx_names(spark):
    bean = "debezium.postgres<type=connector-metrics, context=streaming, server=db1><>"
    df = spark.createDataFrame([(bean + "Connected", 1, 1.0), (bean + "Other", 1, 1.0)], "bean string, ts_ms long, value double")
    rows = series.jmx_samples(df).collect()
    assert [(r.metric, r.labels, r.metric_type) for r in rows] == [
        ("debezium_metrics_connected", {"connector": "db1"}, "gauge")]


def state_of(spark, rows, rule, end, step=MIN, lookback=5 * MIN):
    ev = rules.evaluate(samples(spark, rows), [rule], 0, end, step, lookback)
    out = rules.with_state(ev, [rule], step).orderBy("tick_ms").collect()
    return [(r.tick_ms // MIN, r.state) for r in out if r.tick_ms >= MIN]


def test_a_breach_must_hold(spark):
    rule = RuleSpec("r", Selector("m"), "gt", 10.0, 2 * MIN)
    rows = [("m", {}, i * MIN, v) for i, v in enumerate([0, 20, 20, 5, 20, 20, 20, 20], 0)]
    got = state_of(spark, [(m, l, t or 1, float(v)) for m, l, t, v in rows], rule, 7 * MIN)
    assert got == [(1, "pending"), (2, "pending"), (3, "normal"), (4, "pending"), (5, "pending"),
                   (6, "firing"), (7, "firing")]


def test_no_hold_fires_at_once_and_transitions(spark):
    rule = RuleSpec("r", Selector("m"), "lt", 1.0, 0)
    rows = [("m", {"i": "a"}, MIN, 1.0), ("m", {"i": "a"}, 2 * MIN, 0.0), ("m", {"i": "a"}, 4 * MIN, 1.0)]
    ev = rules.evaluate(samples(spark, rows), [rule], 0, 5 * MIN, MIN)
    moves = rules.transitions(rules.with_state(ev, [rule], MIN)).orderBy("tick_ms").collect()
    assert [(r.tick_ms // MIN, r.event_action) for r in moves] == [(2, "trigger"), (4, "resolve")]


def test_no_data_policies(spark):
    calm = RuleSpec("calm", Selector("none"), "gt", 0.0, 0)
    loud = RuleSpec("loud", Selector("none"), "gt", 0.0, MIN, no_data="Alerting")
    ev = rules.evaluate(samples(spark, []), [calm, loud], MIN, 3 * MIN, MIN)
    got = {(r.rule, r.tick_ms // MIN): r.state for r in rules.with_state(ev, [calm, loud], MIN).collect()}
    assert [got["calm", i] for i in (1, 2, 3)] == ["normal"] * 3
    assert [got["loud", i] for i in (1, 2, 3)] == ["pending", "firing", "firing"]


def test_a_broker_at_zero_fires(spark):
    broker = [r for r in default_rules("c", "g", "w") if r.selector.metric == "kafka_brokers"][0]
    rows = [("kafka_brokers", {}, i * MIN + 1, 0.0) for i in range(4)]
    assert state_of(spark, rows, broker, 4 * MIN)[-1] == (4, "firing")


def test_ratio_and_fold_rules(spark):
    heap = [r for r in default_rules("c", "g", "w") if r.subject == "ratio"][0]
    rows = [("jvm_memory_bytes_used", {"area": "heap"}, MIN, 90.0), ("jvm_memory_bytes_max", {"area": "heap"}, MIN, 100.0),
            ("jvm_memory_bytes_used", {"area": "nonheap"}, MIN, 1.0)]
    got = rules.rule_values(samples(spark, rows), [heap], 0, 2 * MIN).where("tick_ms = 60000").collect()
    assert [r.value for r in got] == [0.9]
    lag = [r for r in default_rules("c", "g", "w") if r.name == "CDC Kafka Consumer Lag Too High"][0]
    rows = [("kafka_consumergroup_lag", {"consumergroup": g, "topic": "t", "p": p}, MIN, v)
            for g, p, v in (("g", "0", 5.0), ("g", "1", 8.0), ("x", "0", 99.0))]
    got = rules.rule_values(samples(spark, rows), [lag], 0, MIN).collect()
    assert [(r.labels, r.value) for r in got] == [({"topic": "t"}, 8.0)]


def test_eight_rules():
    found = default_rules("c", "g", "w")
    assert len(found) == 8
    assert [r.hold_ms // MIN for r in found] == [0, 5, 15, 0, 1, 2, 2, 1]
    assert [r.threshold for r in found[4:7]] == [1000.0, 600.0, 900.0]


def test_gauges_long(spark):
    wide = spark.createDataFrame([("a", 1, None)], "t string, x int, y double")
    got = series.gauges_long(wide, ["x", "y"], F.create_map(F.lit("table"), F.col("t")), F.lit(5)).collect()
    assert [tuple(r) for r in got] == [("x", {"table": "a"}, 5, 1.0)]
    assert len(fv.GAUGES) == 8


def test_human_texts(spark):
    rows = [(0.0, "0", "0s"), (12.0, "12", "12s"), (59.5, "59.5", "59.5s"), (61.0, "61", "1m 1s"),
            (1234.0, "1.234k", "20m 34s"), (1234567.0, "1.235M", "14d 6h 56m 7s"), (3600.0, "3.6k", "1h 0m 0s"),
            (999950.0, "1000k", "11d 13h 45m 50s"), (0.005, "5m", "5ms"), (-90.0, "-90", "-1m 30s")]
    df = spark.createDataFrame([(r[0],) for r in rows], "v double")
    got = df.select("v", text.humanize(F.col("v")), text.humanize_duration(F.col("v"))).collect()
    assert [tuple(r) for r in got][:7] == rows[:7]
    assert got[8][1:] == rows[8][1:] and got[9][1:] == rows[9][1:]


def test_message_texts(spark):
    df = spark.createDataFrame(
        [("Value: 0.6666666666666666 does not", 3, 1), ("Value: 5.0E-4 x", 1000, 1000), ("no figure", 7, 7),
         ("Value: 0.9999 x", 10, 1)], "m string, t int, want int")
    got = df.select("want", text.violations_from_message(F.col("m"), F.col("t"))).collect()
    assert [r[1] for r in got] == [1, 1000, 7, 1]
    pct = spark.createDataFrame([(1, 3), (5, 32), (1, 0), (3, 3), (1, 1000)], "p int, t int")
    assert [r[0] for r in pct.select(text.percent_text(F.col("p"), F.col("t"))).collect()] == [
        "33.33%", "15.62%", "N/A", "100.00%", "0.10%"]
    con = spark.createDataFrame(
        [("UniquenessConstraint(Uniqueness(List(id)))", "Empty state for analyzer X"), ("plain", None)], "c string, m string")
    got = con.select(text.failed_constraint_message(F.col("c"), F.col("m"))).collect()
    assert [r[0] for r in got] == ["Uniqueness: no rows to evaluate", "plain: no detail"]


def plain_extrapolated(points, window):
    """Increase over the window before each point, carried on to its start, point by point."""
    out = []
    for at, _ in points:
        inside = [(t, v) for t, v in points if at - window <= t <= at]
        if len(inside) < 2:
            out.append(None)
            continue
        climb = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:], strict=False))
        length = inside[-1][0] - inside[0][0]
        spacing = length / (len(inside) - 1)
        back = inside[0][0] - (at - window)
        back = spacing / 2 if back >= spacing * 1.1 else back
        if climb > 0:
            back = min(back, length * inside[0][1] / climb)
        out.append(climb * (length + back) / length)
    return out


def test_rates_carried_on_to_the_ends_of_the_window(spark):
    import random

    from rillmark.operators import series

    rnd, at, value, points = random.Random(6), 1_700_000_000_000, 0.0, []
    for _ in range(200):
        at += rnd.choice([200, 900, 1000, 4000, 11_000])
        value = 0.0 if rnd.random() < 0.05 else value + rnd.choice([0, 0, 1, 5])
        points.append((at, value))
    df = spark.createDataFrame([("s", t, v) for t, v in points], "k string, ts_ms long, value double")
    for window in (5000, 30_000):
        got = series.counter_rate(df, ["k"], window, 60_000, extrapolate=True).orderBy("ts_ms").collect()
        for r, want in zip(got, plain_extrapolated(points, window), strict=True):
            assert (r.increase is None) == (want is None)
            assert want is None or abs(r.increase - want) < 1e-9


def test_both_ends_and_zero_limit_an_extrapolation(spark):
    from pyspark.sql import functions as F

    from rillmark.operators.series import extrapolated

    def of(*args):
        return spark.range(1).select(extrapolated(*[F.lit(a) for a in args]).alias("x")).first()["x"]

    # Ten samples a second apart, half a second from both ends.
    assert of(9.0, 10, 500, 9500, 100.0, 0, 10_000) == 10.0
    # Far from the start and the end: half a spacing each.
    assert of(9.0, 10, 50_000, 59_000, 100.0, 0, 100_000) == 10.0
    # The counter was zero a quarter of a second before its first sample.
    assert of(9.0, 10, 500, 9500, 0.25, 0, 9500) == 9.25
    assert of(0.0, 2, 10, 20, 3.0, 0, 30) == 0.0 and of(1.0, 1, 10, 10, 1.0, 0, 30) is None


def test_a_rule_that_fails_leaves_the_others_alone(spark):
    from rillmark.operators import rules
    from rillmark.spec import RuleSpec, Selector

    minute, t = 60_000, 1_700_000_040_000
    rows = [("m", {"a": "x"}, t, 5.0), ("m", {"a": "x"}, t + minute, 5.0), ("d", {"a": "x", "b": "1"}, t, 2.0), ("d", {"a": "x", "b": "2"}, t, 3.0)]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts_ms long, value double")
    ratio = {"subject": "ratio", "divisor": Selector("d"), "by": ("a",)}
    some = (
        RuleSpec("good", Selector("m"), "gt", 1.0, 0),
        RuleSpec("fold", Selector("m"), "gt", 1.0, 0, by=("a",), fold="median", on_error="Alerting"),
        RuleSpec("compare", Selector("m"), "near", 1.0, 0),
        RuleSpec("no divisor", Selector("m"), "gt", 1.0, 0, subject="ratio", on_error="OK"),
        RuleSpec("several", Selector("m"), "gt", 1.0, 0, **ratio), RuleSpec("alarm", Selector("m"), "gt", 1.0, minute, on_error="Alerting", **ratio),
    )
    assert set(rules.faults(df, some)) == {"fold", "compare", "no divisor"}
    stated = rules.with_state(rules.evaluate_isolated(df, some, t, t + minute, minute, minute), some, minute)
    got = {(r.rule, (r.tick_ms - t) // minute): (r.data_state, r.breach, r.state, r.error is not None) for r in stated.collect()}
    assert got == {
        ("good", 0): ("ok", True, "firing", False), ("good", 1): ("ok", True, "firing", False),
        ("fold", 0): ("Error", True, "firing", True), ("fold", 1): ("Error", True, "firing", True),
        ("compare", 0): ("Error", False, "error", True), ("compare", 1): ("Error", False, "error", True),
        ("no divisor", 0): ("ok", False, "normal", True), ("no divisor", 1): ("ok", False, "normal", True),
        ("several", 0): ("Error", False, "error", True), ("several", 1): ("NoData", False, "normal", False),
        ("alarm", 0): ("Error", True, "pending", True), ("alarm", 1): ("NoData", False, "normal", False),
    }
    assert rules.evaluate_isolated(df, some[2:3], t, t, minute).count() == 1
