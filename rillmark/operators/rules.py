"""Threshold rules over metric samples, evaluated at every step of a range in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.operators.series import LABEL_SET, held_over_steps, label_set, last_per_step
from rillmark.operators.timeline import CHUNK_MS, islands
from rillmark.spec import RuleSpec, Selector


def sustained(
    samples: DataFrame,
    keys: Sequence[str],
    breach: str,
    hold_ms: int,
    ts: str = "ts_ms",
    max_gap_ms: int | None = None,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Runs in which `breach` held, with whether they held for at least `hold_ms`.

    Takes one row per key and time.
    """
    runs = islands(samples, keys, ts, breach, max_gap_ms, chunk_ms).where(F.col(breach))
    held = F.col("end_ms") - F.col("start_ms")
    return runs.select(
        *keys, "start_ms", "end_ms", "samples", held.alias("held_ms"),
        F.when(held >= hold_ms, "firing").otherwise("pending").alias("state"),
    )


def _selects(s: Selector) -> Column:
    tests = [F.col("metric") == s.metric]
    for label, value in s.equals:
        tests.append(F.coalesce(F.col("labels")[label], F.lit("")) == value)
    for label, pattern in s.matches:
        tests.append(
            F.coalesce(F.col("labels")[label], F.lit("")).rlike(f"^(?:{pattern})$")
        )
    return reduce(lambda a, b: a & b, tests)


def _kept_labels(rule: RuleSpec) -> Column:
    """Label entries that a rule's result keeps."""
    if rule.by is None:
        return label_set(F.col("labels"))
    pairs = [p for b in sorted(rule.by) for p in (F.lit(b), F.coalesce(F.col("labels")[b], F.lit("")))]
    return label_set(F.create_map(*pairs)) if pairs else F.lit(None)


def _sides(rules: Sequence[RuleSpec]) -> list[tuple[RuleSpec, bool, Selector]]:
    """(rule, is divisor, selector) for every selector of every rule."""
    out = []
    for r in rules:
        out.append((r, False, r.selector))
        if r.subject == "ratio":
            out.append((r, True, r.divisor))
    return out


def _by_rule(rules: Sequence[RuleSpec], pick) -> Column:
    """A per-rule literal or expression, chosen by the rule's name."""
    col = F.lit(None)
    for r in rules:
        col = F.when(F.col("rule") == r.name, pick(r)).otherwise(col)
    return col


def rule_values(
    samples: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """The compared value of every rule and series at every step.

    One scan serves all rules: the metric names go to the scan as a filter, and
    samples are cut to the last one per series and step before any rule looks
    at them. Each row is then handed to the rules that select it. The rules are
    a handful of literals in the plan, so nothing is joined or broadcast.
    """
    values = _values(samples, rules, start_ms, end_ms, step_ms, lookback_ms)
    return values.drop("divisors").where(F.col("value").isNotNull())


def _values(
    samples: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int, step_ms: int, lookback_ms: int
) -> DataFrame:
    """`rule_values` with rows that have no value, and the number of series that a row was divided by."""
    sides = _sides(rules)
    metrics = sorted({s.metric for _, _, s in sides})
    tagged = [
        F.when(
            _selects(s),
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(is_divisor).alias("is_divisor"),
                _kept_labels(r).alias("kept"),
            ),
        )
        for r, is_divisor, s in sides
    ]
    grid = (start_ms, end_ms, step_ms, lookback_ms)
    ties = [c for c in samples.columns if c == "seq"]
    watched = samples.where(F.col("metric").isin(*metrics)).select(
        "metric", label_set(F.col("labels")).alias(LABEL_SET), "ts_ms", "value", *ties
    )
    last = last_per_step(watched, ["metric", LABEL_SET], *grid)
    chosen = (
        last.withColumn("labels", F.map_from_entries(LABEL_SET))
        .withColumn("t", F.explode(F.array_compact(F.array(*tagged))))
        .select("t.rule", "t.is_divisor", "t.kept", LABEL_SET, "_tick", "_ts", "value")
    )
    ticks = held_over_steps(chosen, ["rule", "is_divisor", "kept", LABEL_SET], *grid)
    age = F.col("tick_ms") / 1000.0 - F.col("value")
    subject = F.when(
        F.col("rule").isin(*[r.name for r in rules if r.subject == "age"] or [""]), age
    ).otherwise(F.col("value"))
    top = F.when(~F.col("is_divisor"), subject)
    low = F.max(F.when(F.col("is_divisor"), F.col("value")))
    divisors = F.count(F.when(F.col("is_divisor"), 1))
    folds = {"max": F.max(top), "min": F.min(top), "sum": F.sum(top), "avg": F.avg(top)}
    folded = _by_rule(rules, lambda r: F.col(f"_{r.fold}"))
    is_ratio = F.col("rule").isin(*[r.name for r in rules if r.subject == "ratio"] or [""])
    return (
        ticks.groupBy("rule", "kept", "tick_ms")
        .agg(*[c.alias(f"_{n}") for n, c in folds.items()], low.alias("_low"), divisors.alias("divisors"))
        .withColumn("_top", folded)
        .select(
            "rule",
            F.map_from_entries("kept").alias("labels"),
            "tick_ms",
            F.when(is_ratio, F.when(F.col("_low") != 0, F.col("_top") / F.col("_low")))
            .otherwise(F.col("_top"))
            .alias("value"),
            "divisors",
        )
    )


def step_grid(
    samples: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int, step_ms: int
) -> DataFrame:
    """Every rule at every step: a handful of rules times the steps of the range."""
    spark = samples.sparkSession
    ticks = spark.range(start_ms, end_ms + 1, step_ms).withColumnRenamed("id", "tick_ms")
    names = F.array(*[F.lit(r.name) for r in rules])
    return ticks.select(F.explode(names).alias("rule"), "tick_ms")


def evaluate(
    samples: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """Every rule and series at every step: value, breach and no-data state.

    A step without any series takes the rule's no-data policy: `Alerting`
    counts as a breach, `NoData` does not.
    """
    values = rule_values(samples, rules, start_ms, end_ms, step_ms, lookback_ms)
    measured = values.select(
        "rule", "labels", "tick_ms", "value", _breach(rules).alias("breach"), F.lit("ok").alias("data_state")
    )
    return measured.unionByName(_missing(samples, values, rules, start_ms, end_ms, step_ms))


COMPARES = {
    "gt": lambda v, t: v > t, "lt": lambda v, t: v < t,
    "ge": lambda v, t: v >= t, "le": lambda v, t: v <= t,
}


def _breach(rules: Sequence[RuleSpec]) -> Column:
    return _by_rule(rules, lambda r: COMPARES[r.compare](F.col("value"), F.lit(r.threshold))).cast("boolean")


def _missing(
    samples: DataFrame, values: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int, step_ms: int
) -> DataFrame:
    """Steps at which a rule has no series, under its no-data policy."""
    seen = values.select("rule", "tick_ms").distinct()
    policy = _by_rule(rules, lambda r: F.lit(r.no_data))
    return (
        step_grid(samples, rules, start_ms, end_ms, step_ms)
        .join(seen, ["rule", "tick_ms"], "left_anti")
        .select(
            "rule",
            F.create_map().cast("map<string,string>").alias("labels"),
            "tick_ms",
            F.lit(None).cast("double").alias("value"),
            (policy == "Alerting").alias("breach"),
            policy.cast("string").alias("data_state"),
        )
    )


def faults(samples: DataFrame, rules: Sequence[RuleSpec]) -> dict[str, str]:
    """Rules whose expression cannot be built or analysed, with the reason; no job is run."""
    found = {}
    for r in rules:
        try:
            evaluate(samples, (r,), 0, 0).schema  # noqa: B018 - analyses the plan
        except Exception as error:  # noqa: BLE001 - any fault is that rule's own
            found[r.name] = f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
    return found


SEVERAL_DIVISORS = "several series to divide by"


def evaluate_isolated(
    samples: DataFrame, rules: Sequence[RuleSpec], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """`evaluate` where a rule that fails leaves the others alone; adds `error`.

    A rule whose expression cannot be built is in error at every step, one whose
    ratio has several series to divide by at the steps where that is so. Errors
    have the data state `Error` and count as a breach under `Alerting` only.
    """
    broken = faults(samples, rules)
    sound = [r for r in rules if r.name not in broken]
    no_labels = F.create_map().cast("map<string,string>")
    out = None
    if sound:
        alarms = F.col("rule").isin([r.name for r in sound if r.on_error == "Alerting"])
        several = F.col("divisors") > 1
        values = _values(samples, sound, start_ms, end_ms, step_ms, lookback_ms).where(several | F.col("value").isNotNull())
        measured = values.select(
            "rule", "labels", "tick_ms", F.when(~several, F.col("value")).alias("value"),
            F.when(several, alarms).otherwise(_breach(sound)).alias("breach"),
            F.when(several, _error_state(sound)).otherwise("ok").alias("data_state"),
            F.when(several, SEVERAL_DIVISORS).alias("error"),
        )
        missing = _missing(samples, values, sound, start_ms, end_ms, step_ms)
        out = measured.unionByName(missing.withColumn("error", F.lit(None).cast("string")))
    lost = [r for r in rules if r.name in broken]
    if lost:
        failed = step_grid(samples, lost, start_ms, end_ms, step_ms).select(
            "rule", no_labels.alias("labels"), "tick_ms", F.lit(None).cast("double").alias("value"),
            F.col("rule").isin([r.name for r in lost if r.on_error == "Alerting"]).alias("breach"),
            _error_state(lost).alias("data_state"), _by_rule(lost, lambda r: F.lit(broken[r.name])).cast("string").alias("error"),
        )
        out = failed if out is None else out.unionByName(failed)
    return out


def _error_state(rules: Sequence[RuleSpec]) -> Column:
    return _by_rule(rules, lambda r: F.lit("ok" if r.on_error == "OK" else "Error")).cast("string")


def with_state(
    evaluated: DataFrame, rules: Sequence[RuleSpec], step_ms: int = fv.RULE_STEP_MS
) -> DataFrame:
    """Adds `active_since_ms` and `state` (normal, pending, firing) at every step.

    A series is evaluated at most once per step, so its rows are bounded by the
    length of the range. A missing step ends a pending run. After
    `evaluate_isolated`, an error that is no breach is the state `error`.
    """
    in_error = F.col("data_state") == "Error" if "error" in evaluated.columns else F.lit(False)
    named = evaluated.withColumn(LABEL_SET, label_set(F.col("labels")))
    w = Window.partitionBy("rule", LABEL_SET).orderBy("tick_ms")
    goes_on = (
        F.col("breach")
        & F.lag("breach").over(w)
        & (F.col("tick_ms") - F.lag("tick_ms").over(w) == step_ms)
    )
    hold = _by_rule(rules, lambda r: F.lit(r.hold_ms)).cast("long")
    starts = F.when(F.col("breach") & ~F.coalesce(goes_on, F.lit(False)), F.col("tick_ms"))
    since = F.last("_start", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        named.withColumn("_start", starts)
        .withColumn("active_since_ms", F.when(F.col("breach"), since))
        .withColumn(
            "state",
            F.when(~F.col("breach"), F.when(in_error, "error").otherwise("normal"))
            .when(F.col("tick_ms") - F.col("active_since_ms") >= hold, "firing")
            .otherwise("pending"),
        )
        .drop("_start", LABEL_SET)
    )


def transitions(stated: DataFrame) -> DataFrame:
    """Steps at which a series starts or stops firing, as trigger and resolve events."""
    named = stated.withColumn(LABEL_SET, label_set(F.col("labels")))
    w = Window.partitionBy("rule", LABEL_SET).orderBy("tick_ms")
    firing = F.col("state") == "firing"
    before = F.coalesce(F.lag(firing).over(w), F.lit(False))
    return (
        named.withColumns({"_firing": firing, "_before": before})
        .where(F.col("_firing") != F.col("_before"))
        .select(
            "rule", "labels", "tick_ms", "value",
            F.when(F.col("_firing"), "trigger").otherwise("resolve").alias("event_action"),
        )
    )
