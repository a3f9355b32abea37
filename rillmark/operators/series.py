"""Metric time series as DataFrames.

Samples have the columns ``metric``, ``labels`` (MAP<STRING,STRING>), ``ts_ms``
and ``value``, and ``seq`` where samples have an order of their own: of several
in one millisecond the one that came first counts. An instant vector has one row per series: ``metric``, ``labels``,
``value``. Labels are grouped and joined through their sorted entries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions.times import ceil_to
from rillmark.operators.timeline import with_halo

LABEL_SET = "label_set"


def label_set(labels: Column) -> Column:
    """Labels as sorted entries: equal maps give equal arrays."""
    return F.sort_array(F.map_entries(labels))


def labels_text(labels: Column) -> Column:
    """`a=1,b=2` in label order."""
    return F.array_join(
        F.transform(label_set(labels), lambda e: F.concat_ws("=", e["key"], e["value"])), ","
    )


def matching(
    samples: DataFrame,
    metric: str,
    equals: Mapping[str, str] | None = None,
    matches: Mapping[str, str] | None = None,
) -> DataFrame:
    """Samples of one metric; regular expressions match the whole label value.

    A missing label counts as empty text.
    """
    out = samples.where(F.col("metric") == metric)
    for label, value in (equals or {}).items():
        out = out.where(F.coalesce(F.col("labels")[label], F.lit("")) == value)
    for label, pattern in (matches or {}).items():
        out = out.where(F.coalesce(F.col("labels")[label], F.lit("")).rlike(f"^(?:{pattern})$"))
    return out


def _order(samples: DataFrame) -> Column:
    """What the newest sample is largest by: its time and, where `seq` tells, having come first."""
    return F.struct("ts_ms", -F.col("seq")) if "seq" in samples.columns else F.col("ts_ms")


def instant_vector(
    samples: DataFrame, at_ms: int, lookback_ms: int = fv.LOOKBACK_MS
) -> DataFrame:
    """The newest sample of every series at `at_ms`, not older than the lookback.

    The time bounds are plain comparisons, so they reach the scan; the newest
    sample is an aggregate that combines before the shuffle.
    """
    near = samples.where((F.col("ts_ms") <= at_ms) & (F.col("ts_ms") > at_ms - lookback_ms))
    return _per_series(near, F.max_by("value", _order(near)))


def _per_series(samples: DataFrame, value: Column) -> DataFrame:
    return (
        samples.withColumn(LABEL_SET, label_set(F.col("labels")))
        .groupBy("metric", LABEL_SET)
        .agg(value.alias("value"))
        .select("metric", F.map_from_entries(LABEL_SET).alias("labels"), "value")
    )


def reduce_series(samples: DataFrame, at_ms: int, range_ms: int, reducer: str | Sequence[str]) -> DataFrame:
    """One value per series over a range: `last`, `lastNotNull`, `max`, `min`, `mean` or `sum`.

    With several reducers, one row per series and `reducer`, from one aggregate.
    """
    value, ts, order = F.col("value"), F.col("ts_ms"), _order(samples)
    reducers = {
        "last": F.max_by(value, order),
        "lastNotNull": F.max_by(value, F.when(value.isNotNull(), order)),
        "max": F.max(value),
        "min": F.min(value),
        "mean": F.avg(value),
        "sum": F.sum(value),
    }
    wanted = [reducer] if isinstance(reducer, str) else list(reducer)
    if unknown := [r for r in wanted if r not in reducers]:
        raise ValueError(f"unknown reducer {unknown[0]!r}")
    near = samples.where((ts <= at_ms) & (ts > at_ms - range_ms))
    if isinstance(reducer, str):
        return _per_series(near, reducers[reducer])
    each = F.array(*(F.struct(F.lit(r).alias("reducer"), reducers[r].cast("double").alias("value")) for r in wanted))
    folded = _per_series(near, each).select("metric", "labels", F.explode("value").alias("r"))
    return folded.select("metric", "labels", "r.reducer", "r.value")


def fold_by(vector: DataFrame, fold: str, by: Sequence[str] = ()) -> DataFrame:
    """`max`, `min`, `sum`, `avg` or `count` over series, keeping only the labels in `by`."""
    folds = {"max": F.max, "min": F.min, "sum": F.sum, "avg": F.avg, "count": F.count}
    kept = [F.coalesce(F.col("labels")[b], F.lit("")).alias(b) for b in by]
    value = folds[fold]("value").cast("double").alias("value")
    if not by:
        # No row for no series, as a vector without series is empty.
        return (
            vector.agg(value, F.count(F.lit(1)).alias("_n"))
            .where("_n > 0")
            .select(F.create_map().cast("map<string,string>").alias("labels"), "value")
        )
    pairs = [p for b in by for p in (F.lit(b), F.col(b))]
    return (
        vector.select(*kept, "value")
        .groupBy(*by)
        .agg(value)
        .select(F.create_map(*pairs).alias("labels"), "value")
    )


def age_seconds(vector: DataFrame, at_ms: int) -> DataFrame:
    """Evaluation time minus a value that is a Unix time in seconds."""
    return vector.withColumn("value", F.lit(at_ms / 1000.0) - F.col("value"))


def _holds(compare: str, left: Column, right: Column) -> Column:
    return {
        "gt": left > right,
        "ge": left >= right,
        "lt": left < right,
        "le": left <= right,
        "eq": left == right,
        "ne": left != right,
    }[compare]


def keep_where(vector: DataFrame, compare: str, threshold: float) -> DataFrame:
    """Comparison as a filter: series that hold keep their value."""
    return vector.where(_holds(compare, F.col("value"), F.lit(threshold)))


def as_bool(vector: DataFrame, compare: str, threshold: float) -> DataFrame:
    """Comparison as 0/1 for every series."""
    held = _holds(compare, F.col("value"), F.lit(threshold))
    return vector.withColumn("value", held.cast("int").cast("double"))


def ran_recently(last_run: DataFrame, at_ms: int, within_s: int = fv.RECENT_RUN_S) -> DataFrame:
    """1 where the last run (Unix seconds) is within the limit, else 0."""
    return as_bool(last_run, "gt", at_ms / 1000.0 - within_s)


def times_on(many: DataFrame, one: DataFrame, on: Sequence[str]) -> DataFrame:
    """Many-to-one product on some labels; the labels of the many side stay.

    Both sides are instant vectors: their size is the number of series. Two
    series of the one side with equal labels are an error, not a double result.
    """
    cols = [F.coalesce(F.col("labels")[c], F.lit("")).alias(f"_{c}") for c in on]
    keys = [f"_{c}" for c in on]
    alone = F.assert_true(F.count(F.lit(1)) == 1, "the one side has several series with the same labels")
    factor = one.select(*cols, "value").groupBy(*keys).agg(F.max("value").alias("_factor"), alone.alias("_alone"))
    factor = factor.where(F.col("_alone").isNull()).drop("_alone")
    return (
        many.select("*", *cols)
        .join(factor, keys)
        .select("labels", (F.col("value") * F.col("_factor")).alias("value"))
    )


def times_scalar(left: DataFrame, right: DataFrame) -> DataFrame:
    """Product of two vectors of at most one series each, matched on no label.

    The two rows meet in one aggregate over their union; if either side is
    empty there is no result.
    """
    both = left.select(F.lit(True).alias("is_left"), "value").unionByName(
        right.select(F.lit(False).alias("is_left"), "value")
    )
    is_left = F.col("is_left")
    return (
        both.agg(
            F.max(F.when(is_left, F.col("value"))).alias("l"),
            F.max(F.when(~is_left, F.col("value"))).alias("r"),
        )
        .where("l is not null and r is not null")
        .select(
            F.create_map().cast("map<string,string>").alias("labels"),
            (F.col("l") * F.col("r")).alias("value"),
        )
    )


def ratio(numerator: DataFrame, denominator: DataFrame) -> DataFrame:
    """Quotient of series with the same labels; null where the divisor is zero."""
    top = numerator.select(label_set(F.col("labels")).alias(LABEL_SET), F.col("value").alias("n"))
    low = denominator.select(label_set(F.col("labels")).alias(LABEL_SET), F.col("value").alias("d"))
    quotient = F.when(F.col("d") != 0, F.col("n") / F.col("d"))
    return top.join(low, LABEL_SET).select(
        F.map_from_entries(LABEL_SET).alias("labels"), quotient.alias("value")
    )


def absent(vector: DataFrame, labels: Mapping[str, str] | None = None) -> DataFrame:
    """One series with value 1 if the vector has none, else no series."""
    pairs = [F.lit(x) for kv in (labels or {}).items() for x in kv]
    return (
        vector.agg(F.count(F.lit(1)).alias("n"))
        .where("n = 0")
        .select(
            F.create_map(*pairs).cast("map<string,string>").alias("labels"),
            F.lit(1.0).alias("value"),
        )
    )


def either(left: DataFrame, right: DataFrame) -> DataFrame:
    """All of `left`, plus the series of `right` whose labels are not in `left`."""
    named = label_set(F.col("labels"))
    extra = right.select("labels", "value", named.alias(LABEL_SET)).join(
        left.select(named.alias(LABEL_SET)), LABEL_SET, "left_anti"
    )
    return left.select("labels", "value").unionByName(extra.select("labels", "value"))


def counter_rate(
    samples: DataFrame,
    keys: Sequence[str],
    window_ms: int = fv.LOOKBACK_MS,
    chunk_ms: int = 3_600_000,
    extrapolate: bool = False,
) -> DataFrame:
    """Adds `increase` and `rate` (per second) over the window that ends at each sample.

    Takes one sample per key and `ts_ms`. A drop of the counter is a restart
    from zero. With `extrapolate` the increase is carried on to the window's
    ends (`extrapolated`); a window with one sample then has none. The work runs
    inside time chunks that repeat one window length of the chunk before.

    A sliding frame would go over a window's samples again for every row.
    Instead each sample also puts a probe at the start of its window, and one
    pass back in time hands the probe the next sample's climb, so the cost does
    not depend on how many samples a window holds.
    """
    cut = with_halo(samples, "ts_ms", window_ms, chunk_ms)
    order = Window.partitionBy(*keys, "_chunk").orderBy("ts_ms")
    previous = F.lag("value").over(order)
    step = F.when(F.col("value") >= previous, F.col("value") - previous).otherwise(F.col("value"))
    climbed = cut.withColumn(
        "_step", F.when(previous.isNull(), F.lit(0.0)).otherwise(step)
    ).withColumns({
        "_climb": F.sum("_step").over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "_no": F.row_number().over(order),
    })

    sample = F.struct(F.col("ts_ms").alias("at"), F.lit(False).alias("is_probe"))
    probe = F.struct((F.col("ts_ms") - window_ms).alias("at"), F.lit(True).alias("is_probe"))
    places = F.when(F.col("_halo"), F.array(sample)).otherwise(F.array(sample, probe))
    placed = climbed.withColumn("_place", F.explode(places))
    is_probe = F.col("_place.is_probe")
    # A sample exactly at the start of a window belongs to it.
    back = Window.partitionBy(*keys, "_chunk").orderBy(F.col("_place.at").desc(), is_probe).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    at_start = F.struct("_climb", "_no", "ts_ms", "value")
    first = F.last(F.when(~is_probe, at_start), ignorenulls=True).over(back)
    seen = placed.withColumn("_first", first).where(is_probe)
    climb = F.col("_climb") - F.col("_first._climb")
    if extrapolate:
        climb = extrapolated(
            climb, F.col("_no") - F.col("_first._no") + 1, F.col("_first.ts_ms"), F.col("ts_ms"), F.col("_first.value"),
            F.col("ts_ms") - window_ms, F.col("ts_ms"),
        )
    return (
        seen.withColumn("increase", climb)
        .withColumn("rate", F.col("increase") / (window_ms / 1000.0))
        .drop("_chunk", "_halo", "_step", "_climb", "_place", "_no", "_first")
    )


#: Fixed value: a gap at an end of the window up to so many mean spacings is taken as covered by the series.
COVERED_SPACINGS = 1.1


def extrapolated(
    climb: Column, n: Column, first_ms: Column, last_ms: Column, first_value: Column, start_ms: Column, end_ms: Column
) -> Column:
    """A counter's climb between its first and last sample, carried on to the ends of a window.

    An end that lies within `COVERED_SPACINGS` mean spacings of a sample is
    reached; towards one farther off, the series is taken to go on for half a
    spacing. Backwards a counter goes no farther than to where it would have
    been zero. Null for fewer than two samples.
    """
    length = (last_ms - first_ms).cast("double")
    spacing = length / (n - 1)

    def reach(gap: Column) -> Column:
        gap = gap.cast("double")
        return F.when(gap >= spacing * COVERED_SPACINGS, spacing / 2).otherwise(gap)

    to_zero = F.when((climb > 0) & (first_value >= 0), length * (first_value / climb))
    back = F.least(reach(first_ms - start_ms), to_zero)  # a null to_zero is no limit
    return F.when((n > 1) & (length > 0), climb * (length + back + reach(end_ms - last_ms)) / length)


def last_per_step(
    samples: DataFrame, keys: Sequence[str], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """The last sample per key and step that any step of the range can see.

    One aggregate, combined before the shuffle. From here on a key has at most
    one row per step, however many samples came in.
    """
    tick = start_ms + ceil_to(F.col("ts_ms") - start_ms, step_ms)
    return (
        samples.where((F.col("ts_ms") > start_ms - lookback_ms) & (F.col("ts_ms") <= end_ms))
        .groupBy(*keys, tick.alias("_tick"))
        .agg(F.max_by("value", _order(samples)).alias("value"), F.max("ts_ms").alias("_ts"))
    )


def held_over_steps(
    last: DataFrame, keys: Sequence[str], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """`last_per_step` rows at every step they stand for: (keys, tick_ms, value).

    A sample holds until the next one takes over or the lookback ends; one
    exactly one lookback old is out. The window over a key is bounded by the
    number of steps, and a row stands for at most lookback/step steps.
    """
    following = F.lead("_tick").over(Window.partitionBy(*keys).orderBy("_tick"))
    stale = F.col("_ts") + (lookback_ms - 1)
    until = F.least(F.coalesce(following - step_ms, F.lit(end_ms)), stale, F.lit(end_ms))
    since = F.greatest(F.col("_tick"), F.lit(start_ms))
    return (
        last.withColumns({"_since": since, "_until": until})
        .where("_since <= _until")
        .select(
            *keys,
            F.explode(F.sequence("_since", "_until", F.lit(step_ms))).alias("tick_ms"),
            "value",
        )
    )


def at_steps(
    samples: DataFrame, keys: Sequence[str], start_ms: int, end_ms: int,
    step_ms: int = fv.RULE_STEP_MS, lookback_ms: int = fv.LOOKBACK_MS,
) -> DataFrame:
    """The instant vector at every step of a range: (keys, tick_ms, value)."""
    last = last_per_step(samples, keys, start_ms, end_ms, step_ms, lookback_ms)
    return held_over_steps(last, keys, start_ms, end_ms, step_ms, lookback_ms)


def band(value: Column, name: str) -> Column:
    """Colour of a value in a named band table; null gives the no-data text."""
    bands = fv.BANDS[name]
    colour = F.when(value.isNull(), F.lit(fv.NO_DATA_TEXT.get(name, "No Data")))
    for low, text in reversed(bands):
        colour = colour.otherwise(text) if low is None else colour.when(value >= low, text)
    return colour


def gauges_long(wide: DataFrame, gauges: Sequence[str], labels: Column, ts_ms: Column) -> DataFrame:
    """Run figures in columns as metric samples, one row per gauge that has a value."""
    return (
        wide.select(labels.alias("labels"), ts_ms.cast("long").alias("ts_ms"),
                    *[F.col(g).cast("double").alias(g) for g in gauges])
        .unpivot(["labels", "ts_ms"], list(gauges), "metric", "value")
        .where(F.col("value").isNotNull())
        .select("metric", "labels", "ts_ms", "value")
    )


def jmx_samples(beans: DataFrame) -> DataFrame:
    """Bean readings (bean, ts_ms, value) as samples; beans without a rule are left out."""
    name, kind = F.lit(None).cast("string"), F.lit(None).cast("string")
    for attribute, metric, metric_type in reversed(fv.JMX_RULES):
        found = F.col("bean").rlike(fv.JMX_BEAN_PREFIX + attribute)
        name = F.when(found, metric).otherwise(name)
        kind = F.when(found, metric_type).otherwise(kind)
    server = F.regexp_extract("bean", fv.JMX_BEAN_PREFIX, 1)
    return (
        beans.select(
            F.lower(name).alias("metric"),
            F.create_map(F.lit("connector"), server).alias("labels"),
            kind.alias("metric_type"),
            "ts_ms",
            "value",
        )
        .where(F.col("metric").isNotNull())
    )
