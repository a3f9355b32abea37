"""Stream state as DataFrames: incidents, sustained breaches and repeats per micro-batch.

Each micro-batch is joined with the small state the batch before left behind,
worked on by the batch operators, and leaves its own state. Keys that fill a
third of a batch are spread by time like in batch work, and no row passes
through Python.

State and output carry the batch id. A batch that runs again after a crash
reads the same earlier state and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.operators import alerts
from rillmark.operators.timeline import CHUNK_MS, fitting_chunk, islands, one_per_ms
from rillmark.sinks.bronze import replace_partitions

Writer = Callable[[DataFrame, int], None]
BATCH = "batch_id"
SLOTS = 3

INCIDENT_OUTPUT = (
    "dedup_key string, opened_ms long, resolved_ms long, triggers long, state string"
)
FIRING_OUTPUT = "series string, active_since_ms long, firing_ms long"
NOTIFY_OUTPUT = "group_key string, notified_ms long"
HELD_SCHEMA = "dedup_key string, event_action string, ts_ms long, seq long, weight long, last_ms long"
RUN_SCHEMA = "series string, since_ms long, last_ms long, fired boolean"
SENT_SCHEMA = "group_key string, sent_ms long, pending boolean"
#: Events come at most so much later than the newest one, unless told otherwise.
LATE_MS = 3_600_000
CLOCK = "clock"


def _slot(root: str, batch_id: int) -> str:
    """State folders are reused in turn: the one being written is never read."""
    return f"{root}/state/slot{batch_id % SLOTS}"


def _state(batch: DataFrame, root: str, batch_id: int, schema: str) -> DataFrame:
    """What the batch before left behind; nothing for the first batch."""
    spark = batch.sparkSession
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(f"{schema}, {BATCH} long")
        .parquet(_slot(root, batch_id - 1))
        .where(F.col(BATCH) == batch_id - 1)
        .drop(BATCH)
    )


def _keep(state: DataFrame, root: str, batch_id: int) -> None:
    state.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
        _slot(root, batch_id)
    )


def _emit(rows: DataFrame, root: str, batch_id: int) -> None:
    replace_partitions(rows.withColumn(BATCH, F.lit(batch_id)), f"{root}/out", (BATCH,))


def incident_writer(
    root: str, ttl_ms: int = 7 * 86_400_000, chunk_ms: int | None = None,
    late_ms: int = LATE_MS, hold_back: bool = False,
) -> Callable[..., None]:
    """`foreachBatch` function over (dedup_key, event_action, ts_ms, seq).

    Without a chunk width each batch is measured for one.

    Closed incidents go to `out`. One without a trigger for `ttl_ms` of event
    time is closed as expired, which bounds the state.

    The watermark is `late_ms` behind the newest event. What came after it is
    carried event by event, so a resolve that arrives late closes only what was
    open at its time; older triggers of an open incident are one row. Incidents
    are put out at once, and a trigger that arrives after its incident went out
    opens another. With `hold_back` they are put out when the watermark has
    passed their resolve: the result is then that of the batch operator for all
    events less than `late_ms` late, and a last call with `final` (its batch may
    be empty) puts out what was held. An event later than that is taken against
    the carried rows as they are.
    """

    def write(batch: DataFrame, batch_id: int, final: bool = False) -> None:
        state = _state(batch, root, batch_id, HELD_SCHEMA)
        new = batch.where(F.col("event_action").isin("trigger", "resolve")).select(
            "dedup_key", "event_action", "ts_ms", "seq", F.lit(1).cast("long").alias("weight"),
            F.col("ts_ms").alias("last_ms"),
        )
        width = chunk_ms or fitting_chunk(new, ["dedup_key"], "ts_ms")
        is_clock = F.col("event_action") == CLOCK
        events = state.where(~is_clock).unionByName(new)
        found = alerts.incidents(
            events, chunk_ms=width, weight=F.col("weight"), last=F.col("last_ms"), with_seq=True
        )
        # One row comes to the driver: the newest event time so far.
        now = state.where(is_clock).select("ts_ms").unionByName(batch.select("ts_ms")).agg(F.max("ts_ms")).first()[0]
        clock = F.lit(now).cast("long")
        due = clock if final or not hold_back else clock - late_ms
        is_open = F.col("state") == "open"
        expired = is_open & (F.col("last_trigger_ms") + ttl_ms <= due)
        graded = (
            found.withColumn("state", F.when(expired, "expired").otherwise(F.col("state")))
            .where((F.col("state") == "expired") | (F.col("resolved_ms") <= due)).persist()
        )
        columns = ["dedup_key", "opened_ms", "resolved_ms", "triggers", "state"]
        _emit(graded.select(columns), root, batch_id)
        # All events of a key up to its last incident put out are settled; an expired one is the key's last.
        end = F.when(F.col("state") == "expired", F.lit(2**62).cast("long")).otherwise(F.col("resolved_ms"))
        settled = graded.groupBy("dedup_key").agg(
            F.max(F.struct(end.alias("ts_ms"), F.col("resolved_seq").alias("seq"))).alias("settled")
        ).withColumnRenamed("dedup_key", "_key")
        left = events.join(settled, F.col("dedup_key").eqNullSafe(F.col("_key")), "left").where(
            F.col("settled").isNull() | (F.struct("ts_ms", "seq") > F.col("settled"))
        ).drop("_key", "settled")
        old = F.col("ts_ms") <= clock - late_ms
        # Up to the watermark only triggers of an incident still open are left, and resolves of nothing.
        first = F.min(F.struct("ts_ms", "seq"))
        summed = left.where(old & (F.col("event_action") == "trigger")).groupBy("dedup_key", "event_action").agg(
            first.alias("first"), F.sum("weight").alias("weight"), F.max("last_ms").alias("last_ms")
        ).select("dedup_key", "event_action", "first.ts_ms", "first.seq", "weight", "last_ms")
        kept = summed.unionByName(left.where(~old))
        if now is not None:
            tick = batch.sparkSession.createDataFrame([(None, CLOCK, now, 0, 0, now)], HELD_SCHEMA)
            kept = kept.unionByName(tick)
        _keep(kept, root, batch_id)
        graded.unpersist()

    return write


def sustained_writer(
    root: str, hold_ms: int, chunk_ms: int = CHUNK_MS, max_gap_ms: int | None = None
) -> Writer:
    """`foreachBatch` function over (series, ts_ms, breach).

    A breach that has held for `hold_ms` goes to `out` once, as of the moment
    it reached that time. With `max_gap_ms` a silence longer than that ends a
    breach, as a missing step does in a batch rule, and open runs that old are
    no longer carried.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _state(batch, root, batch_id, RUN_SCHEMA)
        # An open run goes on as one sample at its last time.
        rows = batch.select("series", "ts_ms", "breach").unionByName(
            before.select("series", F.col("last_ms").alias("ts_ms"), F.lit(True).alias("breach"))
        )
        samples = one_per_ms(rows, ["series"], "ts_ms", "breach")
        runs = islands(samples, ["series"], "ts_ms", "breach", max_gap_ms=max_gap_ms, chunk_ms=chunk_ms)
        goes_on = (F.col("r.series") == F.col("b.series")) & F.col("b.last_ms").between(
            F.col("r.start_ms"), F.col("r.end_ms")
        )
        held = (
            runs.where("breach").alias("r")
            .join(before.alias("b"), goes_on, "left")
            .select(
                "r.series", F.least("b.since_ms", "r.start_ms").alias("since_ms"), "r.end_ms",
                F.coalesce("b.fired", F.lit(False)).alias("was_fired"),
            )
            .withColumn("fired", F.col("was_fired") | (F.col("end_ms") - F.col("since_ms") >= hold_ms))
            .persist()
        )
        _emit(
            held.where("fired and not was_fired").select(
                "series", F.col("since_ms").alias("active_since_ms"),
                (F.col("since_ms") + hold_ms).alias("firing_ms"),
            ),
            root, batch_id,
        )
        # A run is still open if it ends with the newest sample of its series.
        newest = samples.groupBy("series").agg(F.max("ts_ms").alias("end_ms"))
        left = held.join(newest, ["series", "end_ms"]).select(
            "series", "since_ms", F.col("end_ms").alias("last_ms"), "fired"
        )
        if max_gap_ms is not None:
            now = samples.agg(F.max("ts_ms")).first()[0]
            if now is not None:
                left = left.where(F.col("last_ms") >= now - max_gap_ms)
        _keep(left, root, batch_id)
        held.unpersist()

    return write


def repeat_writer(
    root: str, repeat_ms: int = fv.REPEAT_INTERVAL_MS, tick_ms: int = fv.RULE_STEP_MS,
    interval_ms: int = fv.GROUP_INTERVAL_MS, late_ms: int = LATE_MS,
) -> Writer:
    """`foreachBatch` function over (group_key, ts_ms): notifications without repeats.

    With a boolean column `changed` a change of a group is sent again after
    `interval_ms`; a change that waits is carried and sent by the first batch
    whose newest event is at that tick or later, whether or not its group has
    events there. What was sent stays known until `late_ms` after its repeat
    time, so events at most so late are not sent again; one that came earlier
    in time than what is sent already is not sent.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        before = _state(batch, root, batch_id, SENT_SCHEMA)
        # One row comes to the driver: the batch's event time.
        now = batch.agg(F.max("ts_ms")).first()[0]
        moved = F.col("changed") if "changed" in batch.columns else None
        states = alerts.notification_states(
            batch, ["group_key"], "ts_ms", repeat_ms, tick_ms, last_sent=before, changed=moved,
            interval_ms=interval_ms, timed=True, until_ms=-(2**62) if now is None else now,
        ).persist()
        _emit(states.select("group_key", F.explode("sent").alias("notified_ms")), root, batch_id)
        left = states.select("group_key", "sent_ms", "pending")
        if now is not None:
            # A group whose repeat time is long over needs no state: it would be sent anyway.
            left = left.where(F.col("pending") | (F.col("sent_ms") + repeat_ms + late_ms > now))
        _keep(left, root, batch_id)
        states.unpersist()

    return write


def output(spark, root: str, schema: str) -> DataFrame:
    """What a writer has put out so far."""
    return spark.read.schema(f"{schema}, {BATCH} long").parquet(f"{root}/out").drop(BATCH)


def without_repeats(events: DataFrame, within: str = "4 hours") -> DataFrame:
    """The simple variant: one event per dedup key within a time, by the built-in operator."""
    return (
        events.withColumn("_ts", F.timestamp_millis("ts_ms"))
        .withWatermark("_ts", within)
        .dropDuplicatesWithinWatermark(["dedup_key"])
        .drop("_ts")
    )
