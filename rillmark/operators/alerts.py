"""Alert events: building, parsing, keys, severity, incidents, repeats and the outbox.

An event frame has ``event_action``, ``dedup_key``, ``table``, ``error_type``,
``ts_ms`` and further columns; a message frame has ``key`` and ``value`` (JSON).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark import fixed_values as fv
from rillmark.functions import severity as sev
from rillmark.functions import text
from rillmark.functions.times import ceil_to, floor_to, iso_utc
from rillmark.operators.timeline import CHUNK_MS, events_since_last

# Fields of a trigger, a resolve and an infrastructure message.
TRIGGER_FIELDS = (
    "event_action", "dedup_key", "summary", "severity", "table", "error_type",
    "group", "component", "source", "timestamp", "custom_details",
)
RESOLVE_FIELDS = ("event_action", "dedup_key", "table", "error_type", "source", "timestamp")
INFRA_FIELDS = (
    "event_action", "error_type", "alert_title", "severity", "group", "component",
    "summary", "table", "source",
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "event_action", "dedup_key", "summary", "severity", "table", "error_type",
            "group", "component", "source", "timestamp", "custom_details", "alert_title",
        )
    ]
    + [T.StructField("_corrupt_record", T.StringType())]
)
_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
WEBHOOK_SCHEMA = T.StructType().add(
    "alerts",
    T.ArrayType(
        T.StructType()
        .add("status", T.StringType())
        .add("labels", _TEXT_MAP)
        .add("annotations", _TEXT_MAP)
    ),
)


# --- building events -------------------------------------------------------
def trigger_events(
    failures: DataFrame,
    *,
    table: Column,
    error_type: Column,
    summary: Column,
    severity: Column,
    details: Column,
    ts_ms: Column,
    group: Column | None = None,
    component: Column | None = None,
    suffix: Column | None = None,
) -> DataFrame:
    """Trigger events with all eleven fields, plus `ts_ms`."""
    own_component = F.concat(F.lit("spark-cdc/"), table)
    return failures.select(
        F.lit("trigger").alias("event_action"),
        text.dedup_key(table, error_type, suffix).alias("dedup_key"),
        summary.alias("summary"),
        severity.alias("severity"),
        table.alias("table"),
        error_type.alias("error_type"),
        (F.lit("data-quality") if group is None else group).alias("group"),
        (own_component if component is None else F.coalesce(text.blank_to_null(component), own_component))
        .alias("component"),
        F.lit(fv.ALERT_SOURCE).alias("source"),
        iso_utc(ts_ms).alias("timestamp"),
        F.coalesce(details, F.lit("{}")).alias("custom_details"),
        ts_ms.cast("long").alias("ts_ms"),
    )


def resolve_events(
    rows: DataFrame, *, table: Column, error_type: Column, ts_ms: Column, suffix: Column | None = None
) -> DataFrame:
    """Resolve events with all six fields, plus `ts_ms`."""
    return rows.select(
        F.lit("resolve").alias("event_action"),
        text.dedup_key(table, error_type, suffix).alias("dedup_key"),
        table.alias("table"),
        error_type.alias("error_type"),
        F.lit(fv.ALERT_SOURCE).alias("source"),
        iso_utc(ts_ms).alias("timestamp"),
        ts_ms.cast("long").alias("ts_ms"),
    )


def check_failure_events(
    report: DataFrame, table: str, as_of_ms: int, failures_so_far: int = 0, dashboard_url: str = ""
) -> DataFrame:
    """One trigger per failed check of a graded report."""
    name, kind = F.col("check_name"), F.col("error_type")
    rows = F.concat_ws("/", F.col("violation_rows"), F.col("total_rows"))
    empty = kind == "empty_table"
    named = (F.col("sev_label"), F.lit(table), name)
    summary = F.when(
        empty, F.format_string(fv.DQ_EMPTY_SUMMARY, *named, F.col("message"))
    ).otherwise(
        F.format_string(fv.DQ_SUMMARY, *named, rows, F.col("violation_pct"), F.col("message"))
    )
    details = F.to_json(
        F.struct(
            "sev_label",
            F.lit(failures_so_far).alias("consecutive_failures"),
            name.alias("check"),
            "message",
            F.when(~empty, F.col("violation_rows")).alias("violation_rows"),
            F.when(~empty, F.col("total_rows")).alias("total_rows"),
            F.when(~empty, F.col("violation_pct")).alias("violation_pct"),
            F.lit(dashboard_url).alias("dashboard_url"),
        )
    )
    return trigger_events(
        report.where(~F.col("passed")),
        table=F.lit(table), error_type=kind, summary=summary, severity=F.col("severity"),
        details=details, ts_ms=F.lit(as_of_ms), component=F.lit("spark/dq_checks"),
    )


def crash_events(outcomes: DataFrame, dashboard_url: str = "") -> DataFrame:
    """A trigger per crashed run: (table, failed_step, exception, message, consecutive_failures, ts_ms)."""
    step = F.coalesce("failed_step", F.lit("unknown"))
    details = F.to_json(
        F.struct(
            "consecutive_failures", step.alias("failed_step"), F.col("message").alias("exception"),
            F.lit(dashboard_url).alias("dashboard_url"),
        )
    )
    return trigger_events(
        outcomes.where(F.col("status") == "crashed"),
        table=F.col("table"), error_type=F.lit("unhandled_exception"),
        summary=F.format_string(fv.CRASH_SUMMARY, "table", step, "exception"),
        severity=F.lit("critical"), details=details, ts_ms=F.col("ts_ms"),
        group=F.lit("infrastructure"), component=F.lit("spark"),
    )


def freshness_gap(marks: DataFrame, as_of_ms: int) -> DataFrame:
    """Seconds since the mark of each table: (table, last_processed_ts_ms) gains `gap_seconds`."""
    return marks.where(F.col("last_processed_ts_ms").isNotNull()).withColumn(
        "gap_seconds", (F.lit(as_of_ms) - F.col("last_processed_ts_ms")) / 1000.0
    )


def freshness_events(
    marks: DataFrame, as_of_ms: int, limit_s: int = fv.FRESHNESS_LIMIT_S, severity: str = "critical",
    dashboard_url: str = "",
) -> DataFrame:
    """Per table with a mark: a trigger if the gap is over the limit, else a resolve.

    `marks` may carry `consecutive_failures`; without it the count is 0.

    `severity` is a parameter because the layers differ: the run grades old
    data as critical, the batch check as a warning.
    """
    gaps = freshness_gap(marks, as_of_ms)
    gap = F.col("gap_seconds")
    summary = F.format_string(
        fv.FRESHNESS_SUMMARY.format(limit=limit_s / 60), F.col("table"), gap / 60
    )
    failures = F.col("consecutive_failures") if "consecutive_failures" in marks.columns else F.lit(0)
    details = F.to_json(
        F.struct(
            failures.alias("consecutive_failures"), F.round(gap, 1).alias("freshness_gap_seconds"),
            F.lit(limit_s).alias("threshold_seconds"), F.lit(dashboard_url).alias("dashboard_url"),
        )
    )
    stale = trigger_events(
        gaps.where(gap > limit_s), table=F.col("table"), error_type=F.lit("stale_data"),
        summary=summary, severity=F.lit(severity), details=details, ts_ms=F.lit(as_of_ms),
        component=F.lit("spark/freshness_check"),
    )
    fresh = resolve_events(
        gaps.where(gap <= limit_s), table=F.col("table"), error_type=F.lit("stale_data"),
        ts_ms=F.lit(as_of_ms),
    )
    return stale.unionByName(fresh, allowMissingColumns=True)


# --- parsing events --------------------------------------------------------
def parse_events(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of JSON messages; a bad message never fails the job."""
    parsed = messages.withColumn(
        "_e",
        F.from_json(
            F.col(value).cast("string"), EVENT_SCHEMA,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
        ),
    )
    bad = F.col("_e").isNull() | F.col("_e._corrupt_record").isNotNull()
    others = [c for c in messages.columns if c != value]
    fields = [F.col(f"_e.{f.name}").alias(f.name) for f in EVENT_SCHEMA.fields[:-1]]
    return parsed.where(~bad).select(*others, *fields), parsed.where(bad).drop("_e")


def split_actions(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(triggers and resolves, events with an action nobody handles). No action means trigger."""
    action = F.coalesce("event_action", F.lit("trigger"))
    known = action.isin("trigger", "resolve")
    named = events.withColumn("event_action", action)
    return named.where(known), named.where(~known)


def webhook_alerts(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per entry of the `alerts` array of each webhook body."""
    others = [c for c in bodies.columns if c != body]
    parsed = F.from_json(F.col(body), WEBHOOK_SCHEMA)
    return bodies.select(*others, F.explode(parsed["alerts"]).alias("a")).select(
        *others,
        F.coalesce("a.status", F.lit("firing")).alias("status"),
        F.coalesce("a.labels", F.create_map().cast("map<string,string>")).alias("labels"),
        F.coalesce("a.annotations", F.create_map().cast("map<string,string>")).alias("annotations"),
    )


def _title() -> Column:
    return F.coalesce(F.col("labels")["alertname"], F.lit(""))


def without_skipped(alerts: DataFrame) -> DataFrame:
    """Drops titles and title prefixes that are never delivered."""
    title = _title()
    skipped = title.isin(*fv.SKIPPED_TITLES)
    for prefix in fv.SKIPPED_PREFIXES:
        skipped = skipped | title.startswith(prefix)
    return alerts.where(~skipped)


def normalised_webhook(alerts: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Infrastructure events of webhook alerts whose title is known."""
    label = F.col("labels")
    kind = sev.title_error_type(_title())
    return (
        without_skipped(alerts)
        .where(kind.isNotNull())
        .select(
            *keep,
            F.when(F.col("status") == "firing", "trigger").otherwise("resolve").alias("event_action"),
            kind.alias("error_type"),
            _title().alias("alert_title"),
            F.coalesce(label["severity"], F.lit("error")).alias("severity"),
            F.coalesce(label["group"], F.lit("infrastructure")).alias("group"),
            F.coalesce(label["component"], F.lit("")).alias("component"),
            F.coalesce(F.col("annotations")["summary"], _title()).alias("summary"),
            F.coalesce(label["table"], F.lit("all")).alias("table"),
            F.lit("grafana").alias("source"),
        )
    )


def unknown_titles(alerts: DataFrame) -> DataFrame:
    """Titles that are neither skipped nor known, with how often they came."""
    return (
        without_skipped(alerts)
        .where(sev.title_error_type(_title()).isNull())
        .groupBy(_title().alias("alert_title"))
        .agg(F.count(F.lit(1)).alias("alerts"))
    )


# --- delivery --------------------------------------------------------------
def with_dedup_key(events: DataFrame) -> DataFrame:
    """Fills a missing or empty dedup key from table and type."""
    own = text.dedup_key(
        F.coalesce("table", F.lit("all")), F.coalesce("error_type", F.lit("unknown"))
    )
    return events.withColumn("dedup_key", F.coalesce(text.blank_to_null(F.col("dedup_key")), own))


def graded_for_delivery(events: DataFrame) -> DataFrame:
    """Keeps the sender's severity as `payload_severity` and adds the delivered one."""
    level = sev.delivery_severity(F.coalesce("error_type", F.lit("unknown")))
    return events.withColumnRenamed("severity", "payload_severity").withColumns(
        {"routed_severity": level["severity"], "sev_label": level["sev_label"]}
    )


def outbound(
    events: DataFrame, keys_by_topic: Mapping[str, str], base_key: str = "", topic: str = "topic"
) -> DataFrame:
    """Delivery bodies as JSON, one per event; without a routing key it is a dry run."""
    known, _ = split_actions(events)
    kind = F.coalesce("error_type", F.lit("unknown"))
    table = F.coalesce("table", F.lit("all"))
    rows = with_dedup_key(known).withColumns(
        {
            "routing_key": sev.routing_key(F.col(topic), dict(keys_by_topic), base_key),
            "_level": sev.delivery_severity(kind),
        }
    )
    payload = F.struct(
        F.coalesce("summary", F.format_string(fv.PLAIN_SUMMARY, kind, table)).alias("summary"),
        F.col("_level.severity").alias("severity"),
        F.coalesce("source", F.lit(fv.ALERT_SOURCE)).alias("source"),
        F.coalesce("component", F.concat(F.lit("spark-cdc/"), table)).alias("component"),
        F.coalesce("group", F.lit("infrastructure")).alias("group"),
        kind.alias("class"),
        as_object(F.col("custom_details")).alias("custom_details"),
    )
    body = F.to_json(
        F.struct(
            "routing_key", "event_action", "dedup_key",
            F.when(F.col("event_action") == "trigger", payload).alias("payload"),
        )
    )
    return rows.select(
        F.col(topic), "event_action", "dedup_key", F.col("_level.sev_label").alias("sev_label"),
        F.col("routing_key").isNull().alias("dry_run"), body.alias("body"),
    )


def as_object(details: Column) -> Column:
    """A details text as the JSON value it holds; a text that is no JSON stays a text."""
    return F.coalesce(F.try_parse_json(details), details.cast("variant"), F.parse_json(F.lit("{}")))


def as_messages(events: DataFrame, fields: Sequence[str], scope: Column | None = None) -> DataFrame:
    """Events as (key, value): the key is `<table or scope>:<type>`, the value JSON."""
    key = text.message_key(F.col("table") if scope is None else scope, F.col("error_type"))
    # Details are an object in the message, not a text that holds one.
    columns = [as_object(F.col(f)).alias(f) if f == "custom_details" else F.col(f) for f in fields]
    return events.select(key.alias("key"), F.to_json(F.struct(*columns)).alias("value"))


def topic_of(group: Column) -> Column:
    """Infrastructure events go to the infrastructure topic, all others to data quality."""
    return F.when(group == "infrastructure", fv.INFRA_TOPIC).otherwise(fv.DQ_TOPIC)


def retained(messages: DataFrame, now_ms: int, ts: str = "ts_ms", days: int = fv.ALERT_RETENTION_DAYS) -> DataFrame:
    """Messages within the retention time."""
    return messages.where(F.col(ts) >= now_ms - days * 86_400_000)


# --- incidents -------------------------------------------------------------
def incidents(
    events: DataFrame, ts: str = "ts_ms", seq: str = "seq", key: str = "dedup_key",
    chunk_ms: int = CHUNK_MS, weight: Column | None = None, last: Column | None = None,
    with_seq: bool = False,
) -> DataFrame:
    """Trigger and resolve events as incidents.

    The first trigger of a closed key opens an incident, further triggers add
    to it, the next resolve closes it, a resolve of a closed key does nothing.
    Order is time, then `seq`. An event may stand for several triggers
    (`weight`), the last of them at `last`. `with_seq` adds the `seq` of the
    closing event as `resolved_seq`.

    A key's events are cut into time chunks and, inside a chunk, into segments
    that end with a resolve. Only a chunk's first segment and its open end can
    belong to an incident of a neighbour, so only those (two rows per chunk)
    come together per key.
    """
    is_resolve = F.col("event_action") == "resolve"
    is_trigger = F.col("event_action") == "trigger"
    inside = Window.partitionBy(key, "_chunk").orderBy(ts, seq).rowsBetween(
        Window.unboundedPreceding, -1
    )
    triggers = F.lit(1) if weight is None else weight
    last_at = F.col(ts) if last is None else last
    segments = (
        events.withColumn("_chunk", floor_to(F.col(ts), chunk_ms))
        .withColumn("_no", F.coalesce(F.sum(is_resolve.cast("long")).over(inside), F.lit(0)))
        .groupBy(key, "_chunk", "_no")
        .agg(
            F.min(F.when(is_trigger, F.col(ts))).alias("opened_ms"),
            F.max(F.when(is_resolve, F.col(ts))).alias("resolved_ms"),
            F.max(F.when(is_resolve, F.col(seq))).alias("resolved_seq"),
            F.sum(F.when(is_trigger, triggers).otherwise(0)).alias("triggers"),
            F.max(F.when(is_trigger, last_at)).alias("last_trigger_ms"),
        )
    )
    outer = (F.col("_no") == 0) | F.col("resolved_ms").isNull()
    grouped = segments.withColumn(
        "_group", F.when(~outer, F.col("_chunk"))
    )
    earlier = Window.partitionBy(key, "_group").orderBy("_chunk", "_no").rowsBetween(
        Window.unboundedPreceding, -1
    )
    closed_before = F.coalesce(F.count("resolved_ms").over(earlier), F.lit(0))
    return (
        grouped.withColumn(
            "_no", F.when(F.col("_group").isNull(), closed_before).otherwise(F.col("_no"))
        )
        .groupBy(key, "_group", "_no")
        .agg(
            F.min("opened_ms").alias("opened_ms"),
            F.max("resolved_ms").alias("resolved_ms"),
            F.max("resolved_seq").alias("resolved_seq"),
            F.sum("triggers").cast("long").alias("triggers"),
            F.max("last_trigger_ms").alias("last_trigger_ms"),
        )
        .where(F.col("opened_ms").isNotNull())
        .select(
            key, "opened_ms", "last_trigger_ms", "resolved_ms", "triggers",
            F.when(F.col("resolved_ms").isNull(), "open").otherwise("resolved").alias("state"),
            (F.col("resolved_ms") - F.col("opened_ms")).alias("open_ms"),
            *(["resolved_seq"] if with_seq else []),
        )
    )


def incident_summary(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Incidents, open ones and time to resolve per group."""
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("incidents"),
        F.count(F.when(F.col("state") == "open", 1)).alias("open_incidents"),
        F.sum("triggers").cast("long").alias("triggers"),
        F.avg(F.col("open_ms") / 1000.0).alias("mean_seconds_to_resolve"),
        F.max("open_ms").cast("long").alias("longest_ms"),
    )


def failure_streaks(
    runs: DataFrame, keys: Sequence[str], failed: Column, ts: str, ties: Sequence[str],
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Adds `consecutive_failures` as of each run: failures since the last success."""
    return events_since_last(runs, keys, ts, ties, failed, ~failed, "consecutive_failures", chunk_ms)


def notifications(
    events: DataFrame,
    keys: Sequence[str] = fv.GROUP_BY,
    ts: str = "ts_ms",
    repeat_ms: int = fv.REPEAT_INTERVAL_MS,
    tick_ms: int = fv.RULE_STEP_MS,
    wait_ms: int = 0,
    last_sent: DataFrame | None = None,
    changed: Column | None = None,
    interval_ms: int = fv.GROUP_INTERVAL_MS,
    timed: bool = False,
    until_ms: int | None = None,
) -> DataFrame:
    """Notifications of a group: the first one, then none until the repeat time is over.

    Where `changed` says that an event changes its group (an alert joins or is
    resolved), the group is sent again at the first tick after the shorter
    `interval_ms`; a change that comes too early waits for it. Such a change is
    sent with the group's next event, or with `timed` at that first tick
    itself, if it is not after `until_ms`, so that no change needs another
    event to be sent.

    Alerts are evaluated at ticks, so events are first brought to their tick
    and made one row there (combined before the shuffle). A group then has at
    most one row per tick, however many events it has; the chain of sent ticks
    is followed within that bounded list. `wait_ms` delays a group's events.
    `last_sent` (keys, sent_ms, perhaps pending) continues from earlier
    notifications.
    """
    states = notification_states(
        events, keys, ts, repeat_ms, tick_ms, wait_ms, last_sent, changed, interval_ms, timed, until_ms
    )
    return states.select(*keys, F.explode("sent").alias("notified_ms"))


def notification_states(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    repeat_ms: int,
    tick_ms: int,
    wait_ms: int = 0,
    last_sent: DataFrame | None = None,
    changed: Column | None = None,
    interval_ms: int = fv.GROUP_INTERVAL_MS,
    timed: bool = False,
    until_ms: int | None = None,
) -> DataFrame:
    """keys, sent (ticks, as in `notifications`), sent_ms (the last one), pending (a change waits)."""
    moved = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False))
    ticks = events.groupBy(*keys, ceil_to(F.col(ts) + wait_ms, tick_ms).alias("tick_ms")).agg(
        F.max(moved).alias("changed")
    )
    per_group = ticks.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("tick_ms", "changed"))).alias("_ticks")
    )
    never = F.lit(-(2**62)).cast("long")
    waits = F.lit(False)
    if last_sent is None:
        known = never
    else:
        has_pending = "pending" in last_sent.columns
        extra = ["pending"] if has_pending else []
        before = last_sent.select(*[F.col(k).alias(f"_{k}") for k in keys], "sent_ms", *extra)
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        # A change that waits is due without an event, too.
        per_group = per_group.join(before, same, "full" if timed and has_pending else "left").select(
            *[F.when(F.col("_ticks").isNull(), F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys],
            "_ticks", "sent_ms", *extra,
        )
        known = F.coalesce("sent_ms", never)
        if has_pending:
            waits = F.coalesce("pending", F.lit(False))

    def state(last: Column, pending: Column, sent: Column) -> Column:
        return F.struct(last.alias("last"), pending.alias("pending"), sent.alias("sent"))

    def on_time(so_far: Column, early_enough: Column) -> Column:
        at = ceil_to(so_far["last"] + interval_ms, tick_ms)
        return F.when(
            so_far["pending"] & early_enough, state(at, F.lit(False), F.array_append(so_far["sent"], at))
        ).otherwise(so_far)

    def at_event(so_far: Column, item: Column) -> Column:
        tick, gap = item["tick_ms"], item["tick_ms"] - so_far["last"]
        pending = so_far["pending"] | item["changed"]
        due = (gap >= repeat_ms) | (pending & (gap >= interval_ms))
        return F.when(
            due, state(tick, F.lit(False), F.array_append(so_far["sent"], tick))
        ).otherwise(state(so_far["last"], pending, so_far["sent"]))

    def follow(so_far: Column, item: Column) -> Column:
        if not timed:
            return at_event(so_far, item)
        before_item = ceil_to(so_far["last"] + interval_ms, tick_ms) < item["tick_ms"]
        # Through an array, so that the step before is computed once.
        return F.transform(F.array(on_time(so_far, before_item)), lambda now: at_event(now, item))[0]

    def finish(done: Column) -> Column:
        if not timed:
            return done
        at = ceil_to(done["last"] + interval_ms, tick_ms)
        return on_time(done, F.lit(True) if until_ms is None else at <= until_ms)

    start = state(known, waits, F.array().cast("array<bigint>"))
    ticks_of = F.coalesce("_ticks", F.array().cast("array<struct<tick_ms:bigint,changed:boolean>>"))
    done = per_group.withColumn("_done", F.aggregate(ticks_of, start, follow, finish))
    return done.select(
        *keys, F.col("_done.sent").alias("sent"),
        F.when(F.col("_done.last") > never, F.col("_done.last")).alias("sent_ms"),
        F.col("_done.pending").alias("pending"),
    )
