"""Registered queries: alert events, delivery, incidents and repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions import severity as sev
from rillmark.functions import text
from rillmark.functions.times import epoch_ms
from rillmark.operators import alerts
from rillmark.operators.timeline import fitting_chunk
from rillmark.plans.catalog.inputs import (
    ALERTS_SQL, DAY_MS, END_MS, MS_SQL, WEBHOOK_SQL, Query, read, user_alerts, webhook_bodies,
)

# Error types that stand for a number: all known ones, a crash and an unknown one.
KINDS = (*fv.DELIVERY_SEVERITY_EXTENDED, "disk_full")


def _kind(number):
    return F.element_at(F.array(*[F.lit(k) for k in KINDS]), (number % len(KINDS) + 1).cast("int"))


def webhook_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.webhook_alerts(webhook_bodies(spark, sf_dir))
    return alerts.normalised_webhook(found, keep=["event_id"])


def webhook_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.normalised_webhook(alerts.webhook_alerts(webhook_bodies(spark, sf_dir)))
    return alerts.as_messages(found, alerts.INFRA_FIELDS, F.lit("infra"))


def unknown_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.unknown_titles(alerts.webhook_alerts(webhook_bodies(spark, sf_dir)))


def severity_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = _kind(F.col("event_id"))
    level = sev.delivery_severity(kind)
    return read(spark, sf_dir, "events").select(
        kind.alias("error_type"), level["severity"].alias("routed_severity"),
        level["sev_label"].alias("sev_label"), sev.display_label(kind).alias("shown"),
    ).groupBy("error_type", "routed_severity", "sev_label", "shown").agg(
        F.count(F.lit(1)).alias("events")
    )


def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    suffix = F.when(F.col("event_id") % 3 == 0, F.lit("")).when(F.col("event_id") % 3 == 1, "run-1")
    given = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("own-"), user)).when(
        F.col("event_id") % 5 == 1, ""
    )
    events = read(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("error_type"), user.alias("table"),
        given.alias("dedup_key"), suffix.alias("suffix"),
    )
    built = events.withColumn("built_key", text.dedup_key(F.col("table"), F.col("error_type"), F.col("suffix")))
    return alerts.with_dedup_key(built).select("event_id", "built_key", "dedup_key")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = user_alerts(spark, sf_dir).withColumn(
        "dedup_key", text.dedup_key(F.col("table"), F.col("error_type"))
    )
    width = fitting_chunk(events, ["dedup_key"], "ts_ms")
    return alerts.incidents(events, chunk_ms=width)


def incident_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).drop("last_trigger_ms")


def incident_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.incident_summary(_pairs(spark, sf_dir), ["dedup_key"])
    return found.withColumn("mean_seconds_to_resolve", F.round("mean_seconds_to_resolve", 6))


def one_busy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events under one key: the work is spread by time, not by key."""
    events = user_alerts(spark, sf_dir).withColumn("dedup_key", F.lit("cdc-all-stale_data"))
    width = fitting_chunk(events, ["dedup_key"], "ts_ms", rows_per_chunk=1_000)
    return alerts.incidents(events, chunk_ms=width).drop("last_trigger_ms")


def repeat_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    fired = read(spark, sf_dir, "events").select(
        kind.alias("alertname"), (F.col("user_id") % 3).cast("string").alias("table"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
    )
    return alerts.notifications(fired)


def change_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats every four hours, and changes of a group after five minutes."""
    fired = read(spark, sf_dir, "events").select(
        F.col("event_type").alias("alertname"), (F.col("user_id") % 3).cast("string").alias("table"),
        epoch_ms(F.col("ts")).alias("ts_ms"), (F.col("value") > 60).alias("joined"),
    )
    return alerts.notifications(fired, changed=F.col("joined"))


def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs per user: an error fails, a purchase succeeds, others do not count."""
    runs = read(spark, sf_dir, "events").where("event_type IN ('error', 'purchase')").select(
        "user_id", "event_id", epoch_ms(F.col("ts")).alias("ts_ms"), "event_type"
    )
    width = fitting_chunk(runs, ["user_id"], "ts_ms")
    found = alerts.failure_streaks(
        runs, ["user_id"], F.col("event_type") == "error", "ts_ms", ["event_id"], chunk_ms=width
    )
    return found.select("user_id", "event_id", "ts_ms", "consecutive_failures")


def _typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "error", "trigger").when(kind == "purchase", "resolve")
        .when(kind == "click", "acknowledge").alias("event_action"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("k"), F.col("user_id"))).alias("dedup_key"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("t"), F.col("user_id"))).alias("table"),
        _kind(F.col("event_id")).alias("error_type"),
        F.lit("warning").alias("severity"),
        F.lit(None).cast("string").alias("summary"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("component"),
        F.lit(None).cast("string").alias("group"),
        F.lit(None).cast("string").alias("custom_details"),
        F.when(F.col("event_id") % 3 == 0, fv.INFRA_TOPIC).otherwise(fv.DQ_TOPIC).alias("topic"),
    )


def action_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, other = alerts.split_actions(_typed_events(spark, sf_dir))
    both = known.withColumn("handled", F.lit(True)).unionByName(other.withColumn("handled", F.lit(False)))
    return both.groupBy("event_action", "handled").agg(F.count(F.lit(1)).alias("events"))


def routed_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = alerts.graded_for_delivery(_typed_events(spark, sf_dir))
    return graded.select("event_id", "error_type", "payload_severity", "routed_severity", "sev_label")


def delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = alerts.outbound(_typed_events(spark, sf_dir), {fv.INFRA_TOPIC: "infra-key"})
    body = F.col("body")
    return sent.select(
        "topic", "event_action", "dedup_key", "sev_label", "dry_run",
        F.get_json_object(body, "$.routing_key").alias("routing_key"),
        F.get_json_object(body, "$.payload.summary").alias("summary"),
        F.get_json_object(body, "$.payload.severity").alias("severity"),
        F.get_json_object(body, "$.payload.component").alias("component"),
        F.get_json_object(body, "$.payload.class").alias("class"),
    ).groupBy(
        "topic", "event_action", "dedup_key", "sev_label", "dry_run", "routing_key", "summary",
        "severity", "component", "class",
    ).agg(F.count(F.lit(1)).alias("events"))


def topic_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.when(F.col("event_type") == "error", "infrastructure").otherwise("data-quality")
    return read(spark, sf_dir, "events").select(alerts.topic_of(group).alias("topic")).groupBy(
        "topic"
    ).agg(F.count(F.lit(1)).alias("events"))


def outbox_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve messages as key and JSON text."""
    rows = read(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("table"), epoch_ms(F.col("ts")).alias("ts_ms")
    )
    events = alerts.resolve_events(
        rows, table=F.col("table"), error_type=F.lit("stale_data"), ts_ms=F.col("ts_ms")
    )
    return alerts.as_messages(events, alerts.RESOLVE_FIELDS)


def parsed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and rejects of JSON texts of which some are cut off."""
    kind = F.col("event_type")
    good = F.to_json(F.struct(kind.alias("error_type"), F.lit("trigger").alias("event_action"),
                              F.concat(F.lit("t"), F.col("user_id")).alias("table")))
    messages = read(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 10 == 0, F.substring(good, 1, 12))
        .when(F.col("event_id") % 10 == 1, F.lit("not json")).otherwise(good).alias("value"),
    )
    events, rejects = alerts.parse_events(messages)
    ok = events.groupBy("error_type").agg(
        F.count(F.lit(1)).alias("messages"), F.max("table").alias("last_table")
    )
    bad = rejects.agg(F.count(F.lit(1)).alias("messages")).select(
        F.lit("(rejected)").alias("error_type"), "messages", F.lit(None).cast("string").alias("last_table")
    )
    return ok.unionByName(bad)


def _marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy(
        F.concat(F.lit("user_"), F.col("user_id")).alias("table")
    ).agg(F.max(epoch_ms(F.col("ts"))).alias("last_processed_ts_ms"))


def freshness_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.freshness_events(_marks(spark, sf_dir), END_MS, 36_000)
    return found.select(
        "event_action", "dedup_key", "severity", "table", "component",
        F.get_json_object("custom_details", "$.threshold_seconds").cast("long").alias("threshold"),
    )


def freshness_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.freshness_gap(_marks(spark, sf_dir), END_MS).select(
        "table", F.round("gap_seconds", 3).alias("gap_seconds")
    )


def crash_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    runs = read(spark, sf_dir, "events").select(
        F.concat(F.lit("user_"), F.col("user_id")).alias("table"),
        F.when(kind == "error", "crashed").otherwise("ok").alias("status"),
        F.when(F.col("event_id") % 2 == 0, "write").alias("failed_step"),
        F.lit("ValueError").alias("exception"), F.lit("bad").alias("message"),
        F.lit(1).alias("consecutive_failures"), epoch_ms(F.col("ts")).alias("ts_ms"),
    )
    return alerts.crash_events(runs).select(
        "dedup_key", "summary", "severity", "group", "component", "timestamp", "custom_details", "ts_ms"
    )


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = user_alerts(spark, sf_dir)
    return alerts.retained(rows, END_MS).groupBy("event_action").agg(
        F.count(F.lit(1)).alias("messages"), F.min("ts_ms").alias("oldest_ms")
    )


def topics_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics of unlike columns read as one feed."""
    events = read(spark, sf_dir, "events")
    infra = events.where("event_type = 'error'").select(
        F.lit(fv.INFRA_TOPIC).alias("topic"), F.col("event_type").alias("alert_title"), "event_id"
    )
    quality = events.where("event_type <> 'error'").select(
        F.lit(fv.DQ_TOPIC).alias("topic"), F.concat(F.lit("k"), F.col("user_id")).alias("dedup_key"), "event_id"
    )
    both = infra.unionByName(quality, allowMissingColumns=True)
    return both.groupBy("topic").agg(
        F.count(F.lit(1)).alias("messages"), F.count("alert_title").alias("titles"),
        F.count("dedup_key").alias("dedup_keys"),
    )


def _kind_sql(number: str) -> str:
    items = ", ".join(f"'{k}'" for k in KINDS)
    return f"[{items}][CAST({number} % {len(KINDS)} + 1 AS INTEGER)]"


def _level_sql(kind: str, pick: int, default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v[pick]}'" for k, v in fv.DELIVERY_SEVERITY_EXTENDED.items())
    return f"CASE {kind} {cases} ELSE '{default}' END"


def incident_sql(key: str) -> str:
    return f"""a AS (SELECT {key} AS dedup_key, event_action, ts_ms, seq FROM alerts),
    n AS (SELECT *, coalesce(sum(CASE WHEN event_action = 'resolve' THEN 1 ELSE 0 END) OVER (
      PARTITION BY dedup_key ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS no FROM a),
    inc AS (SELECT dedup_key, min(CASE WHEN event_action = 'trigger' THEN ts_ms END) AS opened_ms,
      max(CASE WHEN event_action = 'resolve' THEN ts_ms END) AS resolved_ms,
      count(CASE WHEN event_action = 'trigger' THEN 1 END) AS triggers FROM n GROUP BY dedup_key, no),
    pairs AS (SELECT *, CASE WHEN resolved_ms IS NULL THEN 'open' ELSE 'resolved' END AS state,
      resolved_ms - opened_ms AS open_ms FROM inc WHERE opened_ms IS NOT NULL)"""


ISO_SQL = "strftime(make_timestamp(ms * 1000), '%Y-%m-%dT%H:%M:%S') || printf('.%03d+00:00', ms % 1000)"
TYPED_SQL = f"""typed AS (SELECT event_id,
    CASE event_type WHEN 'error' THEN 'trigger' WHEN 'purchase' THEN 'resolve' WHEN 'click' THEN 'acknowledge'
      ELSE 'trigger' END AS act,
    CASE WHEN event_id % 4 = 0 THEN 'k' || user_id END AS dk,
    coalesce(CASE WHEN event_id % 2 = 0 THEN 't' || user_id END, 'all') AS tab,
    {_kind_sql('event_id')} AS kind,
    CASE WHEN event_id % 3 = 0 THEN '{fv.INFRA_TOPIC}' ELSE '{fv.DQ_TOPIC}' END AS topic FROM events)"""
HOOK_KIND = "CASE title WHEN 'CDC Kafka Consumer Lag Too High' THEN 'kafka_lag_growing' ELSE 'spark_not_running' END"

QUERIES = {
    "webhook_normalise": Query(
        webhook_normalise,
        f"""WITH {WEBHOOK_SQL} SELECT event_id,
          CASE status WHEN 'firing' THEN 'trigger' ELSE 'resolve' END AS event_action, {HOOK_KIND} AS error_type,
          title AS alert_title, 'error' AS severity, 'infrastructure' AS "group", '' AS component,
          'event ' || event_id AS summary, tab AS "table", 'grafana' AS source
        FROM hooks WHERE title LIKE 'CDC %'""",
    ),
    "webhook_messages": Query(
        webhook_messages,
        f"""WITH {WEBHOOK_SQL}, h AS (SELECT *, {HOOK_KIND} AS kind FROM hooks WHERE title LIKE 'CDC %')
        SELECT 'infra:' || kind AS key, CAST(json_object(
          'event_action', CASE status WHEN 'firing' THEN 'trigger' ELSE 'resolve' END, 'error_type', kind,
          'alert_title', title, 'severity', 'error', 'group', 'infrastructure', 'component', '',
          'summary', 'event ' || event_id, 'table', tab, 'source', 'grafana') AS VARCHAR) AS value FROM h""",
    ),
    "unknown_titles": Query(
        unknown_titles,
        f"""WITH {WEBHOOK_SQL} SELECT title AS alert_title, count(*) AS alerts FROM hooks
        WHERE title LIKE 'Disk %' GROUP BY 1""",
    ),
    "severity_lookup": Query(
        severity_lookup,
        f"""WITH k AS (SELECT {_kind_sql('event_id')} AS error_type FROM events)
        SELECT error_type, {_level_sql('error_type', 1, 'error')} AS routed_severity,
          {_level_sql('error_type', 0, 'SEV-2')} AS sev_label,
          {_level_sql('error_type', 0, 'SEV-?')} AS shown, count(*) AS events FROM k GROUP BY 1, 2, 3, 4""",
    ),
    "dedup_key": Query(
        dedup_keys,
        """SELECT event_id, 'cdc-' || user_id || '-' || event_type ||
            CASE WHEN event_id % 3 = 1 THEN '-run-1' ELSE '' END AS built_key,
          CASE WHEN event_id % 5 = 0 THEN 'own-' || user_id
            ELSE 'cdc-' || user_id || '-' || event_type END AS dedup_key FROM events""",
    ),
    "incident_pairs": Query(
        incident_pairs,
        f"""WITH {ALERTS_SQL}, {incident_sql('dedup_key')}
        SELECT dedup_key, opened_ms, resolved_ms, triggers, state, open_ms FROM pairs""",
    ),
    "incident_summary": Query(
        incident_summary,
        f"""WITH {ALERTS_SQL}, {incident_sql('dedup_key')}
        SELECT dedup_key, count(*) AS incidents, count(CASE WHEN state = 'open' THEN 1 END) AS open_incidents,
          CAST(sum(triggers) AS BIGINT) AS triggers, round(avg(open_ms / 1000.0), 6) AS mean_seconds_to_resolve,
          max(open_ms) AS longest_ms FROM pairs GROUP BY 1""",
    ),
    "incidents_of_one_key": Query(
        one_busy_key,
        f"""WITH {ALERTS_SQL}, {incident_sql("'cdc-all-stale_data'")}
        SELECT dedup_key, opened_ms, resolved_ms, triggers, state, open_ms FROM pairs""",
    ),
    "repeat_policy": Query(
        repeat_policy,
        f"""WITH RECURSIVE f AS (SELECT DISTINCT event_type AS alertname, CAST(user_id % 3 AS VARCHAR) AS tab,
            CAST(ceil(({MS_SQL}) / 60000.0) AS BIGINT) * 60000 AS tick FROM events),
          s AS (SELECT alertname, tab, min(tick) AS tick FROM f GROUP BY 1, 2
            UNION ALL
            SELECT s.alertname, s.tab, (SELECT min(f.tick) FROM f WHERE f.alertname = s.alertname
              AND f.tab = s.tab AND f.tick >= s.tick + {fv.REPEAT_INTERVAL_MS}) AS tick
            FROM s WHERE s.tick IS NOT NULL)
        SELECT alertname, tab AS "table", tick AS notified_ms FROM s WHERE tick IS NOT NULL""",
    ),
    "notify_on_change": Query(
        change_policy,
        f"""WITH RECURSIVE f AS (SELECT event_type AS alertname, CAST(user_id % 3 AS VARCHAR) AS tab,
            CAST(ceil(({MS_SQL}) / 60000.0) AS BIGINT) * 60000 AS tick, max(value) > 60 AS joined
            FROM events GROUP BY 1, 2, 3),
          n AS (SELECT *, min(CASE WHEN joined THEN tick END) OVER (PARTITION BY alertname, tab ORDER BY tick
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_joined FROM f),
          s AS (SELECT alertname, tab, min(tick) AS tick FROM n GROUP BY 1, 2
            UNION ALL
            SELECT s.alertname, s.tab, (SELECT min(f.tick) FROM f WHERE f.alertname = s.alertname
              AND f.tab = s.tab AND (f.tick >= s.tick + {fv.REPEAT_INTERVAL_MS}
                OR (n.next_joined IS NOT NULL
                  AND f.tick >= greatest(s.tick + {fv.GROUP_INTERVAL_MS}, n.next_joined)))) AS tick
            FROM s JOIN n ON n.alertname = s.alertname AND n.tab = s.tab AND n.tick = s.tick)
        SELECT alertname, tab AS "table", tick AS notified_ms FROM s WHERE tick IS NOT NULL""",
    ),
    "consecutive_failures": Query(
        consecutive_failures,
        f"""WITH r AS (SELECT user_id, event_id, {MS_SQL} AS ts_ms, event_type FROM events
            WHERE event_type IN ('error', 'purchase')),
          g AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (
            PARTITION BY user_id ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS no FROM r)
        SELECT user_id, event_id, ts_ms, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
          PARTITION BY user_id, no ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT)
          AS consecutive_failures FROM g""",
    ),
    "action_split": Query(
        action_split,
        f"""WITH {TYPED_SQL} SELECT act AS event_action, act <> 'acknowledge' AS handled, count(*) AS events
        FROM typed GROUP BY 1, 2""",
    ),
    "routed_severity": Query(
        routed_severity,
        f"""WITH {TYPED_SQL} SELECT event_id, kind AS error_type, 'warning' AS payload_severity,
          {_level_sql('kind', 1, 'error')} AS routed_severity, {_level_sql('kind', 0, 'SEV-2')} AS sev_label
        FROM typed""",
    ),
    "delivery_events": Query(
        delivery,
        f"""WITH {TYPED_SQL}, d AS (SELECT topic, act AS event_action,
            coalesce(dk, 'cdc-' || tab || '-' || kind) AS dedup_key,
            {_level_sql('kind', 0, 'SEV-2')} AS sev_label, topic = '{fv.DQ_TOPIC}' AS dry_run,
            CASE WHEN topic = '{fv.INFRA_TOPIC}' THEN 'infra-key' END AS routing_key,
            CASE WHEN act = 'trigger' THEN '[CDC] ' || kind || ' on ' || tab END AS summary,
            CASE WHEN act = 'trigger' THEN {_level_sql('kind', 1, 'error')} END AS severity,
            CASE WHEN act = 'trigger' THEN 'spark-cdc/' || tab END AS component,
            CASE WHEN act = 'trigger' THEN kind END AS "class" FROM typed WHERE act <> 'acknowledge')
        SELECT *, count(*) AS events FROM d GROUP BY ALL""",
    ),
    "topic_of_group": Query(
        topic_groups,
        f"""SELECT CASE event_type WHEN 'error' THEN '{fv.INFRA_TOPIC}' ELSE '{fv.DQ_TOPIC}' END AS topic,
          count(*) AS events FROM events GROUP BY 1""",
    ),
    "outbox_json": Query(
        outbox_json,
        f"""WITH r AS (SELECT 'user_' || user_id AS tab, {MS_SQL} AS ms FROM events)
        SELECT tab || ':stale_data' AS key, CAST(json_object('event_action', 'resolve',
          'dedup_key', 'cdc-' || tab || '-stale_data', 'table', tab, 'error_type', 'stale_data',
          'source', 'spark-cdc', 'timestamp', {ISO_SQL}) AS VARCHAR) AS value FROM r""",
    ),
    "message_rejects": Query(
        parsed_messages,
        """SELECT event_type AS error_type, count(*) AS messages, max('t' || user_id) AS last_table FROM events
        WHERE event_id % 10 > 1 GROUP BY 1
        UNION ALL SELECT '(rejected)', count(*), NULL FROM events WHERE event_id % 10 <= 1""",
    ),
    "freshness_events": Query(
        freshness_events,
        f"""WITH m AS (SELECT 'user_' || user_id AS tab, ({END_MS} - max({MS_SQL})) / 1000.0 AS gap
            FROM events GROUP BY 1)
        SELECT CASE WHEN gap > 36000 THEN 'trigger' ELSE 'resolve' END AS event_action,
          'cdc-' || tab || '-stale_data' AS dedup_key, CASE WHEN gap > 36000 THEN 'critical' END AS severity,
          tab AS "table", CASE WHEN gap > 36000 THEN 'spark/freshness_check' END AS component,
          CASE WHEN gap > 36000 THEN 36000::BIGINT END AS threshold FROM m""",
    ),
    "freshness_gap": Query(
        freshness_gaps,
        f"""SELECT 'user_' || user_id AS "table", round(({END_MS} - max({MS_SQL})) / 1000.0, 3) AS gap_seconds
        FROM events GROUP BY 1""",
    ),
    "crash_events": Query(
        crash_events,
        f"""WITH c AS (SELECT 'user_' || user_id AS tab, CASE WHEN event_id % 2 = 0 THEN 'write' ELSE 'unknown' END
            AS step, {MS_SQL} AS ms FROM events WHERE event_type = 'error')
        SELECT 'cdc-' || tab || '-unhandled_exception' AS dedup_key,
          '[CDC Pipeline] ''' || tab || ''' crashed at step ' || step || ': ValueError' AS summary,
          'critical' AS severity, 'infrastructure' AS "group", 'spark' AS component, {ISO_SQL} AS timestamp,
          CAST(json_object('consecutive_failures', 1, 'failed_step', step, 'exception', 'bad', 'dashboard_url', '') AS VARCHAR)
            AS custom_details, ms AS ts_ms FROM c""",
    ),
    "alert_retention": Query(
        retention,
        f"""WITH {ALERTS_SQL} SELECT event_action, count(*) AS messages, min(ts_ms) AS oldest_ms FROM alerts
        WHERE ts_ms >= {END_MS - 7 * DAY_MS} GROUP BY 1""",
    ),
    "alert_topics_union": Query(
        topics_union,
        f"""SELECT CASE event_type WHEN 'error' THEN '{fv.INFRA_TOPIC}' ELSE '{fv.DQ_TOPIC}' END AS topic,
          count(*) AS messages, count(CASE WHEN event_type = 'error' THEN 1 END) AS titles,
          count(CASE WHEN event_type <> 'error' THEN 1 END) AS dedup_keys
        FROM events GROUP BY 1""",
    ),
}

