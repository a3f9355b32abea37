"""The given tables as change feeds, metric samples and alert events.

Each shape exists twice: as a DataFrame and as the SQL that says the same.
Readers project only what a query uses; Catalyst prunes the scans further.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.times import epoch_ms
from rillmark.session import use_utc


class Query(NamedTuple):
    """A registered query and, where SQL can say it, its check."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


DAY_MS = 86_400_000
START_MS = 1_704_067_200_000  # 2024-01-01, the first day of the events
MARK_MS = START_MS + 14 * DAY_MS
END_MS = START_MS + 30 * DAY_MS

# Operations that stand for the event types.
OP_OF_TYPE = {"signup": "c", "click": "u", "view": "u", "purchase": "r", "error": "d"}

OP_SQL = (
    "CASE event_type WHEN 'signup' THEN 'c' WHEN 'click' THEN 'u' WHEN 'view' THEN 'u' "
    "WHEN 'purchase' THEN 'r' ELSE 'd' END"
)
MS_SQL = "epoch_us(ts) // 1000"


def event_op():
    op = F.lit("d")
    for kind, code in OP_OF_TYPE.items():
        op = F.when(F.col("event_type") == kind, code).otherwise(op)
    return op


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a user's row; an error deletes it."""
    row = F.struct("user_id", "event_id", "value", "props")
    op = event_op()
    return read(spark, sf_dir, "events").select(
        op.alias("op"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        F.col("event_id").alias("seq"),
    )


FEED_SQL = f"""feed AS (
  SELECT {OP_SQL} AS op, {MS_SQL} AS ts_ms, user_id, event_id, value, props, event_type
  FROM events)"""
FLAT_SQL = """flat AS (
  SELECT user_id, event_id, value, props, ts_ms AS cdc_ts_ms, op AS cdc_op
  FROM feed WHERE op IN ('c', 'u', 'r'))"""


def line_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as changes with a composite key."""
    op = (
        F.when(F.col("l_returnflag") == "N", "c")
        .when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "d")
        .otherwise("u")
    )
    row = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return read(spark, sf_dir, "lineitem").select(
        op.alias("op"),
        epoch_ms(F.col("l_shipdate")).alias("ts_ms"),
        F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"),
        "l_partkey",
        "l_extendedprice",
    )


LINE_SQL = """lines AS (
  SELECT CASE WHEN l_returnflag = 'N' THEN 'c'
              WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'd' ELSE 'u' END AS op,
         epoch_us(l_shipdate) // 1000 AS ts_ms, l_orderkey, l_linenumber, l_partkey,
         l_quantity, l_extendedprice
  FROM lineitem)"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values as samples of one metric with two labels."""
    return read(spark, sf_dir, "events").select(
        F.lit("reading").alias("metric"),
        F.create_map(
            F.lit("event_type"), F.col("event_type"),
            F.lit("shard"), (F.col("user_id") % 7).cast("string"),
        ).alias("labels"),
        epoch_ms(F.col("ts")).alias("ts_ms"),
        "value",
        F.col("event_id").alias("seq"),
    )


READINGS_SQL = f"""readings AS (
  SELECT event_type, CAST(user_id % 7 AS VARCHAR) AS shard, {MS_SQL} AS ts_ms, value
  FROM events)"""


def instant_sql(at_ms: int, lookback_ms: int) -> str:
    return f"""vec AS (
  SELECT event_type, shard, arg_max(value, ts_ms) AS value FROM readings
  WHERE ts_ms <= {at_ms} AND ts_ms > {at_ms - lookback_ms} GROUP BY event_type, shard)"""


CONNECTOR, SINK_GROUP, WORKER = "source", "sink-connector", "worker:7071"


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the metrics that the standard rules watch."""
    table = F.element_at(
        F.array(F.lit("orders"), F.lit("order_details"), F.lit("products")),
        (F.col("user_id") % 3 + 1).cast("int"),
    )
    kind, value, part = F.col("event_type"), F.col("value"), F.col("event_id") % 4
    ms = epoch_ms(F.col("ts"))
    none = F.create_map().cast("map<string,string>")

    def sample(metric, labels, v):
        return F.struct(
            F.lit(metric).alias("metric"), labels.alias("labels"), v.cast("double").alias("value")
        )

    one = F.create_map
    heap = one(F.lit("area"), F.lit("heap"))
    group = F.when(F.col("event_id") % 2 == 0, SINK_GROUP).otherwise("other")
    chosen = (
        F.when(
            kind == "click",
            sample("kafka_consumergroup_lag",
                   one(F.lit("consumergroup"), group, F.lit("topic"), table), value * 100),
        )
        .when(
            kind == "view",
            sample("cdc_last_run_timestamp_seconds", one(F.lit("table"), table),
                   F.floor(ms / 1000) - F.floor(value * 20)),
        )
        .when(kind == "signup", sample("cdc_freshness_gap_seconds", one(F.lit("table"), table), value * 30))
        .when(kind == "purchase", sample("kafka_brokers", none, F.floor(value) % 3))
        .when(part == 0, sample("jvm_memory_bytes_used", heap, value + 40))
        .when(part == 1, sample("jvm_memory_bytes_max", heap, value + 60))
        .when(part == 2, sample("up", one(F.lit("instance"), F.lit(WORKER)), F.floor(value) % 2))
        .otherwise(
            sample("debezium_metrics_millisecondsbehindource",
                   one(F.lit("connector"), F.lit(CONNECTOR)), value * 100000)
        )
    )
    return read(spark, sf_dir, "events").select(
        ms.alias("ts_ms"), chosen.alias("s"), F.col("event_id").alias("seq")
    ).select("s.metric", "s.labels", "ts_ms", "s.value", "seq")


RUN_METRICS_SQL = f"""m AS (
  SELECT {MS_SQL} AS ts_ms, event_type AS kind, event_id % 4 AS part, value,
         CASE user_id % 3 WHEN 0 THEN 'orders' WHEN 1 THEN 'order_details' ELSE 'products' END AS tab,
         CASE WHEN event_id % 2 = 0 THEN '{SINK_GROUP}' ELSE 'other' END AS grp
  FROM events),
run_metrics AS (
  SELECT ts_ms, 'lag' AS metric, 'consumergroup=' || grp || ',topic=' || tab AS labels,
         tab, grp, value * 100 AS value FROM m WHERE kind = 'click'
  UNION ALL SELECT ts_ms, 'last_run', 'table=' || tab, tab, NULL,
         CAST(ts_ms // 1000 - CAST(floor(value * 20) AS BIGINT) AS DOUBLE) FROM m WHERE kind = 'view'
  UNION ALL SELECT ts_ms, 'gap', 'table=' || tab, tab, NULL, value * 30 FROM m WHERE kind = 'signup'
  UNION ALL SELECT ts_ms, 'brokers', '', NULL, NULL, CAST(CAST(floor(value) AS BIGINT) % 3 AS DOUBLE)
         FROM m WHERE kind = 'purchase'
  UNION ALL SELECT ts_ms, 'heap_used', 'area=heap', NULL, NULL, value + 40 FROM m WHERE kind = 'error' AND part = 0
  UNION ALL SELECT ts_ms, 'heap_max', 'area=heap', NULL, NULL, value + 60 FROM m WHERE kind = 'error' AND part = 1
  UNION ALL SELECT ts_ms, 'up', 'instance={WORKER}', NULL, NULL, CAST(CAST(floor(value) AS BIGINT) % 2 AS DOUBLE)
         FROM m WHERE kind = 'error' AND part = 2
  UNION ALL SELECT ts_ms, 'behind', 'connector={CONNECTOR}', NULL, NULL, value * 100000
         FROM m WHERE kind = 'error' AND part = 3)"""


def user_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors trigger and purchases resolve an alert of their user."""
    kind = F.col("event_type")
    return (
        read(spark, sf_dir, "events")
        .where(kind.isin("error", "purchase"))
        .select(
            F.when(kind == "error", "trigger").otherwise("resolve").alias("event_action"),
            F.concat(F.lit("user_"), F.col("user_id")).alias("table"),
            F.lit("stale_data").alias("error_type"),
            epoch_ms(F.col("ts")).alias("ts_ms"),
            F.col("event_id").alias("seq"),
        )
    )


ALERTS_SQL = f"""alerts AS (
  SELECT CASE event_type WHEN 'error' THEN 'trigger' ELSE 'resolve' END AS event_action,
         'user_' || user_id AS tab, 'cdc-user_' || user_id || '-stale_data' AS dedup_key,
         {MS_SQL} AS ts_ms, event_id AS seq
  FROM events WHERE event_type IN ('error', 'purchase'))"""

# Rule titles that stand for event types in webhook bodies.
TITLE_SQL = """CASE event_type WHEN 'click' THEN 'CDC Kafka Consumer Lag Too High'
         WHEN 'view' THEN 'CDC Spark Processor Not Running'
         WHEN 'signup' THEN 'DatasourceNoData'
         WHEN 'purchase' THEN '\U0001f534 SEV-1 (Critical)'
         ELSE 'Disk ' || (user_id % 5) END"""


def webhook_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as webhook bodies: one JSON text with one alert each."""
    kind = F.col("event_type")
    title = (
        F.when(kind == "click", "CDC Kafka Consumer Lag Too High")
        .when(kind == "view", "CDC Spark Processor Not Running")
        .when(kind == "signup", "DatasourceNoData")
        .when(kind == "purchase", "\U0001f534 SEV-1 (Critical)")
        .otherwise(F.concat(F.lit("Disk "), (F.col("user_id") % 5).cast("string")))
    )
    labels = F.create_map(
        F.lit("alertname"), title, F.lit("table"),
        F.concat(F.lit("t"), (F.col("user_id") % 4).cast("string")),
    )
    alert = F.struct(
        F.when(F.col("event_id") % 3 == 0, "resolved").otherwise("firing").alias("status"),
        labels.alias("labels"),
        F.create_map(F.lit("summary"), F.concat(F.lit("event "), F.col("event_id"))).alias("annotations"),
    )
    return read(spark, sf_dir, "events").select(
        "event_id", F.to_json(F.struct(F.array(alert).alias("alerts"))).alias("body")
    )


WEBHOOK_SQL = f"""hooks AS (
  SELECT event_id, {TITLE_SQL} AS title, 't' || (user_id % 4) AS tab,
         CASE WHEN event_id % 3 = 0 THEN 'resolved' ELSE 'firing' END AS status
  FROM events)"""
