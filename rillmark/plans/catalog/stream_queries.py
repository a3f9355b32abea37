"""Registered queries: streams over the given tables, run until all input is read.

Each stream writes to the shared folder and the query returns what it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.text import dedup_key
from rillmark.functions.times import epoch_ms
from rillmark.plans.catalog.alert_queries import incident_sql
from rillmark.plans.catalog.change_queries import QUERIES as CHANGES
from rillmark.plans.catalog.inputs import (
    ALERTS_SQL, DAY_MS, END_MS, FEED_SQL, MS_SQL, START_MS, Query, event_feed, event_op, read, user_alerts,
)
from rillmark.plans.catalog.series_queries import island_sql
from rillmark.session import shared_dir
from rillmark.sinks import bronze, state
from rillmark.sources import catalog
from rillmark.spec import TableSpec
from rillmark.streaming import batched, ingest, timed

USERS = TableSpec("users", ("user_id",), "user_id BIGINT, event_id BIGINT, value DOUBLE, props STRING")
HOUR = 3_600_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = read(spark, sf_dir, "events").schema
    # A table is a folder of files or, in small data sets, one file.
    stream = ingest.file_stream(spark, f"{sf_dir}/events.parquet", schema)
    return stream.withColumn("ts_ms", epoch_ms(F.col("ts")))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct("user_id", "event_id", "value", "props")
    op = event_op()
    return _events(spark, sf_dir).select(
        op.alias("op"), "ts_ms", F.when(op == "d", row).alias("before"),
        F.when(op != "d", row).alias("after"), F.col("event_id").alias("seq"),
    )


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events streamed into bronze, then the live row per key."""
    root = shared_dir(spark, "stream-cdc")
    write = ingest.bronze_writer(USERS, f"{root}/bronze", f"{root}/state", lambda: END_MS)
    _finish(ingest.keep_bronze(_feed(spark, sf_dir), write, f"{root}/checkpoint", once=True))
    live = ingest.live_rows(spark.read.parquet(f"{root}/bronze"), USERS)
    return live.select("user_id", "event_id", "value", "props", "cdc_ts_ms", "cdc_op")


def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events landed by table and day."""
    root = shared_dir(spark, "stream-landing")
    feed = _events(spark, sf_dir).select(
        F.col("event_type").alias("table"), "event_id", "ts_ms", "value"
    )
    _finish(ingest.land_raw(feed, f"{root}/raw", f"{root}/checkpoint", once=True, rows_per_file=100_000))
    landed = spark.read.parquet(f"{root}/raw")
    return landed.groupBy("table", "year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("event_id").alias("last_event")
    ).select(
        "table", *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")], "rows", "last_event"
    )


def _run(feed: DataFrame, write, root: str) -> None:
    _finish(ingest.keep_bronze(feed, write, f"{root}/checkpoint", once=True))


def stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents closed by a resolve, from state carried between micro-batches."""
    kind = F.col("event_type")
    events = _events(spark, sf_dir).where(kind.isin("error", "purchase")).select(
        dedup_key(F.concat(F.lit("user_"), F.col("user_id")), F.lit("stale_data")).alias("dedup_key"),
        F.when(kind == "error", "trigger").otherwise("resolve").alias("event_action"),
        "ts_ms", F.col("event_id").alias("seq"),
    )
    root = shared_dir(spark, "stream-incidents")
    _run(events, batched.incident_writer(root, ttl_ms=365 * 24 * HOUR), root)
    return batched.output(spark, root, batched.INCIDENT_OUTPUT).where("state = 'resolved'")


def stream_sustained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breaches that held for two hours, reported once."""
    samples = _events(spark, sf_dir).select(
        F.col("event_type").alias("series"), "ts_ms", (F.col("value") > 15).alias("breach")
    )
    root = shared_dir(spark, "stream-sustained")
    _run(samples, batched.sustained_writer(root, 2 * HOUR, chunk_ms=HOUR), root)
    return batched.output(spark, root, batched.FIRING_OUTPUT)


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notifications per user, at most one in four hours."""
    events = _events(spark, sf_dir).select(F.col("user_id").cast("string").alias("group_key"), "ts_ms")
    root = shared_dir(spark, "stream-repeats")
    _run(events, batched.repeat_writer(root, 4 * HOUR), root)
    return batched.output(spark, root, batched.NOTIFY_OUTPUT)


SLICES = 4
#: `event_id` declared too narrow: every larger one is a misfit.
NARROW = TableSpec("users", ("user_id",), "user_id BIGINT, event_id TINYINT, value DOUBLE, props STRING")


def _sliced(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The change feed as a stream of files, one slice of all events after another; times overlap."""
    feed = event_feed(spark, sf_dir)
    for n in range(SLICES):
        feed.where(F.col("seq") % SLICES == n).coalesce(1).write.mode("append").parquet(f"{root}/in")
    return ingest.file_stream(spark, f"{root}/in", feed.schema, files_per_trigger=1)


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each micro-batch of a stream into bronze reports of itself."""
    root = shared_dir(spark, "stream-outcomes")
    write = ingest.bronze_writer(NARROW, f"{root}/bronze", f"{root}/state", lambda: END_MS)
    _finish(ingest.keep_bronze(_sliced(spark, sf_dir, root), write, f"{root}/checkpoint", once=True))
    return state.log_rows(spark, f"{root}/state/outcomes", state.OUTCOME_SCHEMA).select(
        "batch_id", "status", "rows_read", "rows_late", "values_misfit", "rows_rejected", "rows_deduped",
        "rows_written", "mark_state", "mark_saved", "mark_ms", "dq_passed",
    )


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed bronze as SQL sees it: rows of each day that the catalog lists."""
    root = shared_dir(spark, "catalog-roundtrip")
    database = f"streamed_{uuid.uuid4().hex}"
    bronze.create_database(spark, database, f"{root}/bronze")
    bronze.create_tables(spark, database, f"{root}/bronze", [USERS])
    write = ingest.bronze_writer(USERS, f"{root}/bronze/users", f"{root}/state", lambda: END_MS, database=database)
    _finish(ingest.keep_bronze(_sliced(spark, sf_dir, root), write, f"{root}/checkpoint", once=True))
    rows = spark.table(f"{database}.users").groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"), F.max("event_id").alias("last_event")
    )
    listed = catalog.partitions(spark, database, "users")
    return listed.join(rows, ["year", "month", "day"], "left").select(
        *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")], "rows", "users", "last_event"
    )


def _alert_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Alerts as a stream of files of about six days each; every third one comes in up to two hours late.

    One alert long after all others ends the stream's time, so nothing waits for the watermark any more.
    """
    alerts = user_alerts(spark, sf_dir).select(
        dedup_key(F.col("table"), F.col("error_type")).alias("dedup_key"), "event_action", "ts_ms", "seq"
    )
    arrives = F.floor((F.col("ts_ms") - START_MS + F.col("seq") % 3 * HOUR) / (6 * DAY_MS))
    for n in range(6):
        alerts.where(F.least(arrives, F.lit(5)) == n).coalesce(1).write.mode("append").parquet(f"{root}/in")
    last = spark.createDataFrame([("end", "trigger", END_MS + 30 * DAY_MS, 0)], alerts.schema)
    last.coalesce(1).write.mode("append").parquet(f"{root}/in")
    return ingest.file_stream(spark, f"{root}/in", alerts.schema, files_per_trigger=1)


def stream_incidents_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents closed by a resolve, from the state store and its timers, over files with late events."""
    root = shared_dir(spark, "stream-timed")
    closed = timed.incidents(_alert_files(spark, sf_dir, root), ttl_ms=365 * DAY_MS, late="3 hours")
    write = (
        closed.writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    )
    with timed.state_store(spark):
        query = write.start()
    _finish(query)
    return spark.read.schema(batched.INCIDENT_OUTPUT).parquet(f"{root}/out")


STORED_SQL = f"""{FEED_SQL},
  batches AS (SELECT *, event_id % {SLICES} AS batch_id FROM feed),
  newest AS (SELECT * FROM (SELECT *, row_number() OVER (
      PARTITION BY batch_id, user_id ORDER BY ts_ms DESC, event_id DESC) AS rank FROM batches) WHERE rank = 1)"""

QUERIES = {
    "stream_outcomes": Query(
        stream_outcomes,
        f"""WITH {STORED_SQL},
        marks AS (SELECT batch_id, max(ts_ms) AS newest FROM batches GROUP BY 1),
        before AS (SELECT batch_id, newest, max(newest) OVER (ORDER BY batch_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM marks)
        SELECT b.batch_id, 'ok' AS status, count(*) FILTER (op <> 'd') AS rows_read,
          count(*) FILTER (b.ts_ms <= coalesce(m.mark, -1)) AS rows_late,
          count(*) FILTER (op <> 'd' AND b.event_id > 127) AS values_misfit, CAST(0 AS BIGINT) AS rows_rejected,
          count(DISTINCT user_id) FILTER (op <> 'd') AS rows_deduped,
          count(DISTINCT user_id) AS rows_written,
          CASE WHEN m.mark IS NULL THEN 'none' ELSE 'loaded' END AS mark_state, TRUE AS mark_saved,
          greatest(m.newest, coalesce(m.mark, m.newest)) AS mark_ms,
          {END_MS} - max(b.ts_ms) FILTER (op <> 'd') <= 900000 AS dq_passed
        FROM batches b JOIN before m USING (batch_id) GROUP BY b.batch_id, m.mark, m.newest""",
    ),
    "catalog_roundtrip": Query(
        catalog_roundtrip,
        f"""WITH {STORED_SQL},
        days AS (SELECT make_timestamp(ts_ms * 1000) AS moment, * FROM newest)
        SELECT CAST(year(moment) AS BIGINT) AS year, CAST(month(moment) AS BIGINT) AS month, CAST(day(moment) AS BIGINT) AS day,
          count(*) AS "rows", count(DISTINCT user_id) AS users, max(CASE WHEN op <> 'd' THEN event_id END) AS last_event
        FROM days GROUP BY 1, 2, 3""",
    ),
    "stream_cdc": Query(stream_cdc, CHANGES["current_state_deletes"].sql),
    "stream_landing": Query(
        stream_landing,
        f"""SELECT event_type AS "table", CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
          CAST(day(ts) AS BIGINT) AS day, count(*) AS rows, max(event_id) AS last_event
        FROM events GROUP BY 1, 2, 3, 4""",
    ),
    "stream_incidents": Query(
        stream_incidents,
        f"""WITH {ALERTS_SQL}, {incident_sql('dedup_key')}
        SELECT dedup_key, opened_ms, resolved_ms, triggers, state FROM pairs WHERE state = 'resolved'""",
    ),
    "stream_incidents_timed": Query(
        stream_incidents_timed,
        f"""WITH {ALERTS_SQL}, {incident_sql('dedup_key')}
        SELECT dedup_key, opened_ms, resolved_ms, triggers, state FROM pairs WHERE state = 'resolved'""",
    ),
    "stream_sustained": Query(
        stream_sustained,
        f"""WITH {island_sql()} SELECT event_type AS series, start_ms AS active_since_ms,
          start_ms + {2 * HOUR} AS firing_ms FROM isl WHERE breach AND end_ms - start_ms >= {2 * HOUR}""",
    ),
    "stream_repeats": Query(
        stream_repeats,
        f"""WITH RECURSIVE f AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS k,
            CAST(ceil(({MS_SQL}) / 60000.0) AS BIGINT) * 60000 AS t FROM events),
          s AS (SELECT k, min(t) AS t FROM f GROUP BY 1
            UNION ALL SELECT s.k, (SELECT min(f.t) FROM f WHERE f.k = s.k AND f.t >= s.t + {4 * HOUR})
            FROM s WHERE s.t IS NOT NULL)
        SELECT k AS group_key, t AS notified_ms FROM s WHERE t IS NOT NULL""",
    ),
}
