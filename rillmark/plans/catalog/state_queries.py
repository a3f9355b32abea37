"""Registered queries: results kept up to date batch by batch instead of being worked out anew."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.operators.check_states import CheckStates
from rillmark.operators.key_bitmaps import KeyBitmaps
from rillmark.operators.value_tree import reconcile_values
from rillmark.plans.batch_run import RunConfig, run_all
from rillmark.plans.catalog.change_queries import FLAT
from rillmark.plans.catalog.change_queries import QUERIES as CHANGES
from rillmark.plans.catalog.inputs import DAY_MS, END_MS, FEED_SQL, START_MS, Query, event_feed, read
from rillmark.plans.catalog.quality_queries import AS_OF, FLAT_SQL, REPORT, _report_sql, flat_events
from rillmark.session import shared_dir
from rillmark.sinks import state
from rillmark.sinks.current import CurrentTable
from rillmark.spec import ForeignKey, TableSpec
from rillmark.streaming import ingest

USERS = TableSpec("users", ("user_id",), "user_id BIGINT, event_id BIGINT, value DOUBLE, props STRING")
BATCHES = 5


def current_state_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of about a week merged one after another; some events come up to two days late."""
    root = shared_dir(spark, "current-state")
    table = CurrentTable.open(spark, f"current_{uuid.uuid4().hex}", root, USERS)
    feed = event_feed(spark, sf_dir)
    day = F.floor((F.col("ts_ms") - START_MS) / DAY_MS) + F.col("seq") % 3
    for n in range(BATCHES):
        batch = feed.where(F.least(F.floor(day / 7), F.lit(BATCHES - 1)) == n)
        table.merge(ingest.stream_rows(batch, USERS, ("seq",), True))
    return table.live().select(FLAT)


RANGES = (("2024-01-01", "2024-12-31"), ("2024-01-03", "2024-01-09"), ("2024-01-20", "2024-01-20"), ("2023-01-01", "2023-12-31"))


def dq_report_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over all days, a week, one day and no day, from states that two batches left."""
    root = shared_dir(spark, "check-states")
    states = CheckStates.open(spark, f"checks_{uuid.uuid4().hex}", root, {"user_id": "BIGINT"})
    rows = flat_events(spark, sf_dir)
    for n in range(2):
        states.add(rows.where(F.col("event_id") % 2 == n), n)
    reports = [
        states.report(first, last, AS_OF).select(F.lit(f"{first} {last}").alias("days"), *REPORT) for first, last in RANGES
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def _states_sql() -> str:
    parts = []
    for first, last in RANGES:
        day = "CAST(make_timestamp(cdc_ts_ms * 1000) AS DATE)"
        ctes = f"{FLAT_SQL}, within_days AS (SELECT * FROM flat WHERE {day} BETWEEN DATE '{first}' AND DATE '{last}')"
        parts.append(f"SELECT '{first} {last}' AS days, * FROM ({_report_sql(ctes, 'within_days', ('user_id',), AS_OF)})")
    return " UNION ALL ".join(parts)


def values_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy that lacks some, has others and has changed a few values."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    kept = orders.where(key % 41 != 0).withColumns({
        "o_totalprice": F.when(key % 43 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        "o_orderstatus": F.when(key % 47 != 0, F.col("o_orderstatus")),
    })
    more = orders.where(key % 53 == 0).withColumn("o_orderkey", -key)
    return reconcile_values(orders, kept.unionByName(more), ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


def _period(at: Column) -> Column:
    return F.when(F.year(at) < 1995, 0).when(F.year(at) < 1997, 1).otherwise(2)


PERIOD_SQL = "CASE WHEN year({0}) < 1995 THEN 0 WHEN year({0}) < 1997 THEN 1 ELSE 2 END"


def fk_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines of three periods against the orders known by then; every fifth order is never known."""
    index = KeyBitmaps(spark, shared_dir(spark, "key-bitmaps"))
    keys = [ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey")]
    orders = read(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0")
    lines = read(spark, sf_dir, "lineitem")
    out = None
    for n in range(3):
        tables = {
            "orders": orders.where(_period(F.col("o_orderdate")) == n), "lineitem": lines.where(_period(F.col("l_shipdate")) == n),
        }
        found = index.check_batch(tables, keys, n).select(F.lit(n).cast("long").alias("batch"), "orphan_values", "orphan_rows")
        out = found if out is None else out.unionByName(found)
    return out


SPLIT_MS = START_MS + 15 * DAY_MS


def _two_runs(spark: SparkSession, sf_dir: str, root: str) -> tuple[RunConfig, list[dict]]:
    """Events of two half months landed one after another, each processed by a run that stores deletes."""
    config = RunConfig(f"{root}/raw", f"{root}/bronze", f"{root}/state", keep_deletes=True)
    feed, outcomes = event_feed(spark, sf_dir), []
    for n, part in enumerate((feed.where(F.col("ts_ms") < SPLIT_MS), feed.where(F.col("ts_ms") >= SPLIT_MS))):
        part.write.mode("append").parquet(f"{root}/raw/users")
        outcomes += run_all(spark, [USERS], config, END_MS + n)
    return config, outcomes


def run_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs report, and what is live in bronze after them."""
    root = shared_dir(spark, "two-runs")
    config, _ = _two_runs(spark, sf_dir, root)
    log = state.log_rows(spark, config.path("outcomes"), state.OUTCOME_SCHEMA)
    bronze = spark.read.parquet(f"{root}/bronze/users")
    live = ingest.live_rows(bronze, USERS).agg(F.count(F.lit(1)).alias("live_rows"), F.sum("event_id").alias("live_ids"))
    return log.select(
        (F.col("ts_ms") - END_MS).alias("run"), "status", "mark_state", "rows_read", "rows_late", "values_misfit",
        "rows_rejected", "rows_written", "mark_saved", "mark_ms", "consecutive_failures",
    ).join(live)


def run_repeated_after_fault(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third run from the mark of the first, as after a second one that died before it saved its own."""
    root = shared_dir(spark, "run-again")
    config, outcomes = _two_runs(spark, sf_dir, root)
    state.save_mark(spark, config.path("marks"), "users", outcomes[0]["mark_ms"], END_MS + 2)
    run_all(spark, [USERS], config, END_MS + 3)
    bronze = spark.read.parquet(f"{root}/bronze/users")
    return bronze.groupBy("cdc_op").agg(F.count(F.lit(1)).alias("rows"), F.sum("seq").alias("seqs"), F.max("cdc_ts_ms").alias("newest_ms"))


STORED_SQL = f"""{FEED_SQL}, halves AS (SELECT *, CASE WHEN ts_ms < {SPLIT_MS} THEN 0 ELSE 1 END AS run FROM feed),
  stored AS (SELECT * FROM halves
    QUALIFY row_number() OVER (PARTITION BY run, user_id ORDER BY ts_ms DESC, event_id DESC) = 1)"""


QUERIES = {
    "run_two_batches": Query(
        run_two_batches,
        f"""WITH {STORED_SQL},
        live AS (SELECT count(*) AS live_rows, CAST(sum(event_id) AS BIGINT) AS live_ids FROM (SELECT * FROM stored
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1) WHERE op <> 'd'),
        runs AS (SELECT run, count(*) FILTER (op <> 'd') AS rows_read, count(DISTINCT user_id) AS rows_written,
          max(ts_ms) AS mark_ms, count(*) AS n FROM halves GROUP BY run)
        SELECT CAST(r.run AS BIGINT) AS run, 'ok' AS status, CASE WHEN r.run = 0 THEN 'none' ELSE 'loaded' END AS mark_state,
          rows_read, CASE WHEN r.run = 0 THEN 0 ELSE (SELECT n FROM runs WHERE run = 0) END AS rows_late,
          CAST(0 AS BIGINT) AS values_misfit, CAST(0 AS BIGINT) AS rows_rejected, rows_written, TRUE AS mark_saved, mark_ms,
          CAST(0 AS BIGINT) AS consecutive_failures, live_rows, live_ids
        FROM runs r CROSS JOIN live""",
    ),
    "run_repeated_after_fault": Query(
        run_repeated_after_fault,
        f"""WITH {STORED_SQL}
        SELECT op AS cdc_op, count(*) AS "rows", CAST(sum(event_id) AS BIGINT) AS seqs, max(ts_ms) AS newest_ms FROM stored GROUP BY 1""",
    ),
    "current_state_incremental": Query(current_state_incremental, CHANGES["current_state_deletes"].sql),
    "dq_report_from_states": Query(dq_report_from_states, _states_sql()),
    "reconcile_values": Query(
        values_reconciled,
        """WITH kept AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 47 <> 0 THEN o_orderstatus END AS o_orderstatus,
            CASE WHEN o_orderkey % 43 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
          FROM orders WHERE o_orderkey % 41 <> 0
          UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 53 = 0)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
          CASE WHEN b.o_orderkey IS NULL THEN 'only_source' WHEN a.o_orderkey IS NULL THEN 'only_stored' ELSE 'value' END AS difference
        FROM orders a FULL OUTER JOIN kept b ON a.o_orderkey = b.o_orderkey
        WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey IS DISTINCT FROM b.o_custkey
          OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus OR a.o_totalprice IS DISTINCT FROM b.o_totalprice""",
    ),
    "fk_incremental": Query(
        fk_incremental,
        f"""WITH o AS (SELECT o_orderkey, {PERIOD_SQL.format('o_orderdate')} AS batch FROM orders WHERE o_orderkey % 5 <> 0),
        l AS (SELECT l_orderkey, {PERIOD_SQL.format('l_shipdate')} AS batch FROM lineitem),
        lost AS (SELECT * FROM l WHERE NOT EXISTS (
          SELECT 1 FROM o WHERE o.o_orderkey = l.l_orderkey AND o.batch <= l.batch))
        SELECT CAST(b.batch AS BIGINT) AS batch, count(DISTINCT l_orderkey) AS orphan_values, count(l_orderkey) AS orphan_rows
        FROM (SELECT unnest([0, 1, 2]) AS batch) b LEFT JOIN lost ON lost.batch = b.batch GROUP BY b.batch""",
    ),
}
