"""Registered queries: change-data processing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.text import route_topic
from rillmark.functions.times import epoch_ms, run_date_parts, utc_date_parts
from rillmark.operators import changes, series
from rillmark.plans.catalog.inputs import (
    DAY_MS, FEED_SQL, FLAT_SQL, LINE_SQL, MARK_MS, MS_SQL, START_MS, Query, event_feed, line_feed, read,
)
from rillmark.session import shared_dir
from rillmark.sinks import bronze
from rillmark.sources import feed as feeds

FLAT = ["user_id", "event_id", "value", "props", "cdc_ts_ms", "cdc_op"]


def last_write_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.flatten(changes.storable(event_feed(spark, sf_dir)))
    newest = changes.newest_first(ties=["event_id"])
    return changes.latest_per_key(rows, ["user_id"], newest).select(FLAT)


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    order = changes.newest_first(ties=["l_partkey", "l_extendedprice", "l_quantity"])
    return changes.latest_per_key(rows, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
        "l_partkey", "l_quantity", "l_extendedprice", "cdc_ts_ms", "cdc_op",
    )


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.newer_than(event_feed(spark, sf_dir), MARK_MS).select("seq", "ts_ms", "op")


def late(spark: SparkSession, sf_dir: str) -> DataFrame:
    left_out = changes.late_events(event_feed(spark, sf_dir), MARK_MS)
    return left_out.groupBy("op").agg(
        F.count(F.lit(1)).alias("late_events"), F.max("ts_ms").alias("newest_ms")
    )


def op_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.storable(event_feed(spark, sf_dir)).select("seq", "op", "ts_ms")


def flat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.flatten(changes.storable(event_feed(spark, sf_dir))).select(FLAT)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    return changes.batch_counts(rows, ["l_orderkey", "l_linenumber"])


def mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.high_water_mark(event_feed(spark, sf_dir))


def event_date_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = event_feed(spark, sf_dir).withColumns(utc_date_parts(F.col("ts_ms")))
    return dated.groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("rows")).select(
        *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")], "rows"
    )


def run_date_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    dated = rows.withColumns(run_date_parts(MARK_MS))
    return dated.groupBy("year", "month", "day", "cdc_op").agg(
        F.count(F.lit(1)).alias("rows")
    ).select(*[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")], "cdc_op", "rows")


def snapshot_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of orders, then order lines as later updates of their order."""
    orders = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("order_status"), "o_orderdate",
    )
    snapshot = changes.snapshot_as_feed(
        orders.select("order_id", "price", "order_status"), F.lit(START_MS - 9 * 365 * DAY_MS)
    )
    row = F.struct(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("price"),
        F.col("l_linestatus").alias("order_status"),
    )
    updates = read(spark, sf_dir, "lineitem").select(
        F.lit("u").alias("op"), epoch_ms(F.col("l_shipdate")).alias("ts_ms"), row.alias("after")
    )
    feed = changes.unite(snapshot, updates)
    order = changes.newest_first(ties=["price", "order_status"])
    return changes.latest_per_key(changes.flatten(changes.storable(feed)), ["order_id"], order)


def state_over_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day is a batch of its own; the state is the newest row over all batches."""
    rows = changes.flatten(changes.storable(event_feed(spark, sf_dir)))
    day = F.floor((F.col("cdc_ts_ms") - START_MS) / DAY_MS).cast("long")
    order = changes.newest_first(ties=["event_id"])
    stored = changes.latest_per_key(rows.withColumn("batch", day), ["user_id", "batch"], order)
    return changes.latest_per_key(stored, ["user_id"], order).select(*FLAT, "batch")


def state_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.current_state_with_deletes(event_feed(spark, sf_dir), ["user_id"]).select(FLAT)


def lines_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = line_feed(spark, sf_dir)
    live = changes.current_state_with_deletes(
        feed, ["l_orderkey", "l_linenumber"], ties=["l_partkey", "l_extendedprice", "op"]
    )
    return live.groupBy("cdc_op").agg(
        F.count(F.lit(1)).alias("live_rows"),
        F.sum("l_quantity").cast("long").alias("quantity"),
        F.max("cdc_ts_ms").alias("newest_ms"),
    )


def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Keys shifted on one side, so that either side has keys of its own.
    source = read(spark, sf_dir, "orders").select((F.col("o_orderkey") + 2).alias("order_id"))
    stored = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return changes.reconcile(source, stored, ["order_id"])


def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    topic = F.when(kind.isin("click", "view"), F.concat(F.lit("shop.public."), kind)).otherwise(
        F.concat(F.lit("shop."), kind)
    )
    routed = read(spark, sf_dir, "events").select(route_topic(topic).alias("table"), "value")
    return routed.groupBy("table").agg(F.count(F.lit(1)).alias("messages"))


def include_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = read(spark, sf_dir, "events").select(
        F.struct(F.col("event_type").alias("table"), F.col("event_id").alias("seq")).alias("source"),
        "value",
    )
    kept = feeds.included(feed, ["click", "purchase"])
    return kept.groupBy(F.col("source.table").alias("table")).agg(
        F.count(F.lit(1)).alias("messages"), F.max("source.seq").alias("last_seq")
    )


def tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = read(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("event_type") != "error", F.col("props")).alias("value")
    )
    return feeds.without_tombstones(messages).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("messages")
    )


def sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return changes.sample_k(rows, "c_custkey", 25)


def next_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = changes.next_key(read(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 10000)
    none = read(spark, sf_dir, "part").where("p_partkey < 0").select("p_partkey")
    return full.select(F.lit("orders").alias("table"), "next_key").unionByName(
        changes.next_key(none, "p_partkey", 100).select(F.lit("empty").alias("table"), "next_key")
    )


def conform_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys ten times as wide as the declared SMALLINT: no wrapped values, counted misfits."""
    declared = (
        T.StructType().add("order_id", T.ShortType()).add("customer_id", T.IntegerType())
        .add("priority", T.ShortType())
    )
    feed = read(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 10).alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "O", (F.col("o_custkey") * 40).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("priority"),
        "o_orderstatus",
    )
    fitted = changes.conform(feed, declared)
    return fitted.groupBy("o_orderstatus", "n_bad").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("order_id").cast("long").alias("order_ids"),
        F.sum("customer_id").cast("long").alias("customer_ids"),
        F.count("priority").alias("priorities"),
    ).withColumn("n_bad", F.col("n_bad").cast("long"))


def null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changes.flatten(changes.storable(event_feed(spark, sf_dir))).withColumn(
        "user_id", F.when(F.col("value") <= 100, F.col("user_id"))
    )
    _, rejected = changes.split_null_keys(rows, ["user_id"])
    return rejected.select("event_id", "cdc_op", "cdc_ts_ms")


def browse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").orderBy(
        "o_orderkey"
    ).limit(20)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest rows per key written by event month and read back."""
    path = shared_dir(spark, "bronze")
    rows = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    order = changes.newest_first(ties=["l_partkey", "l_extendedprice", "l_quantity"])
    newest = changes.latest_per_key(rows, ["l_orderkey", "l_linenumber"], order)
    # One folder per month: seven years of days would be thousands of tiny files.
    monthly = newest.withColumns({**utc_date_parts(F.col("cdc_ts_ms")), "day": F.lit(1)})
    bronze.replace_partitions(monthly, path)
    return spark.read.parquet(path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").cast("long").alias("quantity")
    ).select(*[F.col(c).cast("long").alias(c) for c in ("year", "month")], "rows", "quantity")


def jmx_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    attribute = (
        F.when(kind == "click", "MilliSecondsBehindSource")
        .when(kind == "view", "TotalNumberOfEventsSeen")
        .when(kind == "signup", "Connected")
        .otherwise("QueueRemainingCapacity")
    )
    bean = F.concat(
        F.lit("debezium.postgres<type=connector-metrics, context=streaming, server=db"),
        (F.col("user_id") % 3).cast("string"), F.lit("><>"), attribute,
    )
    beans = read(spark, sf_dir, "events").select(
        bean.alias("bean"), epoch_ms(F.col("ts")).alias("ts_ms"), "value"
    )
    return series.jmx_samples(beans).groupBy(
        "metric", F.col("labels")["connector"].alias("connector"), "metric_type"
    ).agg(F.count(F.lit(1)).alias("samples"), F.max("ts_ms").alias("last_ms"))


LWW_SQL = f"""WITH {FEED_SQL}, {FLAT_SQL}
SELECT user_id, event_id, value, props, cdc_ts_ms, cdc_op FROM flat
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY cdc_ts_ms DESC, event_id DESC) = 1"""

LINE_LWW_SQL = """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       l_quantity, l_extendedprice, ts_ms AS cdc_ts_ms, op AS cdc_op
FROM lines WHERE op <> 'd'
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY ts_ms DESC, l_partkey DESC, l_extendedprice DESC, l_quantity DESC) = 1"""

QUERIES = {
    "cdc_last_write_wins": Query(last_write_wins, LWW_SQL),
    "cdc_composite_key": Query(composite_key, f"WITH {LINE_SQL} {LINE_LWW_SQL}"),
    "cdc_incremental": Query(
        incremental,
        f"WITH {FEED_SQL} SELECT event_id AS seq, ts_ms, op FROM feed WHERE ts_ms > {MARK_MS}",
    ),
    "cdc_late_events": Query(
        late,
        f"""WITH {FEED_SQL} SELECT op, count(*) AS late_events, max(ts_ms) AS newest_ms
        FROM feed WHERE ts_ms <= {MARK_MS} GROUP BY op""",
    ),
    "cdc_op_filter": Query(
        op_filter,
        f"WITH {FEED_SQL} SELECT event_id AS seq, op, ts_ms FROM feed WHERE op IN ('c', 'u', 'r')",
    ),
    "cdc_flatten": Query(
        flat_rows,
        f"""WITH {FEED_SQL}, {FLAT_SQL}
        SELECT user_id, event_id, value, props, cdc_ts_ms, cdc_op FROM flat""",
    ),
    "cdc_counts": Query(
        counts,
        f"""WITH {LINE_SQL}, stored AS (SELECT * FROM lines WHERE op <> 'd')
        SELECT (SELECT count(*) FROM stored) AS rows_read,
          (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM stored)) AS rows_deduped,
          (SELECT max(ts_ms) FROM stored) AS max_ts_ms""",
    ),
    "cdc_high_water_mark": Query(
        mark, f"WITH {FEED_SQL} SELECT max(ts_ms) AS last_processed_ts_ms FROM feed"
    ),
    "cdc_partition_columns": Query(
        event_date_partitions,
        """SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
        CAST(day(ts) AS BIGINT) AS day, count(*) AS rows FROM events GROUP BY 1, 2, 3""",
    ),
    "cdc_run_date_partitions": Query(
        run_date_partitions,
        f"""WITH {LINE_SQL} SELECT CAST(2024 AS BIGINT) AS year, CAST(1 AS BIGINT) AS month,
        CAST(15 AS BIGINT) AS day, op AS cdc_op, count(*) AS rows
        FROM lines WHERE op <> 'd' GROUP BY op""",
    ),
    "snapshot_union": Query(
        snapshot_union,
        f"""WITH u AS (
          SELECT o_orderkey AS order_id, o_totalprice AS price, o_orderstatus AS order_status,
                 {START_MS - 9 * 365 * DAY_MS} AS cdc_ts_ms, 'r' AS cdc_op FROM orders
          UNION ALL SELECT l_orderkey, l_extendedprice, l_linestatus,
                 epoch_us(l_shipdate) // 1000, 'u' FROM lineitem)
        SELECT order_id, price, order_status, cdc_ts_ms, cdc_op FROM u
        QUALIFY row_number() OVER (PARTITION BY order_id
          ORDER BY cdc_ts_ms DESC, price DESC, order_status DESC) = 1""",
    ),
    "current_state": Query(
        state_over_batches,
        f"""WITH {FEED_SQL}, {FLAT_SQL}, b AS (
          SELECT *, (cdc_ts_ms - {START_MS}) // {DAY_MS} AS batch FROM flat
          QUALIFY row_number() OVER (PARTITION BY user_id, batch
            ORDER BY cdc_ts_ms DESC, event_id DESC) = 1)
        SELECT user_id, event_id, value, props, cdc_ts_ms, cdc_op, batch FROM b
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY cdc_ts_ms DESC, event_id DESC) = 1""",
    ),
    "current_state_deletes": Query(
        state_with_deletes,
        f"""WITH {FEED_SQL}, newest AS (SELECT * FROM feed
          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1)
        SELECT user_id, event_id, value, props, ts_ms AS cdc_ts_ms, op AS cdc_op
        FROM newest WHERE op <> 'd'""",
    ),
    "current_state_composite_deletes": Query(
        lines_with_deletes,
        f"""WITH {LINE_SQL}, newest AS (SELECT * FROM lines
          QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY ts_ms DESC, l_partkey DESC, l_extendedprice DESC, op DESC) = 1)
        SELECT op AS cdc_op, count(*) AS live_rows, CAST(sum(l_quantity) AS BIGINT) AS quantity,
          max(ts_ms) AS newest_ms FROM newest WHERE op <> 'd' GROUP BY op""",
    ),
    "reconcile": Query(
        reconcile,
        """WITH a AS (SELECT o_orderkey + 2 AS k, count(*) AS n FROM orders GROUP BY 1),
        b AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
        SELECT CASE WHEN b.k IS NULL THEN 'only_source' WHEN a.k IS NULL THEN 'only_stored'
                    ELSE 'both' END AS side, count(*) AS keys,
          CAST(coalesce(sum(a.n), 0) AS BIGINT) AS source_rows,
          CAST(coalesce(sum(b.n), 0) AS BIGINT) AS stored_rows
        FROM a FULL OUTER JOIN b ON a.k = b.k GROUP BY 1""",
    ),
    "topic_route": Query(
        topic_route,
        r"""WITH t AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'shop.public.' || event_type
          ELSE 'shop.' || event_type END AS topic FROM events)
        SELECT regexp_replace(topic, '^([^.]+)\.([^.]+)\.([^.]+)$', '\3') AS "table",
          count(*) AS messages FROM t GROUP BY 1""",
    ),
    "include_list": Query(
        include_list,
        """SELECT event_type AS "table", count(*) AS messages, max(event_id) AS last_seq FROM events
        WHERE event_type IN ('click', 'purchase') GROUP BY 1""",
    ),
    "tombstone_filter": Query(
        tombstones,
        "SELECT event_type, count(*) AS messages FROM events WHERE event_type <> 'error' GROUP BY 1",
    ),
    "sample_k": Query(
        sample,
        f"""SELECT c_custkey, c_name, c_mktsegment FROM customer
        ORDER BY (c_custkey * {changes.MIX_MULTIPLIER}) % {changes.MIX_MODULUS}, c_custkey LIMIT 25""",
    ),
    "next_key": Query(
        next_keys,
        """SELECT 'orders' AS "table", coalesce(max(o_orderkey), 10000) + 1 AS next_key FROM orders
        UNION ALL SELECT 'empty', coalesce(max(p_partkey), 100) + 1 FROM part WHERE p_partkey < 0""",
    ),
    "conform_types": Query(
        conform_types,
        """WITH c AS (SELECT o_orderstatus, TRY_CAST(o_orderkey * 10 AS SMALLINT) AS order_id,
            TRY_CAST(o_custkey AS INTEGER) AS customer_id,
            TRY_CAST(CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey * 40 AS VARCHAR)
              ELSE o_orderpriority END AS SMALLINT) AS priority FROM orders)
        SELECT o_orderstatus,
          CAST((order_id IS NULL)::INT + (customer_id IS NULL)::INT + (priority IS NULL)::INT AS BIGINT) AS n_bad,
          count(*) AS rows, CAST(sum(order_id) AS BIGINT) AS order_ids,
          CAST(sum(customer_id) AS BIGINT) AS customer_ids, count(priority) AS priorities
        FROM c GROUP BY 1, 2""",
    ),
    "null_key_rejects": Query(
        null_keys,
        f"""WITH {FEED_SQL}, {FLAT_SQL}
        SELECT event_id, cdc_op, cdc_ts_ms FROM flat WHERE value > 100""",
    ),
    "browse": Query(
        browse,
        "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20",
    ),
    "bronze_roundtrip": Query(
        bronze_roundtrip,
        f"""WITH {LINE_SQL}, n AS ({LINE_LWW_SQL}), d AS (
          SELECT *, make_timestamp(cdc_ts_ms * 1000) AS t FROM n)
        SELECT CAST(year(t) AS BIGINT) AS year, CAST(month(t) AS BIGINT) AS month, count(*) AS rows,
          CAST(sum(l_quantity) AS BIGINT) AS quantity FROM d GROUP BY 1, 2""",
    ),
    "jmx_metric_names": Query(
        jmx_names,
        f"""SELECT CASE event_type WHEN 'click' THEN 'debezium_metrics_millisecondsbehindource'
            WHEN 'view' THEN 'debezium_metrics_totalnumberofeventsseen_total'
            ELSE 'debezium_metrics_connected' END AS metric,
          'db' || (user_id % 3) AS connector,
          CASE event_type WHEN 'view' THEN 'counter' ELSE 'gauge' END AS metric_type,
          count(*) AS samples, max({MS_SQL}) AS last_ms
        FROM events WHERE event_type IN ('click', 'view', 'signup') GROUP BY 1, 2, 3""",
    ),
}
