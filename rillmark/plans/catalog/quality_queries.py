"""Registered queries: data quality and source constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions.severity import scoped_severity
from rillmark.functions.text import percent_text, violations_from_message
from rillmark.operators import alerts, changes, integrity, quality
from rillmark.plans.catalog.inputs import (
    END_MS, FEED_SQL, LINE_SQL, MS_SQL, Query, event_feed, line_feed, read,
)
from rillmark.spec import CheckSpec, ForeignKey, TableSpec

REPORT = ["check_name", "error_type", "passed", "violation_rows", "total_rows", "violation_pct",
          "severity", "sev_label"]
AS_OF = END_MS + 600_000


def flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened events whose key is null above a value and whose deletes carry a row."""
    feed = event_feed(spark, sf_dir)
    row = F.coalesce("after", "before")
    return feed.select(
        F.when(row["value"] <= 100, row["user_id"]).alias("user_id"),
        row["event_id"].alias("event_id"),
        F.col("ts_ms").alias("cdc_ts_ms"),
        F.col("op").alias("cdc_op"),
    )


FLAT_SQL = f"""{FEED_SQL}, flat AS (
  SELECT CASE WHEN value <= 100 THEN user_id END AS user_id, event_id,
         ts_ms AS cdc_ts_ms, op AS cdc_op FROM feed)"""


def size(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.count(F.lit(1))
    full = read(spark, sf_dir, "events").agg(total.alias("rows"))
    none = read(spark, sf_dir, "events").where("value < 0").agg(total.alias("rows"))
    named = full.select(F.lit("events").alias("batch"), "rows").unionByName(
        none.select(F.lit("empty").alias("batch"), "rows")
    )
    return named.withColumn("passed", F.col("rows") >= 1)


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.completeness(flat_events(spark, sf_dir), ["user_id", "event_id", "cdc_op"])
    return found.withColumn("completeness", F.round("completeness", 6))


def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = quality.uniqueness(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    orders = quality.uniqueness(read(spark, sf_dir, "orders"), ["o_orderkey"])
    both = lines.withColumn("table", F.lit("lineitem")).unionByName(
        orders.withColumn("table", F.lit("orders"))
    )
    return both.withColumn("uniqueness", F.round("uniqueness", 6))


def containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.containment(read(spark, sf_dir, "orders"), "o_orderstatus", ["O", "F"])
    return found.withColumn("compliance", F.round("compliance", 6))


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flat_events(spark, sf_dir)
    parts = [
        quality.freshness(flat, "cdc_ts_ms", END_MS + gap * 1000, 900).withColumn("gap", F.lit(gap).cast("long"))
        for gap in (300, 86_400)
    ]
    return parts[0].unionByName(parts[1]).withColumn(
        "latency_seconds", F.round("latency_seconds", 3)
    )


def severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of real shares: per supplier and error type, the share of returned lines."""
    kinds = F.array(*[F.lit(k) for k in
                      ("null_pk", "duplicate_pk", "invalid_cdc_op", "empty_table", "stale_data", "other")])
    per = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when((F.col("l_returnflag") == "R") | (F.col("l_suppkey") % 3 == 0), 1).otherwise(0))
        .alias("flagged"),
    )
    bad = F.when(F.col("l_suppkey") % 5 == 0, 1).otherwise(F.col("flagged"))
    rows = per.select(
        "l_suppkey", "total_rows", bad.cast("long").alias("violation_rows"),
        F.explode(kinds).alias("error_type"),
    )
    level = scoped_severity(F.col("error_type"), F.col("violation_rows"), F.col("total_rows"))
    return rows.withColumns({"severity": level["severity"], "sev_label": level["sev_label"]})


def report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.dq_report(flat_events(spark, sf_dir), ["user_id"], AS_OF).select(REPORT)


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    return quality.dq_report(flat, ["l_orderkey", "l_linenumber"], AS_OF).select(REPORT)


def report_deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks again after the latest-per-key step: one shuffle serves both."""
    flat = changes.flatten(changes.storable(line_feed(spark, sf_dir)))
    keys = ["l_orderkey", "l_linenumber"]
    order = changes.newest_first(ties=["l_partkey", "l_extendedprice"])
    newest = changes.latest_per_key(flat, keys, order)
    return quality.dq_report(newest, keys, AS_OF).select(REPORT)


def report_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = flat_events(spark, sf_dir).where("cdc_ts_ms < 0")
    return quality.dq_report(none, ["user_id"], AS_OF).select(REPORT)


def gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old but valid data: held back only where freshness blocks."""
    clean = changes.flatten(changes.storable(event_feed(spark, sf_dir))).drop("user_id", "props", "value")
    report = quality.dq_report(clean, ["event_id"], END_MS + 86_400_000)
    lenient = quality.gate(report).withColumn("mode", F.lit("lenient"))
    strict = quality.gate(report, ()).withColumn("mode", F.lit("strict"))
    return lenient.unionByName(strict)


def user_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        CheckSpec("mean_price", "range", F.avg("l_extendedprice"), lambda v: v.between(1000, 100000)),
        CheckSpec("tax_limit", "range", F.max("l_tax"), lambda v: v < 0.05),
        CheckSpec("enough_rows", "size", F.count(F.lit(1)), lambda v: v >= 1000),
    ]
    return quality.graded(quality.user_checks(read(spark, sf_dir, "lineitem"), checks)).select(REPORT)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text of all failed constraints, a constraint per event type."""
    per = read(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.when(F.col("value") > 50, 1)).alias("high"), F.count(F.lit(1)).alias("n")
    )
    rows = per.select(
        F.concat(F.lit("CompletenessConstraint(Completeness("), "event_type", F.lit(",None))")).alias("constraint"),
        F.when(F.col("event_type") == "view", "Success").otherwise("Failure").alias("constraint_status"),
        F.when(F.col("event_type") == "error", "Empty state for analyzer Completeness")
        .otherwise(F.concat(F.lit("Value: "), F.col("high"), F.lit(" of "), F.col("n")))
        .alias("constraint_message"),
    )
    return quality.failure_message(rows)


def percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("part"),
    )
    # A share that ends in an exact half of the last digit rounds differently
    # from engine to engine; the parts are multiplied to stay clear of it.
    return per.select(
        "l_suppkey", percent_text(F.col("part") * 3, F.col("total") * 7).alias("share"),
        percent_text(F.col("part"), F.lit(0)).alias("none"),
    )


def parsed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts read back from messages with a passing fraction."""
    per = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("bad"),
    )
    text = F.concat(
        F.lit("Value: "), F.round(1 - F.col("bad") / F.col("total"), 9).cast("decimal(12,9)").cast("string"),
        F.lit(" does not meet the constraint requirement!"),
    )
    told = F.when(F.col("l_suppkey") % 10 == 0, "no figure here").otherwise(text)
    return per.select("l_suppkey", violations_from_message(told, F.col("total")).alias("violation_rows"))


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.dq_report(flat_events(spark, sf_dir), ["user_id"], AS_OF)
    samples = quality.check_gauges(report, "events", AS_OF)
    return samples.select(
        "metric", F.col("labels")["table"].alias("table"), F.col("labels")["check"].alias("check"),
        "ts_ms", "value",
    )


GIVEN_KEYS = (
    ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ForeignKey("lineitem", "l_partkey", "part", "p_partkey"),
    ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    ForeignKey("documents", "doc_id", "labels", "doc_id"),
    # A column that refers to its own table.
    ForeignKey("part", "p_size", "part", "p_partkey"),
)


def foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {t for fk in GIVEN_KEYS for t in (fk.child, fk.parent)}
    tables = {t: read(spark, sf_dir, t) for t in names}
    return integrity.foreign_key_report(tables, GIVEN_KEYS)


def orphan_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every second key of the parent, so that some values are lost.
    parent = read(spark, sf_dir, "orders").select((F.col("o_orderkey") * 2).alias("o_orderkey"))
    lost = integrity.orphan_keys(read(spark, sf_dir, "lineitem"), "l_orderkey", parent, "o_orderkey")
    return lost.select("fk_value", "rows")


PART = TableSpec(
    "part", ("p_partkey",),
    "p_partkey BIGINT NOT NULL, p_name VARCHAR(10) NOT NULL, p_brand VARCHAR(8), p_type VARCHAR(7)",
)


def table_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.table_constraints(read(spark, sf_dir, "part"), PART)


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = integrity.length_compliance(read(spark, sf_dir, "documents"), {"text": 2000, "source": 4, "lang": 2})
    return found.select("column_name", "violation_rows", "total_rows")


def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = (
        T.StructType().add("user_id", T.LongType(), False).add("event_id", T.LongType(), False)
        .add("cdc_op", T.StringType(), True)
    )
    return integrity.column_constraints(flat_events(spark, sf_dir), schema)


def primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = {
        "orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"],
        "supplier": ["s_suppkey"], "lineitem": ["l_orderkey", "l_linenumber"],
        "conversations": ["conv_id", "turn"], "documents": ["doc_id"],
    }
    parts = [
        integrity.primary_key(read(spark, sf_dir, t), k).withColumn("table", F.lit(t))
        for t, k in given.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.dq_report(flat_events(spark, sf_dir), ["user_id"], AS_OF)
    events = alerts.check_failure_events(report, "events", AS_OF, 2, "dash")
    return events.select(
        "event_action", "dedup_key", "severity", "table", "error_type", "group", "component", "source",
        F.get_json_object("custom_details", "$.check").alias("check"),
        F.get_json_object("custom_details", "$.violation_rows").cast("long").alias("violation_rows"),
        F.get_json_object("custom_details", "$.consecutive_failures").cast("long").alias("failures"),
        F.substring_index("summary", " FAILED", 1).alias("headline"), "timestamp",
    )


def _report_sql(ctes: str, source: str, keys: tuple[str, ...], as_of: int, ops: bool = True) -> str:
    """The checks of a batch as SQL, each written out on its own."""
    name = "+".join(keys)
    whole = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    cols = ", ".join(keys)
    nulls = "".join(
        f" UNION ALL SELECT 'null_pk:{k}', 'null_pk', (SELECT count(*) FROM {source} WHERE {k} IS NULL)"
        for k in keys
    )
    return f"""WITH {ctes}, t AS (SELECT count(*) AS total FROM {source}),
    found AS (
      SELECT 'non_empty' AS check_name, 'empty_table' AS error_type, CAST(0 AS BIGINT) AS bad
      {nulls}
      UNION ALL SELECT 'unique_pk:{name}', 'duplicate_pk', (SELECT coalesce(sum(n), 0) FROM (
        SELECT count(*) AS n FROM {source} WHERE {whole} GROUP BY {cols}) WHERE n > 1)
      UNION ALL SELECT 'valid_cdc_op', 'invalid_cdc_op',
        (SELECT count(*) FROM {source} WHERE cdc_op NOT IN ('c', 'u', 'r'))
      UNION ALL SELECT 'freshness', 'stale_data',
        (SELECT CASE WHEN ({as_of} - max(cdc_ts_ms)) / 1000.0 <= 900 THEN 0 ELSE 1 END FROM {source})),
    graded AS (
      SELECT check_name, error_type,
        CASE WHEN check_name = 'non_empty' THEN total > 0 ELSE bad = 0 END AS passed,
        CAST(bad AS BIGINT) AS violation_rows, total AS total_rows,
        CASE WHEN total > 0 THEN printf('%.2f%%', bad * 100.0 / total) ELSE 'N/A' END AS violation_pct,
        CASE WHEN total > 0 THEN bad / total ELSE 1.0 END AS share
      FROM found, t WHERE total > 0 OR check_name = 'non_empty')
    SELECT check_name, error_type, passed, violation_rows, total_rows, violation_pct,
      CASE WHEN passed THEN NULL
           WHEN error_type IN ('null_pk', 'duplicate_pk') AND share >= 0.5 THEN 'critical'
           WHEN error_type = 'invalid_cdc_op' AND share < 0.01 THEN 'warning'
           WHEN error_type = 'stale_data' THEN 'warning' ELSE 'error' END AS severity,
      CASE WHEN passed THEN NULL
           WHEN error_type IN ('null_pk', 'duplicate_pk') AND share >= 0.5 THEN 'SEV-1'
           WHEN error_type = 'invalid_cdc_op' AND share < 0.01 THEN 'SEV-3'
           WHEN error_type = 'stale_data' THEN 'SEV-3' ELSE 'SEV-2' END AS sev_label
    FROM graded"""


STORED_LINES_SQL = f"""{LINE_SQL}, stored AS (
  SELECT l_orderkey, l_linenumber, ts_ms AS cdc_ts_ms, op AS cdc_op, l_partkey, l_extendedprice
  FROM lines WHERE op <> 'd')"""
DEDUPED_SQL = f"""{STORED_LINES_SQL}, deduped AS (
  SELECT * FROM stored QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY cdc_ts_ms DESC, l_partkey DESC, l_extendedprice DESC) = 1)"""


def _fk_sql() -> str:
    parts = []
    for fk in GIVEN_KEYS:
        lost = (
            f"SELECT {fk.column} AS v FROM {fk.child} WHERE {fk.column} IS NOT NULL AND {fk.column} "
            f"NOT IN (SELECT {fk.parent_column} FROM {fk.parent} WHERE {fk.parent_column} IS NOT NULL)"
        )
        parts.append(
            f"SELECT '{fk.child}' AS child, '{fk.column}' AS fk_column, '{fk.parent}' AS parent, "
            f"count(DISTINCT v) AS orphan_values, count(*) AS orphan_rows FROM ({lost})"
        )
    return " UNION ALL ".join(parts)


def _pk_sql() -> str:
    given = {
        "orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey",
        "lineitem": "l_orderkey, l_linenumber", "conversations": "conv_id, turn", "documents": "doc_id",
    }
    return " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", (SELECT count(*) FROM {t}) AS total_rows,
        CAST(0 AS BIGINT) AS null_key_rows,
        (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM
          (SELECT count(*) AS n FROM {t} GROUP BY {k}) WHERE n > 1) AS repeated_key_rows"""
        for t, k in given.items()
    )


EVENT_REPORT_SQL = _report_sql(FLAT_SQL, "flat", ("user_id",), AS_OF)

QUERIES = {
    "dq_size": Query(
        size,
        """SELECT 'events' AS batch, count(*) AS rows, count(*) >= 1 AS passed FROM events
        UNION ALL SELECT 'empty', count(*), count(*) >= 1 FROM events WHERE value < 0""",
    ),
    "dq_completeness": Query(
        completeness,
        f"""WITH {FLAT_SQL}, c AS (
          SELECT 'user_id' AS column_name, count(user_id) AS filled_rows, count(*) AS total_rows FROM flat
          UNION ALL SELECT 'event_id', count(event_id), count(*) FROM flat
          UNION ALL SELECT 'cdc_op', count(cdc_op), count(*) FROM flat)
        SELECT *, round(filled_rows / total_rows, 6) AS completeness FROM c""",
    ),
    "dq_uniqueness": Query(
        uniqueness,
        """WITH g AS (SELECT 'lineitem' AS "table", count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
          UNION ALL SELECT 'orders', count(*) FROM orders GROUP BY o_orderkey)
        SELECT "table", CAST(sum(n) AS BIGINT) AS total_rows,
          count(CASE WHEN n = 1 THEN 1 END) AS unique_rows, count(*) AS keys,
          round(count(CASE WHEN n = 1 THEN 1 END) / sum(n), 6) AS uniqueness FROM g GROUP BY 1""",
    ),
    "dq_containment": Query(
        containment,
        """SELECT count(*) AS total_rows, count(CASE WHEN o_orderstatus IN ('O', 'F') THEN 1 END)
          AS compliant_rows, round(avg(CASE WHEN o_orderstatus IN ('O', 'F') THEN 1.0 ELSE 0.0 END), 6)
          AS compliance FROM orders""",
    ),
    "dq_freshness": Query(
        freshness,
        f"""WITH n AS (SELECT max({MS_SQL}) AS newest_ms FROM events),
        g AS (SELECT unnest([300, 86400]) AS gap)
        SELECT newest_ms, round(({END_MS} + gap * 1000 - newest_ms) / 1000.0, 3) AS latency_seconds,
          ({END_MS} + gap * 1000 - newest_ms) / 1000.0 <= 900 AS passed, CAST(gap AS BIGINT) AS gap
        FROM n, g""",
    ),
    "dq_severity": Query(
        severity,
        """WITH p AS (SELECT l_suppkey, count(*) AS total_rows,
            CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE
              sum(CASE WHEN l_returnflag = 'R' OR l_suppkey % 3 = 0 THEN 1 ELSE 0 END) END AS bad
          FROM lineitem GROUP BY l_suppkey),
        k AS (SELECT *, unnest(['null_pk', 'duplicate_pk', 'invalid_cdc_op', 'empty_table', 'stale_data',
          'other']) AS error_type FROM p),
        s AS (SELECT l_suppkey, total_rows, CAST(bad AS BIGINT) AS violation_rows, error_type,
          CASE WHEN error_type IN ('null_pk', 'duplicate_pk') AND bad / total_rows >= 0.5 THEN 1
               WHEN error_type = 'invalid_cdc_op' AND bad / total_rows < 0.01 THEN 3
               WHEN error_type = 'stale_data' THEN 3 ELSE 2 END AS lvl FROM k)
        SELECT l_suppkey, total_rows, violation_rows, error_type,
          CASE lvl WHEN 1 THEN 'critical' WHEN 2 THEN 'error' ELSE 'warning' END AS severity,
          'SEV-' || lvl AS sev_label FROM s""",
    ),
    "dq_report": Query(report_events, EVENT_REPORT_SQL),
    "dq_report_composite_key": Query(
        report_lines, _report_sql(STORED_LINES_SQL, "stored", ("l_orderkey", "l_linenumber"), AS_OF)
    ),
    "dq_report_after_dedup": Query(
        report_deduped, _report_sql(DEDUPED_SQL, "deduped", ("l_orderkey", "l_linenumber"), AS_OF)
    ),
    "dq_report_empty": Query(
        report_empty,
        _report_sql(
            FLAT_SQL + ", none AS (SELECT * FROM flat WHERE cdc_ts_ms < 0)", "none", ("user_id",), AS_OF
        ),
    ),
    "dq_gate": Query(
        gates,
        f"""WITH a AS (SELECT ({END_MS} + 86400000 - max({MS_SQL})) / 1000.0 <= 900 AS fresh FROM events
          WHERE event_type <> 'error')
        SELECT true AS may_write, fresh AS all_passed, 'lenient' AS mode FROM a
        UNION ALL SELECT fresh, fresh, 'strict' FROM a""",
    ),
    "dq_user_assertions": Query(
        user_assertions,
        """WITH m AS (SELECT count(*) AS n, avg(l_extendedprice) AS p, max(l_tax) AS t FROM lineitem),
        c AS (SELECT 'mean_price' AS check_name, 'range' AS error_type, p BETWEEN 1000 AND 100000 AS passed, n FROM m
          UNION ALL SELECT 'tax_limit', 'range', t < 0.05, n FROM m
          UNION ALL SELECT 'enough_rows', 'size', n >= 1000, n FROM m)
        SELECT check_name, error_type, passed, CASE WHEN passed THEN 0 ELSE n END AS violation_rows,
          n AS total_rows, CASE WHEN passed THEN '0.00%' ELSE '100.00%' END AS violation_pct,
          CASE WHEN NOT passed THEN 'error' END AS severity, CASE WHEN NOT passed THEN 'SEV-2' END AS sev_label
        FROM c""",
    ),
    "dq_failure_message": Query(
        messages,
        """WITH p AS (SELECT event_type, count(CASE WHEN value > 50 THEN 1 END) AS high, count(*) AS n
          FROM events GROUP BY 1),
        r AS (SELECT 'Completeness: ' || CASE WHEN event_type = 'error' THEN 'no rows to evaluate'
            ELSE 'Value: ' || high || ' of ' || n END AS piece FROM p WHERE event_type <> 'view')
        SELECT string_agg(piece, '; ' ORDER BY piece) AS message FROM r""",
    ),
    "dq_violation_percent": Query(
        percentages,
        """SELECT l_suppkey, printf('%.2f%%', count(CASE WHEN l_returnflag = 'R' THEN 1 END) * 3
            * 100.0 / (count(*) * 7)) AS share, 'N/A' AS none FROM lineitem GROUP BY 1""",
    ),
    "dq_counts_from_messages": Query(
        parsed_counts,
        """SELECT l_suppkey, CASE WHEN l_suppkey % 10 = 0 THEN count(*)
          ELSE greatest(1, count(CASE WHEN l_returnflag = 'R' THEN 1 END)) END AS violation_rows
        FROM lineitem GROUP BY l_suppkey""",
    ),
    "dq_check_gauges": Query(
        gauges,
        f"""SELECT 'cdc_dq_check_status' AS metric, 'events' AS "table", check_name AS "check",
          CAST({AS_OF} AS BIGINT) AS ts_ms, CASE WHEN passed THEN 1.0::DOUBLE ELSE 0.0 END AS value
        FROM ({EVENT_REPORT_SQL})""",
    ),
    "dq_failure_events": Query(
        failure_events,
        f"""SELECT 'trigger' AS event_action, 'cdc-events-' || error_type AS dedup_key, severity,
          'events' AS "table", error_type, 'data-quality' AS "group", 'spark/dq_checks' AS component,
          'spark-cdc' AS source, check_name AS "check", violation_rows, CAST(2 AS BIGINT) AS failures,
          '[CDC DQ ' || sev_label || '] ''events'': ' || check_name AS headline,
          strftime(make_timestamp({AS_OF}000), '%Y-%m-%dT%H:%M:%S') || '.000+00:00' AS timestamp
        FROM ({EVENT_REPORT_SQL}) WHERE NOT passed""",
    ),
    "fk_violations": Query(foreign_keys, _fk_sql()),
    "fk_orphan_values": Query(
        orphan_values,
        """SELECT l_orderkey AS fk_value, count(*) AS rows FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey * 2 FROM orders) GROUP BY 1""",
    ),
    "table_constraints": Query(
        table_constraints,
        """WITH n AS (SELECT count(*) AS total_rows FROM part), r AS (
          SELECT 'not_null' AS "constraint", 'p_partkey' AS column_name, (SELECT count(*) FROM part WHERE p_partkey IS NULL) AS violation_rows
          UNION ALL SELECT 'not_null', 'p_name', (SELECT count(*) FROM part WHERE p_name IS NULL)
          UNION ALL SELECT 'max_length', 'p_name', (SELECT count(*) FROM part WHERE length(p_name) > 10)
          UNION ALL SELECT 'max_length', 'p_brand', (SELECT count(*) FROM part WHERE length(p_brand) > 8)
          UNION ALL SELECT 'max_length', 'p_type', (SELECT count(*) FROM part WHERE length(p_type) > 7)
          UNION ALL SELECT 'key_not_null', 'p_partkey', (SELECT count(*) FROM part WHERE p_partkey IS NULL)
          UNION ALL SELECT 'key_unique', 'p_partkey', (SELECT count(*) - count(DISTINCT p_partkey) FROM part))
        SELECT "constraint", column_name, violation_rows, total_rows, 'part' AS "table" FROM r, n""",
    ),
    "length_compliance": Query(
        lengths,
        """SELECT unnest(['text', 'source', 'lang']) AS column_name,
          unnest([count(CASE WHEN length(text) > 2000 THEN 1 END),
                  count(CASE WHEN length(source) > 4 THEN 1 END),
                  count(CASE WHEN length(lang) > 2 THEN 1 END)]) AS violation_rows,
          count(*) AS total_rows FROM documents""",
    ),
    "not_null_constraints": Query(
        not_null,
        f"""WITH {FLAT_SQL} SELECT 'not_null' AS "constraint", unnest(['user_id', 'event_id']) AS column_name,
          unnest([count(*) - count(user_id), count(*) - count(event_id)]) AS violation_rows,
          count(*) AS total_rows FROM flat""",
    ),
    "primary_keys": Query(primary_keys, _pk_sql()),
}
