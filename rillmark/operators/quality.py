"""Data-quality checks of a batch, in one scan.

`dq_report` returns one row per check. All standard checks come from a single
two-level aggregate: first per key (combined before the shuffle), then over
the keys. No check starts a scan of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions.severity import scoped_severity
from rillmark.functions.text import failed_constraint_message, percent_text
from rillmark.spec import CheckSpec

REPORT_COLUMNS = (
    "check_name",
    "error_type",
    "passed",
    "violation_rows",
    "total_rows",
    "violation_pct",
    "severity",
    "sev_label",
    "message",
)


def _n(flag: Column) -> Column:
    """How many rows hold; a null flag does not count."""
    return F.sum(F.when(flag, 1).otherwise(0))


def batch_profile(
    df: DataFrame,
    keys: Sequence[str],
    op_col: str | None = fv.CDC_OP,
    ts_col: str | None = fv.CDC_TS,
    ops: Sequence[str] = fv.STORED_OPS,
    only: Column | None = None,
) -> DataFrame:
    """One row with all counts the checks need.

    Uniqueness is over rows with a whole key: a null key breaks the null check
    only. An absent operation or time column leaves its figures null. `only`
    limits the checks to some rows (events that carry a row) while
    `feed_newest_ms` still covers all of them.
    """
    zero = F.lit(0)
    counts = F.lit(True) if only is None else only
    first = [_n(counts).alias("n")]
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    filled = whole & (F.col("n") > 0)
    no_figure = F.lit(None).cast("long")

    bad_ops, storable_keys = no_figure, no_figure
    if op_col and op_col in df.columns:
        stored = F.col(op_col).isin(*ops)
        first += [_n(counts & ~stored).alias("bad_ops"), _n(counts & stored).alias("stored")]
        bad_ops = F.coalesce(F.sum("bad_ops"), zero).cast("long")
        storable_keys = F.count(F.when(whole & (F.col("stored") > 0), 1))
    newest, feed_newest = no_figure, no_figure
    if ts_col and ts_col in df.columns:
        first += [F.max(F.when(counts, F.col(ts_col))).alias("newest"), F.max(ts_col).alias("latest")]
        newest, feed_newest = F.max("newest").cast("long"), F.max("latest").cast("long")

    nulls = [
        F.coalesce(F.sum(F.when(F.col(k).isNull(), F.col("n"))), zero).cast("long").alias(f"nulls_{k}")
        for k in keys
    ]
    return (
        df.groupBy(*keys)
        .agg(*first)
        .agg(
            bad_ops.alias("bad_ops"),
            storable_keys.alias("storable_keys"),
            newest.alias("newest_ms"),
            feed_newest.alias("feed_newest_ms"),
            *nulls,
            F.coalesce(F.sum("n"), zero).cast("long").alias("total"),
            F.coalesce(F.sum(F.when(whole, F.col("n"))), zero).cast("long").alias("keyed_rows"),
            F.count(F.when(filled, 1)).alias("keys"),
            F.count(F.when(filled & (F.col("n") == 1), 1)).alias("single_keys"),
        )
    )


def _row(name: str, kind: str, applies: Column, bad: Column, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("error_type"),
        applies.alias("applies"),
        bad.cast("long").alias("violation_rows"),
        message.alias("message"),
    )


def standard_checks(
    profile: DataFrame, keys: Sequence[str], as_of_ms: int, limit_s: int = fv.FRESHNESS_LIMIT_S
) -> DataFrame:
    """The profile row turned into one row per check.

    An empty batch yields the `non_empty` row alone.
    """
    total = F.col("total")
    filled = total > 0
    ok = F.lit(fv.ALL_PASSED)

    def ratio_message(name: str, bad: Column) -> Column:
        text = F.format_string(
            f"{name}: {fv.UNMET}",
            F.round(1 - bad / total, 6).cast("string"),
        )
        return F.when(bad > 0, text).otherwise(ok)

    rows = [
        _row(
            "non_empty", "empty_table", F.lit(True), F.lit(0),
            F.when(filled, ok).otherwise(fv.NO_ROWS),
        )
    ]
    for k in keys:
        bad = F.col(f"nulls_{k}")
        rows.append(
            _row(f"null_pk:{k}", "null_pk", filled, bad, ratio_message("Completeness", bad))
        )
    repeated = F.col("keyed_rows") - F.col("single_keys")
    rows.append(
        _row(
            "unique_pk:" + "+".join(keys), "duplicate_pk", filled, repeated,
            ratio_message("Uniqueness", repeated),
        )
    )
    bad_ops = F.col("bad_ops")
    rows.append(
        _row(
            "valid_cdc_op", "invalid_cdc_op", filled & bad_ops.isNotNull(), bad_ops,
            ratio_message("Compliance", bad_ops),
        )
    )
    age = (F.lit(as_of_ms) - F.col("newest_ms")) / 1000.0
    rows.append(
        _row(
            "freshness", "stale_data", filled & F.col("newest_ms").isNotNull(),
            F.when(age <= limit_s, 0).otherwise(1),
            F.format_string(fv.AGE_TEXT.format(limit=limit_s), age),
        )
    )
    return (
        profile.select(total.alias("total_rows"), F.explode(F.array(*rows)).alias("c"))
        .where("c.applies")
        .select(
            "c.check_name",
            "c.error_type",
            F.when(F.col("c.check_name") == "non_empty", F.col("total_rows") > 0)
            .otherwise(F.col("c.violation_rows") == 0)
            .alias("passed"),
            "c.violation_rows",
            "total_rows",
            "c.message",
        )
    )


def user_checks(df: DataFrame, checks: Sequence[CheckSpec]) -> DataFrame:
    """Assertions on any aggregate, all in one further scan."""
    metrics = [c.metric.cast("double").alias(f"m{i}") for i, c in enumerate(checks)]
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *metrics)
    rows = []
    for i, c in enumerate(checks):
        held = F.coalesce(c.passes(F.col(f"m{i}")), F.lit(False))
        rows.append(
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.error_type).alias("error_type"),
                held.alias("passed"),
                # A rule on an aggregate does not say which rows break it: as
                # with an unreadable message, all of them count.
                F.when(held, 0).otherwise(F.col("total_rows")).cast("long").alias("violation_rows"),
                F.when(held, fv.ALL_PASSED)
                .otherwise(F.format_string(fv.UNMET, F.col(f"m{i}").cast("string")))
                .alias("message"),
            )
        )
    return one.select("total_rows", F.explode(F.array(*rows)).alias("c")).select(
        "c.check_name", "c.error_type", "c.passed", "c.violation_rows", "total_rows", "c.message"
    )


def graded(results: DataFrame) -> DataFrame:
    """Adds the share text and the severity; a passed check has no severity."""
    level = scoped_severity(
        F.col("error_type"), F.col("violation_rows"), F.col("total_rows")
    )
    failed = ~F.col("passed")
    return results.withColumns(
        {
            "violation_pct": percent_text(F.col("violation_rows"), F.col("total_rows")),
            "severity": F.when(failed, level["severity"]),
            "sev_label": F.when(failed, level["sev_label"]),
        }
    ).select(*REPORT_COLUMNS)


def dq_report(
    df: DataFrame,
    keys: Sequence[str],
    as_of_ms: int,
    *,
    limit_s: int = fv.FRESHNESS_LIMIT_S,
    op_col: str | None = fv.CDC_OP,
    ts_col: str | None = fv.CDC_TS,
    checks: Sequence[CheckSpec] = (),
) -> DataFrame:
    """All checks of a batch, graded: size, null keys, repeated keys, operations, freshness."""
    profile = batch_profile(df, keys, op_col, ts_col)
    results = standard_checks(profile, keys, as_of_ms, limit_s)
    if checks:
        extra = user_checks(df, checks).where(F.col("total_rows") > 0)
        results = results.unionByName(extra)
    return graded(results)


def gate(report: DataFrame, not_blocking: Sequence[str] = ("stale_data",)) -> DataFrame:
    """One row: may the batch be written?

    By default old data is reported but does not hold a batch back; pass an
    empty tuple to hold it back too.
    """
    blocks = ~F.col("error_type").isin(*not_blocking) if not_blocking else F.lit(True)
    return report.agg(
        F.coalesce(F.min(F.when(blocks, F.col("passed"))), F.lit(True)).alias("may_write"),
        F.coalesce(F.min("passed"), F.lit(True)).alias("all_passed"),
    )


def check_gauges(report: DataFrame, table: str, ts_ms: int) -> DataFrame:
    """`cdc_dq_check_status` samples, 1 for a pass and 0 for a failure."""
    return report.select(
        F.lit("cdc_dq_check_status").alias("metric"),
        F.create_map(
            F.lit("table"), F.lit(table), F.lit("check"), F.col("check_name")
        ).alias("labels"),
        F.lit(ts_ms).cast("long").alias("ts_ms"),
        F.col("passed").cast("int").cast("double").alias("value"),
    )


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of non-null values per column, all columns in one pass."""
    parts = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *parts)
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("filled_rows"))
            for i, c in enumerate(columns)
        ]
    )
    return one.select("total_rows", F.explode(rows).alias("r")).select(
        "r.column_name",
        "r.filled_rows",
        "total_rows",
        F.when(F.col("total_rows") > 0, F.col("r.filled_rows") / F.col("total_rows")).alias(
            "completeness"
        ),
    )


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of rows whose key occurs exactly once, over rows with a whole key."""
    one = batch_profile(df, keys, None, None)
    return one.select(
        F.col("keyed_rows").alias("total_rows"),
        F.col("single_keys").alias("unique_rows"),
        "keys",
        F.when(F.col("keyed_rows") > 0, F.col("single_keys") / F.col("keyed_rows")).alias(
            "uniqueness"
        ),
    )


def containment(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Share of rows whose value is allowed; null passes."""
    held = F.col(column).isNull() | F.col(column).isin(*allowed)
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(_n(held), F.lit(0)).cast("long").alias("compliant_rows"),
        F.avg(F.when(held, 1.0).otherwise(0.0)).alias("compliance"),
    )


def freshness(df: DataFrame, ts_col: str, as_of_ms: int, limit_s: int) -> DataFrame:
    """Age of the newest event and whether it is within the limit (inclusive)."""
    age = (F.lit(as_of_ms) - F.col("newest_ms")) / 1000.0
    return df.agg(F.max(ts_col).cast("long").alias("newest_ms")).select(
        "newest_ms", age.alias("latency_seconds"), (age <= limit_s).alias("passed")
    )


def failure_message(constraints: DataFrame) -> DataFrame:
    """The texts of all failed constraints, joined with `; ` in name order.

    Takes (constraint, constraint_status, constraint_message): one row per
    check, so the list is as long as the list of checks.
    """
    failed = constraints.where(F.col("constraint_status") != "Success").select(
        "constraint", "constraint_message"
    )
    piece = failed_constraint_message(F.col("constraint"), F.col("constraint_message"))
    text = F.array_join(F.array_sort(F.collect_list(piece)), "; ")
    return failed.agg(
        F.when(F.count(F.lit(1)) > 0, text).otherwise(fv.ALL_PASSED).alias("message")
    )


def as_change_log(report: DataFrame) -> DataFrame:
    """A report on rows before the latest-per-key step.

    Repeated keys are normal in a change log, so that check passes and keeps
    its count as information.
    """
    info = F.col("error_type") == "duplicate_pk"
    return report.withColumns(
        {
            "passed": F.col("passed") | info,
            "severity": F.when(~info, F.col("severity")),
            "sev_label": F.when(~info, F.col("sev_label")),
        }
    )
