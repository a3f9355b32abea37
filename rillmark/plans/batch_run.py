"""One batch run over the replicated tables: read, check, write, mark, report."""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.functions.times import run_date_parts
from rillmark.operators import alerts, batches, changes, quality, series
from rillmark.sinks import bronze, state
from rillmark.sources import feed as feeds
from rillmark.sources.catalog import missing_partitions, partitions
from rillmark.sources.schema_ledger import SchemaLedger
from rillmark.spec import TableSpec


@dataclass(frozen=True)
class RunConfig:
    """Where a run reads and writes, and how strict it is."""

    raw_root: str
    bronze_root: str
    state_root: str
    database: str | None = None
    fmt: str = "parquet"
    lookback_ms: int = 0
    freshness_limit_s: int = fv.FRESHNESS_LIMIT_S
    freshness_blocks: bool = False
    #: Columns that order events of one millisecond; `seq` where the feed has it, unless given.
    ties: tuple[str, ...] | None = None
    seq_path: str | None = None
    #: Deletes are stored as rows with only their key, for a state that knows of them.
    keep_deletes: bool = False
    dashboard_url: str = ""
    #: A mark that cannot be read fails the run; this reads the whole history instead.
    backfill_unreadable_mark: bool = False

    def path(self, name: str) -> str:
        return f"{self.state_root}/{name}"


class StepError(Exception):
    """An error with the step it happened in and what was known by then."""

    def __init__(self, step: str, cause: BaseException, known: dict):
        super().__init__(str(cause))
        self.step, self.kind, self.known = step, type(cause).__name__, known


class _Steps:
    """Remembers the current step, so a crash can name it."""

    def __init__(self):
        self.name = "start"

    def __call__(self, name: str) -> None:
        self.name = name


def batch_rows(
    new: DataFrame, spec: TableSpec, ties: tuple[str, ...] = (), keep_deletes: bool = False
) -> DataFrame:
    """The rows a batch stores: newest version per key, in the declared types, with what orders them.

    Rows without a whole key are not versions of each other; they are left out.
    """
    return batches.per_key(new, spec, ties, keep_deletes).where(F.col("row").isNotNull()).select("row.*")


def run_table(
    spark: SparkSession, spec: TableSpec, config: RunConfig, run_ms: int, failures_so_far: int = 0
) -> dict:
    """Processes one table; returns its outcome row.

    Two passes over the events: one aggregate for all checks and counts, late
    events and misfits among them, and one write. Only single-row results come
    to the driver. A run that ended between its write and its mark is found by
    what it noted before the write; the next run then replaces its rows.
    """
    step = _Steps()
    out = {
        "table": spec.name, "status": "ok", "started_ms": run_ms, "ts_ms": run_ms,
        "rows_read": 0, "rows_late": 0, "rows_rejected": 0, "rows_deduped": 0, "rows_written": 0,
    }
    began = time.monotonic()
    try:
        step("load_mark")
        out["mark_state"], mark = state.read_mark(spark, config.path("marks"), spec.name)
        out["mark_ms"] = mark
        if out["mark_state"] == "unreadable" and not config.backfill_unreadable_mark:
            raise ValueError("the mark cannot be read; a backfill must be asked for")

        step("scan")
        since = None if mark is None else mark - config.lookback_ms
        root = f"{config.raw_root}/{spec.name}"
        status, feed, error = feeds.try_open(spark, root, fmt=config.fmt, since_ms=since)
        if feed is None:
            out.update(status=status, message=error or None)
            return out
        if config.fmt == "parquet":
            # Under the columns of all files, not of whichever Spark looks at first.
            ledger = SchemaLedger(spark, config.path("columns"), spec.name)
            ledger.update(root)
            feed = feeds.scan_change_log(spark, root, config.fmt, ledger.schema(), since)
        ties = config.ties
        if config.seq_path:
            feed, ties = changes.with_sequence(feed, config.seq_path), (*(ties or ()), "seq")
        elif ties is None:
            ties = ("seq",) if "seq" in feed.columns else ()

        step("profile")
        grouped = batches.per_key(feed, spec, ties, config.keep_deletes, since, only_new=True)
        found = grouped.agg(*batches.batch_figures(spec))
        try:
            figures = batches.filled(found.first().asDict())
        except (PySparkException, Py4JJavaError) as fault:
            # What Spark says of a file it cannot read reaches Python in either form.
            out.update(status=feeds.UNREADABLE, message=str(fault).splitlines()[0])
            return out
        if not figures["taken"] or figures["feed_newest_ms"] is None:
            out["status"] = "no_new_events" if figures["events"] else feeds.EMPTY
            return out
        report = quality.as_change_log(
            quality.graded(
                quality.standard_checks(
                    batches.profile_row(spark, spec, figures), spec.pk, run_ms, config.freshness_limit_s
                )
            )
        )
        out["rows_read"], out["rows_late"] = figures["total"], figures["late"]
        out["values_misfit"] = figures["misfits"]
        out["rows_rejected"] = figures["unkeyed"]
        out["rows_deduped"] = figures["storable_keys"]
        if figures["total"]:
            step("checks")
            verdict = quality.gate(report, () if config.freshness_blocks else ("stale_data",)).first()
            out["dq_passed"] = verdict["all_passed"]
            state.append_rows(
                quality.check_gauges(report, spec.name, run_ms), config.path("metrics"), run_ms
            )
            state.append_rows(
                alerts.as_messages(
                    alerts.check_failure_events(
                        report, spec.name, run_ms, failures_so_far, config.dashboard_url
                    ),
                    alerts.TRIGGER_FIELDS,
                ),
                config.path("outbox"),
                run_ms,
            )
            if not verdict["may_write"]:
                out["status"] = "gate_failed"
                return out

        else:
            out["status"] = "only_deletes"

        written = None
        if figures["written"]:
            step("write")
            written = f"{config.bronze_root}/{spec.name}"
            batch_id, again = state.begin_write(spark, config.path("begun"), spec.name, mark, run_ms)
            new = changes.newer_than(feed, mark, config.lookback_ms)
            rows = batch_rows(new, spec, ties, config.keep_deletes).withColumns(
                {fv.BATCH_COL: F.lit(batch_id).cast("long"), **run_date_parts(run_ms)}
            )
            bronze.append_batch(rows, written, batch_id, config.path(f"staging/{spec.name}"), again)
            # One row per key was written; the key count is exact even when
            # tasks ran twice, unlike a counter kept while writing.
            out["rows_written"] = figures["written"]

        step("save_mark")
        # Over all events read: a delete moves the mark on too.
        newest = figures["feed_newest_ms"]
        out["mark_saved"] = state.save_mark(spark, config.path("marks"), spec.name, newest, run_ms)
        if out["mark_saved"]:
            out["mark_ms"] = newest
        else:
            # The next run reads these events again.
            out.update(status="mark_failed", message="the mark was not saved")

        if config.database and written:
            # After the mark: the rows are there whatever the catalog says.
            step("register")
            out["partition_registered"], fault = registered(spark, config.database, spec.name, written, run_ms)
            out["message"] = out.get("message") or fault
        return out
    except Exception as error:
        out["duration_s"] = time.monotonic() - began
        raise StepError(step.name, error, out) from error
    finally:
        out["duration_s"] = time.monotonic() - began


def registered(spark: SparkSession, database: str, table: str, path: str, run_ms: int) -> tuple[bool, str | None]:
    """Whether the run's partition is in the catalog now, and why not."""
    day = spark.range(1).select(*[c.alias(n) for n, c in run_date_parts(run_ms).items()])
    try:
        bronze.register_missing(spark, database, table, path, day)
        ok = missing_partitions(day, partitions(spark, database, table)).isEmpty()
        return ok, None if ok else "the partition was not registered"
    except Exception as error:  # noqa: BLE001 - kept in the outcome
        return False, f"the partition was not registered: {str(error).splitlines()[0]}"


def run_all(
    spark: SparkSession, specs: Iterable[TableSpec], config: RunConfig, run_ms: int
) -> list[dict]:
    """Runs every table; one that crashes does not stop the others.

    Outcomes, gauges, crash events and freshness events go to the state
    folders. Failure counts come from the outcome log, so they live on from
    one process to the next.
    """
    outcomes = []
    specs = list(specs)
    streaks = failure_counts_of(spark, config, [spec.name for spec in specs], run_ms)
    for spec in specs:
        so_far = streaks.get(spec.name, 0)
        try:
            outcome = run_table(spark, spec, config, run_ms, so_far)
        except StepError as error:
            # The mark as it was stays in the outcome: old data shows when runs crash.
            outcome = error.known | {
                "status": "crashed", "failed_step": error.step, "exception": error.kind,
                "message": str(error).splitlines()[0] if str(error) else "",
            }
        failed = outcome["status"] in FAILED
        outcome["consecutive_failures"] = so_far + 1 if failed else (
            0 if outcome["status"] in SUCCEEDED else so_far
        )
        outcomes.append(outcome)
    state.save_outcomes(spark, config.path("outcomes"), outcomes, run_ms)
    report_runs(spark, outcomes, config, run_ms)
    return outcomes


FAILED = ("crashed", "gate_failed", "unreadable", "mark_failed")
SUCCEEDED = ("ok", "only_deletes")


def failure_counts(outcomes: DataFrame) -> DataFrame:
    """Failures per table since its last success."""
    order = F.struct("ts_ms", "status")
    success = outcomes.where(F.col("status").isin(*SUCCEEDED)).groupBy("table").agg(
        F.max("ts_ms").alias("_good_ms")
    )
    failed = outcomes.where(F.col("status").isin(*FAILED)).select("table", "ts_ms", order.alias("_o"))
    return (
        failed.join(success, "table", "left")
        .where(F.col("_good_ms").isNull() | (F.col("ts_ms") > F.col("_good_ms")))
        .groupBy("table")
        .agg(F.count(F.lit(1)).alias("consecutive_failures"))
    )


def failure_counts_of(spark: SparkSession, config: RunConfig, tables: list[str], run_ms: int) -> dict[str, int]:
    """Each table's count from its last outcome: recent log days first, then all of them."""
    found: dict[str, int] = {}
    for since in (run_ms - fv.OUTCOME_DAYS * 86_400_000, None):
        try:
            log = state.log_rows(spark, config.path("outcomes"), state.OUTCOME_SCHEMA, since)
            # One row per table comes to the driver.
            rows = state.last_outcomes(log.where(~F.col("table").isin(list(found)))).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}  # no log yet
        found |= {r["table"]: r["consecutive_failures"] or 0 for r in rows}
        if set(tables) <= set(found):
            break
    return found


def run_gauges(spark: SparkSession, outcomes: list[dict], run_ms: int) -> DataFrame:
    """The run's figures as metric samples.

    Last-run time is set on success only; a failed run leaves it alone.
    """
    rows = [
        (
            o["table"],
            float(o.get("rows_written") or 0),
            o.get("duration_s"),
            run_ms / 1000.0 if o["status"] in SUCCEEDED + ("no_new_events", "empty") else None,
            float(o.get("rows_read") or 0),
            run_ms / 1000.0 if o.get("dq_passed") is not None else None,
            (run_ms - o["mark_ms"]) / 1000.0 if o.get("mark_ms") is not None else None,
            float(o.get("consecutive_failures") or 0),
        )
        for o in outcomes
    ]
    gauges = [g for g in fv.GAUGES if g != "cdc_dq_check_status"]
    schema = "table string, " + ", ".join(f"{g} double" for g in gauges)
    wide = spark.createDataFrame(rows, schema)
    labels = F.create_map(F.lit("table"), F.col("table"))
    return series.gauges_long(wide, gauges, labels, F.lit(run_ms))


def report_runs(spark: SparkSession, outcomes: list[dict], config: RunConfig, run_ms: int) -> None:
    """Gauges, crash events and freshness events of some table runs."""
    state.append_rows(run_gauges(spark, outcomes, run_ms), config.path("metrics"), run_ms)
    fields = [
        (o["table"], o["status"], o.get("failed_step"), o.get("exception"), o.get("message"),
         int(o.get("consecutive_failures") or 0), run_ms)
        for o in outcomes
    ]
    runs = spark.createDataFrame(
        fields,
        "table string, status string, failed_step string, exception string, message string, "
        "consecutive_failures long, ts_ms long",
    )
    crashed = alerts.as_messages(alerts.crash_events(runs, config.dashboard_url), alerts.TRIGGER_FIELDS)
    state.append_rows(crashed, config.path("outbox"), run_ms)
    held = [
        (o["table"], o["mark_ms"], int(o.get("consecutive_failures") or 0)) for o in outcomes if o.get("mark_ms") is not None
    ]
    if held:
        marks = spark.createDataFrame(held, "table string, last_processed_ts_ms long, consecutive_failures long")
        fresh = alerts.freshness_events(
            marks, run_ms, config.freshness_limit_s, dashboard_url=config.dashboard_url
        )
        state.append_rows(
            alerts.as_messages(fresh, alerts.TRIGGER_FIELDS), config.path("outbox"), run_ms
        )
