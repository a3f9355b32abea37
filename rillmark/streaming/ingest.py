"""Streaming ingest: landing raw events and keeping bronze up to date."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rillmark import fixed_values as fv
from rillmark.functions.times import utc_date_parts
from rillmark.operators import alerts, changes, quality
from rillmark.operators.batches import DAY_BITS, EPOCH, batch_figures, filled, per_key, profile_row, unusable
from rillmark.plans.batch_run import RunConfig, failure_counts_of, report_runs
from rillmark.sinks import bronze, state, storage
from rillmark.sources.feed import envelope_schema, widened
from rillmark.spec import TableSpec

BATCH = fv.BATCH_COL


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    files_per_trigger: int = 1000,
) -> DataFrame:
    """A folder of files as a stream; the number of files per batch is bounded."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def _start(writer, once: bool, interval: str) -> StreamingQuery:
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def land_raw(
    feed: DataFrame, path: str, checkpoint: str, once: bool = False,
    rows_per_file: int = 0, interval: str = fv.LANDING_TRIGGER,
) -> StreamingQuery:
    """Writes change events below `table/year/month/day` by the event's UTC day.

    `feed` carries `table`. Files are as large as a micro-batch makes them;
    `rows_per_file` limits them (`fv.LANDING_RECORDS_PER_FILE` is the small-file
    profile that raw change logs are often landed with).
    """
    dated = feed.withColumns(utc_date_parts(F.col("ts_ms")))
    writer = (
        dated.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("table", *fv.DATE_PARTITIONS)
        .outputMode("append")
    )
    return _start(writer, once, interval)


@dataclass
class BronzeWriter:
    """A `foreachBatch` function: stores a micro-batch's newest row per key and reports on it.

    One scan per micro-batch. Events are brought together by key, which gives
    the newest row of each key and every count that checks need; the rows go on
    to the tasks that write their day, and the batch's figures are observed
    there, in the last stage, where a task that runs again does not count
    twice. Checks, gauges, alerts, the outcome and the mark come from these
    figures, not from further passes.

    Rows are appended to the day of their event, the layout that the catalog's
    tables declare, with the batch's number in `batch_id`; new days are
    registered. Only the first batch after a start can have been written
    before; it is looked for and then stored in its place. A batch never blocks:
    events that cannot be stored (no whole key in the declared types, or an
    unknown operation) are set aside under `quarantine`, in a second scan made
    only where there are some, and `replay_quarantine` takes them back in once
    the declaration or the events have been mended.
    """

    spec: TableSpec
    bronze_path: str
    state_root: str
    as_of: Callable[[], int]
    ties: tuple[str, ...] = ("seq",)
    keep_deletes: bool = True
    database: str | None = None
    freshness_limit_s: int = fv.FRESHNESS_LIMIT_S
    dashboard_url: str = ""
    last_batch: int | None = field(default=None, init=False)
    mark_ms: int | None = field(default=None, init=False)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, began, now = batch.sparkSession, time.monotonic(), self.as_of()
        first = self.last_batch is None or batch_id != self.last_batch + 1
        if first:
            self.mark_ms = state.load_mark(spark, f"{self.state_root}/marks", self.spec.name)
        known = self.mark_ms
        figures = self.store(batch, batch_id, first)
        self.last_batch = batch_id
        if not figures["events"]:
            return
        out = {
            "table": self.spec.name, "status": "ok" if figures["total"] else "only_deletes", "batch_id": batch_id,
            "started_ms": now, "ts_ms": now, "mark_state": "none" if known is None else "loaded", "mark_ms": known,
            "rows_read": figures["total"], "rows_late": figures["late"], "values_misfit": figures["misfits"],
            "rows_rejected": figures["unusable"], "rows_deduped": figures["storable_keys"],
            "rows_written": figures["written"], "consecutive_failures": 0,
        }
        if figures["unusable"]:
            aside = unusable(batch, self.spec).withColumn(BATCH, F.lit(batch_id))
            bronze.replace_partitions(aside, f"{self.state_root}/quarantine/{self.spec.name}", (BATCH,))
        newest = max(figures["feed_newest_ms"], -(2**62) if known is None else known)
        out["mark_saved"] = state.save_mark(spark, f"{self.state_root}/marks", self.spec.name, newest, now)
        if out["mark_saved"]:
            self.mark_ms = out["mark_ms"] = newest
        else:
            out.update(status="mark_failed", message="the mark was not saved")
        if figures["total"]:
            out["dq_passed"] = self.check(spark, figures, now)
        if self.database and figures["written"]:
            out["partition_registered"], out["message"] = self.register(spark, batch_id, figures)
        out["duration_s"] = time.monotonic() - began
        config = RunConfig(
            "", "", self.state_root, freshness_limit_s=self.freshness_limit_s, dashboard_url=self.dashboard_url
        )
        state.save_outcomes(spark, config.path("outcomes"), [out], now)
        report_runs(spark, [out], config, now)

    def store(self, batch: DataFrame, batch_id: int, may_repeat: bool) -> dict:
        """Writes the batch and returns its figures."""
        by_key = per_key(batch, self.spec, self.ties, self.keep_deletes, self.mark_ms)
        dated = by_key.withColumns(utc_date_parts(F.col(f"row.{self.spec.ts_col}")))
        seen = Observation()
        observed = bronze.balanced(dated, fv.DATE_PARTITIONS).observe(seen, *batch_figures(self.spec))
        rows = observed.where(F.col("row").isNotNull()).select(
            "row.*", F.lit(batch_id).cast("long").alias(BATCH), *fv.DATE_PARTITIONS
        )
        bronze.append_batch(rows, self.bronze_path, batch_id, f"{self.state_root}/staging/{self.spec.name}", may_repeat)
        return filled(seen.get)

    def check(self, spark: SparkSession, figures: dict, now: int) -> bool:
        """Reports the standard checks as gauges and alerts; whether all passed."""
        profile = profile_row(spark, self.spec, figures)
        graded = quality.as_change_log(
            quality.graded(quality.standard_checks(profile, self.spec.pk, now, self.freshness_limit_s))
        )
        state.append_rows(quality.check_gauges(graded, self.spec.name, now), f"{self.state_root}/metrics", now)
        failed = alerts.check_failure_events(graded, self.spec.name, now, 0, self.dashboard_url)
        state.append_rows(alerts.as_messages(failed, alerts.TRIGGER_FIELDS), f"{self.state_root}/outbox", now)
        return quality.gate(graded, ()).first()["all_passed"]

    def register(self, spark: SparkSession, batch_id: int, figures: dict) -> tuple[bool, str | None]:
        """Whether all days of the batch are in the catalog now, and why not."""
        lost = [
            day for day in self.days(spark, batch_id, figures)
            if not bronze.register_partition(spark, self.database, self.spec.name, self.bronze_path, day.year, day.month, day.day)
        ]
        spark.catalog.refreshByPath(self.bronze_path)
        return not lost, f"{len(lost)} days were not registered" if lost else None

    def days(self, spark: SparkSession, batch_id: int, figures: dict) -> list[date]:
        """The days a batch stored rows of: from the observed bitmap, or by reading where days lie outside it."""
        if 1 <= figures["first_day"] and figures["last_day"] <= DAY_BITS:
            bits = figures["days"]
            return [
                EPOCH + timedelta(days=at + 1) for at in range(figures["first_day"] - 1, figures["last_day"])
                if bits[at // 8] >> at % 8 & 1
            ]
        stored = spark.read.schema(f"{BATCH} long, year int, month int, day int").parquet(self.bronze_path)
        found = stored.where(F.col(BATCH) == batch_id).select(*fv.DATE_PARTITIONS).distinct()
        return [date(*row) for row in found.collect()]


def bronze_writer(spec: TableSpec, bronze_path: str, state_root: str, as_of: Callable[[], int], **options) -> BronzeWriter:
    """The `BronzeWriter` of a table; options are its further fields."""
    return BronzeWriter(spec, bronze_path, state_root, as_of, **options)


def replay_quarantine(
    spark: SparkSession, spec: TableSpec, bronze_path: str, state_root: str, schema: T.StructType,
    ties: tuple[str, ...] = ("seq",), keep_deletes: bool = True,
) -> int:
    """Stores the events set aside that can be stored now; returns how many still cannot.

    All batches are taken in one pass and stored under a number made from what
    is stored; then they leave the quarantine. A replay that ends between the
    two starts again with the same events, so it is stored in its own place.
    """
    path = f"{state_root}/quarantine/{spec.name}"
    held = bronze.written_before(spark, path, T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    if held is None:
        return 0
    rows = per_key(held.drop(BATCH), spec, ties, keep_deletes).where(F.col("row").isNotNull()).select("row.*")
    made = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("mix")).first()
    if made["n"]:
        batch_id = -1 - (made["mix"] & 2**62 - 1)
        dated = rows.withColumns({BATCH: F.lit(batch_id).cast("long"), **utc_date_parts(F.col(spec.ts_col))})
        bronze.append_batch(dated, bronze_path, batch_id, f"{state_root}/staging/replay-{spec.name}", True)
    staging = f"{state_root}/staging/left-{spec.name}"
    unusable(held, spec).write.mode("overwrite").parquet(staging)
    left = spark.read.schema(held.schema).parquet(staging)
    n_left = {row[BATCH]: row["count"] for row in left.groupBy(BATCH).count().collect()}  # one row per batch
    if n_left:
        bronze.replace_partitions(left, path, (BATCH,))
    for batch in storage.folders(spark, path, BATCH):
        if int(batch) not in n_left:
            storage.remove(spark, f"{path}/{BATCH}={batch}")
    return sum(n_left.values())


def stream_rows(
    batch: DataFrame, spec: TableSpec, ties: tuple[str, ...], keep_deletes: bool
) -> DataFrame:
    """The newest event per key of a batch, deletes as rows with only their key.

    The tie-break columns stay, so later batches can be ordered against it.
    """
    return per_key(batch, spec, ties, keep_deletes).where(F.col("row").isNotNull()).select("row.*")


def live_rows(bronze_rows: DataFrame, spec: TableSpec, ties: tuple[str, ...] = ("seq",)) -> DataFrame:
    """The live row per key over all batches in bronze: deletes win, then vanish."""
    newest = changes.current_state(bronze_rows, spec, ties)
    return newest.where(F.col(spec.op_col) != fv.OP_DELETE)


def keep_bronze(
    feed: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
    once: bool = False, interval: str = fv.LANDING_TRIGGER, name: str | None = None,
) -> StreamingQuery:
    """Runs a `bronze_writer` over a stream of change events."""
    writer = feed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _start(writer.queryName(name) if name else writer, once, interval)


def keep_all_bronze(
    spark: SparkSession, specs: Iterable[TableSpec], raw_root: str, bronze_root: str, state_root: str,
    as_of: Callable[[], int], fmt: str = "parquet", once: bool = False,
    interval: str = fv.LANDING_TRIGGER, **options,
) -> dict[str, StreamingQuery]:
    """One query per table, so a table that fails leaves the others running.

    Queries bear their table's name, by which a `StreamWatch` reports crashes;
    options go to each `BronzeWriter`.
    """
    running = {}
    for spec in specs:
        feed = file_stream(spark, f"{raw_root}/{spec.name}", envelope_schema(widened(spec.schema())), fmt)
        write = bronze_writer(spec, f"{bronze_root}/{spec.name}", state_root, as_of, **options)
        running[spec.name] = keep_bronze(
            feed, write, f"{state_root}/checkpoints/{spec.name}", once, interval, spec.name
        )
    return running


class StreamWatch(StreamingQueryListener):
    """Listens to the queries of `keep_all_bronze` and reports those that crash.

    A batch that is stored reports itself; one that fails cannot. Spark tells
    the listener, which remembers (it must not start jobs itself), and `flush`
    writes outcomes with the failures so far, gauges and crash events.
    """

    def __init__(self):
        self._names: dict[str, str] = {}
        self._ended: deque[tuple[str, str]] = deque()
        #: Of each query: number, rows and milliseconds of its newest batch.
        self.newest: dict[str, tuple[int, int, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        if event.name:
            self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:  # noqa: N802
        done = event.progress
        if done.name:
            self.newest[done.name] = (done.batchId, done.numInputRows, done.batchDuration)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        """Nothing to report."""

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        name = self._names.get(str(event.id))
        if name and event.exception:
            self._ended.append((name, event.exception))

    def flush(self, spark: SparkSession, config: RunConfig, now: int) -> int:
        """Reports the queries that crashed since the last call; returns how many."""
        ended = [self._ended.popleft() for _ in range(len(self._ended))]
        if not ended:
            return 0
        so_far = failure_counts_of(spark, config, [name for name, _ in ended], now)
        outcomes = []
        for name, text in ended:
            mark = state.load_mark(spark, config.path("marks"), name)
            outcomes.append({
                "table": name, "status": "crashed", "failed_step": "stream", "exception": "StreamingQueryException",
                "message": text.splitlines()[0], "mark_ms": mark, "started_ms": now, "ts_ms": now,
                "consecutive_failures": so_far.get(name, 0) + 1,
            })
        state.save_outcomes(spark, config.path("outcomes"), outcomes, now)
        report_runs(spark, outcomes, config, now)
        return len(outcomes)
