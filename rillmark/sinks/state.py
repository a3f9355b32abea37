"""Small state tables: high-water marks, run outcomes, metrics and the alert outbox.

All of them are appended to and read back newest first. An append either shows
up whole or not at all, so a lost driver never leaves a torn mark behind. Logs
are partitioned by UTC day: readers prune to the days they need, and
`sinks.bronze.compact` merges the small files of a day that is over.
"""

from __future__ import annotations

import threading
import time
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK_SCHEMA = "table string, last_processed_ts_ms long, saved_ms long"
OUTCOME_SCHEMA = (
    "table string, status string, failed_step string, exception string, message string, "
    "rows_read long, rows_late long, values_misfit long, rows_rejected long, rows_deduped long, rows_written long, "
    "partition_registered boolean, mark_state string, mark_saved boolean, mark_ms long, dq_passed boolean, "
    "consecutive_failures long, started_ms long, ts_ms long, duration_s double, batch_id long"
)


#: Queries of one process append to the same folders, and a commit clears what another has not committed yet.
_ONE_AT_A_TIME = threading.RLock()


def _append(rows: DataFrame, path: str, by: str) -> None:
    with _ONE_AT_A_TIME:
        rows.write.mode("append").partitionBy(by).parquet(path)


def save_mark(spark: SparkSession, path: str, table: str, mark_ms: int, saved_ms: int | None = None) -> bool:
    """Appends a table's mark; false if that failed."""
    saved = int(time.time() * 1000) if saved_ms is None else saved_ms
    try:
        row = spark.createDataFrame([(table, int(mark_ms), saved)], MARK_SCHEMA)
        _append(row.coalesce(1), path, "table")
        return True
    except (PySparkException, Py4JJavaError):
        return False


def marks(spark: SparkSession, path: str) -> DataFrame:
    """The newest mark of every table."""
    return (
        spark.read.schema(MARK_SCHEMA).parquet(path)
        .groupBy("table")
        .agg(
            F.max_by("last_processed_ts_ms", F.struct("saved_ms", "last_processed_ts_ms")).alias(
                "last_processed_ts_ms"
            )
        )
    )


def read_mark(spark: SparkSession, path: str, table: str) -> tuple[str, int | None]:
    """(`loaded`, mark), or `none` or `unreadable` without one: a full backfill either way."""
    try:
        row = marks(spark, path).where(F.col("table") == table).first()
    except AnalysisException as error:
        missing = error.getCondition() == "PATH_NOT_FOUND"
        return ("none" if missing else "unreadable"), None
    except Exception:  # noqa: BLE001 - a broken state folder is an outcome, not a crash
        return "unreadable", None
    return ("none", None) if row is None else ("loaded", row["last_processed_ts_ms"])


def load_mark(spark: SparkSession, path: str, table: str) -> int | None:
    """A table's mark, None when there is none or it cannot be read."""
    return read_mark(spark, path, table)[1]


BEGUN_SCHEMA = "table string, batch_id long, mark_ms long, saved_ms long"


def begin_write(spark: SparkSession, path: str, table: str, mark_ms: int | None, run_ms: int) -> tuple[int, bool]:
    """(batch id, whether it may have been written before) of a write that starts from a mark.

    A write that began from the same mark never came to save the next one: its
    number is taken again. Otherwise a new write is noted under the run's time.
    """
    try:
        begun = spark.read.schema(BEGUN_SCHEMA).parquet(path).where(F.col("table") == table)
        last = begun.orderBy(F.desc("saved_ms"), F.desc("batch_id")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is not None and last["mark_ms"] == mark_ms:
        return last["batch_id"], True
    row = spark.createDataFrame([(table, run_ms, mark_ms, run_ms)], BEGUN_SCHEMA)
    _append(row.coalesce(1), path, "table")
    return run_ms, False


def append_rows(df: DataFrame, path: str, ts_ms: int) -> None:
    """Appends metrics, messages or outcomes to the log of their day."""
    _append(df.withColumn("log_day", F.lit(_day(ts_ms))), path, "log_day")


def log_rows(spark: SparkSession, path: str, schema: str, since_ms: int | None = None) -> DataFrame:
    """A log's rows, of all days or from a day on."""
    rows = spark.read.schema(f"{schema}, log_day string").parquet(path)
    if since_ms is not None:
        rows = rows.where(F.col("log_day") >= _day(since_ms))
    return rows.drop("log_day")


def _day(ts_ms: int) -> str:
    return datetime.fromtimestamp(ts_ms / 1000, tz=timezone.utc).strftime("%Y%m%d")


def save_outcomes(spark: SparkSession, path: str, rows: list[dict], ts_ms: int) -> None:
    """Appends one row per table run."""
    names = [f.split()[0] for f in OUTCOME_SCHEMA.split(", ")]
    data = [tuple(r.get(n) for n in names) for r in rows]
    append_rows(spark.createDataFrame(data, OUTCOME_SCHEMA).coalesce(1), path, ts_ms)


def last_outcomes(outcomes: DataFrame) -> DataFrame:
    """The newest outcome row of every table."""
    return outcomes.groupBy("table").agg(
        F.max_by("consecutive_failures", "ts_ms").alias("consecutive_failures"),
        F.max_by("status", "ts_ms").alias("status"),
    )


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Sends (key, value) messages. Needs the Kafka package on the class path."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
