"""Readers and shapers of change logs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark import fixed_values as fv
from rillmark.functions.text import route_topic

OK, EMPTY, UNREADABLE = "ok", "empty", "unreadable"


def _from_day(day: datetime) -> Column:
    """Files in date folders on or after a day, and files in no date folder, by their path alone."""
    year, month, date = fv.DATE_PARTITIONS
    pattern = rf"/{year}=(\d+)/{month}=(\d+)/{date}=(\d+)/"
    path = F.col("_metadata.file_path")
    y, m, d = (F.regexp_extract(path, pattern, i).try_cast("int") for i in (1, 2, 3))
    later_in_month = (m == day.month) & (d >= day.day)
    return y.isNull() | (y > day.year) | ((y == day.year) & ((m > day.month) | later_in_month))


def scan_change_log(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    since_ms: int | None = None,
    slack_days: int = 1,
) -> DataFrame:
    """All change files below a table's folder, found recursively whatever the layout.

    With a mark, files in date folders that lie before it are not read: events
    arrive after they happen, so a newer event cannot lie in an older folder, and
    `slack_days` covers clocks that differ. Files in no date folder are always
    read. `avro` needs the Avro package on the class path; other formats are
    built in.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.option("recursiveFileLookup", "true").load(path)
    if since_ms is None:
        return df
    day = datetime.fromtimestamp(since_ms / 1000, tz=timezone.utc) - timedelta(days=slack_days)
    return df.where(_from_day(day))


def try_open(spark: SparkSession, path: str, **options) -> tuple[str, DataFrame | None, str]:
    """(status, feed, error) without reading a row: a path that cannot be listed is an outcome."""
    try:
        return OK, scan_change_log(spark, path, **options), ""
    except (AnalysisException, PySparkException, Py4JJavaError) as error:
        return UNREADABLE, None, str(error).splitlines()[0]


def try_scan(spark: SparkSession, path: str, **options) -> tuple[str, DataFrame | None, str]:
    """(status, feed, error): an unreadable or empty source is an outcome, not a crash."""
    try:
        df = scan_change_log(spark, path, **options)
        if df.isEmpty():
            return EMPTY, None, ""
        return OK, df, ""
    except (AnalysisException, PySparkException) as error:
        return UNREADABLE, None, str(error).splitlines()[0]


def included(feed: DataFrame, tables: Sequence[str], column: str = "source.table") -> DataFrame:
    """Events of the listed tables."""
    return feed.where(F.col(column).isin(*tables))


def routed(feed: DataFrame, topic: str = "topic") -> DataFrame:
    """Adds `table`: the routed name of the topic."""
    return feed.withColumn("table", route_topic(F.col(topic)))


def without_tombstones(feed: DataFrame, value: str = "value") -> DataFrame:
    """Messages that carry a value."""
    return feed.where(F.col(value).isNotNull())


def widened(row: T.StructType) -> T.StructType:
    """A row's columns in the widest type of their kind, to read files with.

    A reader narrows what it finds to the type it is given without a word; a
    number over the declared type must arrive whole, for `changes.conform` to
    find that it does not fit.
    """
    whole, real = (T.ByteType, T.ShortType, T.IntegerType), (T.FloatType,)
    wide = lambda t: T.LongType() if isinstance(t, whole) else T.DoubleType() if isinstance(t, real) else t
    return T.StructType([T.StructField(f.name, wide(f.dataType)) for f in row.fields])


def envelope_schema(row: T.StructType) -> T.StructType:
    """Schema of a change event around a table's rows."""
    return (
        T.StructType()
        .add("op", T.StringType())
        .add("ts_ms", T.LongType())
        .add("before", row)
        .add("after", row)
        .add("seq", T.LongType())
    )
