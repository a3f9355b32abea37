"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import holding, shared_dir
from rillmark.sinks import storage

#: Spark then removes the shuffle files of a query at its end, not when the driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Batches for Python of rows with texts or sets: the JVM holds a batch several times over, outside its heap.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written as a table in the cluster's shared folder and read again.

    Cuts the lineage: later steps re-read files when an executor is lost. What
    was shuffled to make the rows is removed once they are written.
    """
    path = shared_dir(df.sparkSession, purpose)
    with holding(df.sparkSession, CLEAN_SHUFFLES, "true"):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.saved_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of tables as `saved` gave them, which nothing that is still to run reads."""
    for table in tables:
        storage.remove(table.sparkSession, table.saved_at)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """SMALL_BATCHES for the time of a block."""
    with ExitStack() as held:
        for key, value in SMALL_BATCHES.items():
            held.enter_context(holding(spark, key, value))
        yield


def saved_in_small_batches(df: DataFrame, purpose: str) -> DataFrame:
    """`saved` of rows made in Python from texts or sets, which go there in SMALL_BATCHES."""
    with small_batches(df.sparkSession):
        return saved(df, purpose)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def pinned(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later expressions read instead of computing it again.

    Catalyst may copy a projected expression into every place that uses it; it
    does not copy through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def bounded_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Asks for a broadcast only where a counted number of rows is within the limit."""
    return F.broadcast(df) if rows <= limit else df
