"""Readers of alert messages, webhook bodies and metric samples, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = (
    T.StructType()
    .add("topic", T.StringType())
    .add("key", T.StringType())
    .add("value", T.StringType())
    .add("ts_ms", T.LongType())
)
SAMPLE_SCHEMA = (
    T.StructType()
    .add("metric", T.StringType())
    .add("labels", T.MapType(T.StringType(), T.StringType()))
    .add("ts_ms", T.LongType())
    .add("value", T.DoubleType())
)


def kafka_messages(
    spark: SparkSession, servers: str, topics: Sequence[str], stream: bool = True
) -> DataFrame:
    """Messages of several topics as one feed, from the earliest offset.

    Needs the Kafka package on the class path.
    """
    reader = (spark.readStream if stream else spark.read).format("kafka")
    df = (
        reader.option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .load()
    )
    return df.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.unix_millis("timestamp").alias("ts_ms"),
    )


def file_messages(
    spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False,
    files_per_trigger: int = 1000,
) -> DataFrame:
    """The same feed from files of (topic, key, value, ts_ms)."""
    if stream:
        reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = spark.read
    return reader.format(fmt).schema(MESSAGE_SCHEMA).load(path)


def webhook_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One webhook body per text line."""
    return spark.read.text(path).withColumnRenamed("value", "body")


def metric_samples(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False) -> DataFrame:
    """The metrics table."""
    return (spark.readStream if stream else spark.read).format(fmt).schema(SAMPLE_SCHEMA).load(path)
