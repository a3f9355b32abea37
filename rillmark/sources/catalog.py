"""Ad hoc reads through the Spark catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark import fixed_values as fv


def databases(spark: SparkSession) -> DataFrame:
    """All databases; also the connection check before a run."""
    return spark.sql("SHOW DATABASES")


def tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").select("tableName")


def table_exists(spark: SparkSession, database: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{database}.{table}")


def partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Registered partitions as year, month, day."""
    spec = F.col("partition")
    listed = spark.sql(f"SHOW PARTITIONS {database}.{table}")
    return listed.select(
        *[F.regexp_extract(spec, rf"{p}=(\d+)", 1).cast("int").alias(p) for p in fv.DATE_PARTITIONS]
    )


def missing_partitions(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """Wanted partitions that are not registered yet."""
    return wanted.join(existing, list(fv.DATE_PARTITIONS), "left_anti")


def browse(spark: SparkSession, database: str, table: str, rows: int = 20) -> DataFrame:
    """A few rows of a table; a limit is what browsing asks for."""
    return spark.table(f"{database}.{table}").limit(rows)
