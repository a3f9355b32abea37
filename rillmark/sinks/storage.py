"""Folders and partitions of a table in whatever store its path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillmark.session import holding


def _store(spark: SparkSession, path: str):
    """(file system, path): Spark's own client of the store."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def folders(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the partition folders `column=value` right below a path, as numbers where all are."""
    store, where = _store(spark, path)
    if not store.exists(where):
        return []
    names = [s.getPath().getName() for s in store.listStatus(where) if s.isDirectory()]
    values = [n[len(column) + 1:] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if v.isdigit())


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return bool(store.exists(where))


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder with its files; false if there was none."""
    store, where = _store(spark, path)
    return bool(store.delete(where, True))


def overwrite_partitions(rows: DataFrame, table: str) -> None:
    """Writes rows in place of the table's partitions that they fall into; the others stay.

    `insertInto` takes the overwrite mode from the session alone, not from an
    option of the writer, and the default mode empties the whole table first.
    """
    with holding(rows.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        rows.write.mode("overwrite").insertInto(table)
