"""Bronze tables: creation, partitioned writes, registration and compaction."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark import fixed_values as fv
from rillmark.sinks.storage import folders, remove
from rillmark.sources.catalog import missing_partitions, partitions, table_exists
from rillmark.spec import TableSpec


def create_database(spark: SparkSession, database: str, location: str) -> None:
    """Creates the database at a location if it is missing."""
    where = location.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{where}'")


def create_tables(
    spark: SparkSession, database: str, root: str, specs: Iterable[TableSpec]
) -> dict[str, str]:
    """Creates missing tables; one that fails does not stop the others. Returns outcomes."""
    outcome = {}
    for spec in specs:
        try:
            if table_exists(spark, database, spec.name):
                outcome[spec.name] = "exists"
                continue
            spark.sql(spec.create_table_sql(database, f"{root}/{spec.name}"))
            outcome[spec.name] = "created"
        except Exception as error:  # noqa: BLE001 - reported to the caller
            outcome[spec.name] = f"failed: {error}"
    return outcome


def balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows brought together by partition column, in evenly sized tasks.

    Adaptive execution merges small and splits large partitions to the advisory
    size, so a day that holds a third of all rows is written by many tasks and
    a small one by a single task with one file.
    """
    return df.hint("rebalance", *columns)


def append(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Appends date-partitioned, snappy-compressed Parquet."""
    (
        df.write.mode("append")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*fv.DATE_PARTITIONS)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, by: Sequence[str] = fv.DATE_PARTITIONS) -> None:
    """Writes the partitions that occur in `df`, replacing only those.

    Writing the same batch again gives the same table: this is how replays and
    compaction stay free of duplicates.
    """
    (
        balanced(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def append_batch(
    rows: DataFrame, path: str, batch_id: int, staging: str, may_repeat: bool
) -> None:
    """Appends a micro-batch's rows, which carry `BATCH_COL`, to the days they belong to.

    A batch that may have been written before (the first one after a restart)
    is looked for first; if it is there, its days are rewritten without it and
    with `rows`, so that it is stored once. Its rows are found by the column's
    extremes in file footers.
    """
    if may_repeat:
        spark, schema = rows.sparkSession, rows.schema
        stored = written_before(spark, path, schema)
        mine = F.col(fv.BATCH_COL) == batch_id
        if stored is not None and not stored.where(mine).isEmpty():
            # Written once: what is observed of `rows` counts one pass over them.
            rows.write.mode("overwrite").parquet(f"{staging}/new")
            new = spark.read.schema(schema).parquet(f"{staging}/new")
            days = stored.where(mine).unionByName(new).select(*[F.col(c).alias(f"_{c}") for c in fv.DATE_PARTITIONS])
            same_day = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in fv.DATE_PARTITIONS]
            others = stored.where(~F.coalesce(mine, F.lit(False))).join(days.distinct(), same_day, "left_semi")
            others.unionByName(new).write.mode("overwrite").parquet(f"{staging}/all")
            replace_partitions(spark.read.schema(schema).parquet(f"{staging}/all"), path)
            return
    append(rows, path)


def written_before(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The rows below a path, None where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def register_partition(
    spark: SparkSession, database: str, table: str, path: str, year: int, month: int, day: int
) -> bool:
    """Registers one partition; true also when it was there already."""
    values = f"year={int(year)}, month={int(month)}, day={int(day)}"
    folder = f"{path}/year={int(year)}/month={int(month)}/day={int(day)}".replace("'", "\\'")
    try:
        spark.sql(
            f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS PARTITION ({values}) "
            f"LOCATION '{folder}'"
        )
        return True
    except Exception:  # noqa: BLE001 - the caller records the failed registration
        return False


def register_missing(
    spark: SparkSession, database: str, table: str, path: str, written: DataFrame
) -> int:
    """Registers the date partitions of `written` that the catalog lacks.

    What comes to the driver is one row per new date.
    """
    wanted = written.select(*fv.DATE_PARTITIONS).distinct()
    todo = missing_partitions(wanted, partitions(spark, database, table)).collect()
    return sum(register_partition(spark, database, table, path, *row) for row in todo)


def compact(
    spark: SparkSession, path: str, staging: str, values: Mapping[str, object]
) -> int:
    """Rewrites one partition's many small files as few large ones; returns its rows.

    `values` names the partition: a day of bronze, a day of a log, a table's
    marks. The rows are first written to a staging folder and counted there, so
    the partition is only replaced by a whole copy, and no job reads what it
    overwrites. Compact a partition that is over: rows that arrive meanwhile show
    in its listing, and then nothing is replaced.
    """
    by = list(values)
    source, files = _partition(spark, path, values)
    balanced(source, by).write.mode("overwrite").partitionBy(*by).parquet(staging)
    copy = spark.read.schema(source.schema).parquet(staging)
    rows, staged = source.count(), copy.count()
    if rows != staged:
        raise RuntimeError(f"staged {staged} of {rows} rows; nothing was replaced")
    if _partition(spark, path, values)[1] != files:
        raise RuntimeError("the partition changed while it was copied; nothing was replaced")
    replace_partitions(copy, path, by)
    return rows


def _partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> tuple[DataFrame, list[str]]:
    """A partition's rows, and its files as they are listed now; no row is read for the list.

    Only the partition's own folder is listed. The rows are those of the listed
    files, whatever arrives while they are copied.
    """
    folder = "/".join([path, *[f"{column}={value}" for column, value in values.items()]])
    reader = spark.read.option("basePath", path).option("mergeSchema", "true")
    files = sorted(reader.parquet(folder).inputFiles())
    return reader.parquet(*files), files


def expire(
    spark: SparkSession, path: str, before: date, database: str | None = None, table: str | None = None
) -> list[date]:
    """Drops the days before a date from the catalog, then from storage; returns them.

    The catalog goes first: a reader then never meets a partition without its
    files, and a run that ends between the two is finished by the next one,
    which finds the days by their folders.
    """
    old = [day for day in stored_days(spark, path) if day < before]
    if database and table:
        known = {date(*row) for row in partitions(spark, database, table).collect()}
        for day in sorted(known):
            if day < before:
                spark.sql(
                    f"ALTER TABLE {database}.{table} DROP IF EXISTS PARTITION "
                    f"(year={day.year}, month={day.month}, day={day.day})"
                )
    for day in old:
        remove(spark, f"{path}/year={day.year}/month={day.month}/day={day.day}")
    return old


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """Days that have a folder, in order; no file is opened."""
    found = []
    for year, month, day in ((y, m, d) for y in folders(spark, path, "year") for m in folders(spark, f"{path}/year={y}", "month")
                             for d in folders(spark, f"{path}/year={y}/month={m}", "day")):
        found.append(date(int(year), int(month), int(day)))
    return sorted(found)


def compact_day(
    spark: SparkSession, path: str, staging: str, year: int, month: int, day: int
) -> int:
    """`compact` for one day of a bronze table."""
    return compact(spark, path, staging, {"year": year, "month": month, "day": day})
