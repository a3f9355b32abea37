"""A batch of change events brought together by key: what it stores and every figure of it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.operators import changes
from rillmark.spec import TableSpec

EPOCH = date(1970, 1, 1)
#: Days from 1970-01-02 that one bitmap covers: to the year 2059.
DAY_BITS = 32_768
COUNTS = (
    "events", "taken", "total", "late", "misfits", "unusable", "bad_ops", "storable_keys", "unkeyed", "keys", "single_keys", "written",
)


def _stored_op() -> Column:
    return F.col("op").isin(*fv.STORED_OPS)


def per_key(
    batch: DataFrame, spec: TableSpec, ties: tuple[str, ...], keep_deletes: bool, mark_ms: int | None = None,
    only_new: bool = False,
) -> DataFrame:
    """One row per key of a batch: its newest storable row, null where none is, and counts of its events.

    Deletes are rows with only their key. Values are conformed to the declared
    types before events are compared, so each misfit counts once per event.
    Events without a whole key come together under what they have of it. With
    `only_new`, events at or before the mark are counted as late and no more.
    """
    names = batch.columns
    fields = batch.schema["after"].dataType.fieldNames()
    if lacking := [k for k in spec.pk if k not in fields]:
        raise ValueError(f"the feed of {spec.name} has no key column {', '.join(lacking)}")
    late = F.lit(False) if mark_ms is None else F.coalesce(F.col("ts_ms") <= mark_ms, F.lit(False))
    taken = ~late if only_new else F.lit(True)
    has_row = F.col("after").isNotNull()
    before = "before" in names
    values = []
    for name in fields:
        value = F.col(f"after.{name}")
        if before and name in spec.pk:
            value = F.when(has_row, value).otherwise(F.col(f"before.{name}"))
        values.append(value.alias(name))
    stored = taken & F.coalesce(_stored_op(), F.lit(False))
    is_delete = taken & F.coalesce(F.col("op") == fv.OP_DELETE, F.lit(False))
    flat = batch.select(
        *values, F.col("ts_ms").alias(spec.ts_col), F.col("op").alias(spec.op_col), *ties,
        (taken & has_row).alias("_has_row"), (has_row & stored).alias("_storable"), is_delete.alias("_delete"),
        (stored | is_delete).alias("_known"), (taken & has_row & ~_stored_op()).alias("_bad_op"),
        taken.alias("_taken"), late.alias("_late"),
    )
    typed = changes.conform(flat, spec.stored_schema(), "_misfits")
    whole = F.lit(True)
    for k in spec.pk:
        whole = whole & F.col(k).isNotNull()
    kept = F.col("_storable") | (F.col("_delete") & F.lit(keep_deletes and before))
    order = F.when(whole & kept, F.struct(spec.ts_col, *ties))
    columns = [*spec.stored_schema().fieldNames(), *ties]
    count = lambda flag: F.sum(F.when(flag, 1).otherwise(0))
    ts = F.col(spec.ts_col)
    return typed.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(spec.pk)]).agg(
        F.max_by(F.struct(*columns), order).alias("row"),
        F.count(F.lit(1)).alias("events"), count(F.col("_taken")).alias("n_taken"), count(F.col("_has_row")).alias("n"), count(F.col("_bad_op")).alias("n_bad_ops"),
        count(F.col("_has_row") & F.col("_storable")).alias("n_stored"),
        F.sum(F.when(F.col("_storable"), F.col("_misfits")).otherwise(0)).alias("n_misfits"),
        count(F.col("_taken") & ~(F.col("_known") & whole)).alias("n_unusable"), count(F.col("_late")).alias("n_late"),
        F.max(F.when(F.col("_has_row"), ts)).alias("newest"), F.max(F.when(F.col("_taken"), ts)).alias("latest"),
    )


def batch_figures(spec: TableSpec) -> list[Column]:
    """Figures of a batch over the rows of `per_key`, with the days of its rows as a bitmap."""
    keys = [F.col(f"_k{i}") for i in range(len(spec.pk))]
    whole = F.lit(True)
    for k in keys:
        whole = whole & k.isNotNull()
    n = F.col("n")
    day = F.when(F.col("row").isNotNull(), F.unix_date(F.timestamp_millis(F.col(f"row.{spec.ts_col}")).cast("date")))
    within = F.when(day.between(1, DAY_BITS), day)
    count = lambda flag: F.count(F.when(flag, 1))
    return [
        F.sum("events").alias("events"), F.sum("n_taken").alias("taken"), F.sum("n").alias("total"), F.sum("n_late").alias("late"),
        F.sum("n_misfits").alias("misfits"), F.sum("n_unusable").alias("unusable"), F.sum("n_bad_ops").alias("bad_ops"),
        count(whole & (F.col("n_stored") > 0)).alias("storable_keys"),
        F.max("newest").alias("newest_ms"), F.max("latest").alias("feed_newest_ms"),
        *[F.coalesce(F.sum(F.when(k.isNull(), n)), F.lit(0)).alias(f"nulls_{name}") for k, name in zip(keys, spec.pk, strict=True)],
        F.coalesce(F.sum(F.when(~whole, n)), F.lit(0)).alias("unkeyed"),
        count(whole & (n > 0)).alias("keys"), count(whole & (n == 1)).alias("single_keys"),
        count(F.col("row").isNotNull()).alias("written"),
        F.bitmap_construct_agg(F.bitmap_bit_position(within.cast("long"))).alias("days"),
        F.coalesce(F.min(day), F.lit(0)).alias("first_day"), F.coalesce(F.max(day), F.lit(0)).alias("last_day"),
    ]


def unusable(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Events that can be stored neither as a row nor as a delete."""
    has_row, before = F.col("after").isNotNull(), "before" in batch.columns
    keys = []
    for k in spec.pk:
        value = F.col("after").getField(k)
        keys.append((F.when(has_row, value).otherwise(F.col("before").getField(k)) if before else value).alias(k))
    typed = changes.with_declared_keys(batch.select(F.struct(*batch.columns).alias("_event"), *keys), spec)
    known = F.col("_event.op").isin(*fv.STORED_OPS, fv.OP_DELETE)
    whole = F.lit(True)
    for k in spec.pk:
        whole = whole & F.col(k).isNotNull()
    return typed.where(~(F.coalesce(known, F.lit(False)) & whole)).select("_event.*")


def filled(row) -> dict:
    """A row of `batch_figures` with zeros where a batch without rows has nulls."""
    return {name: value or 0 if name in COUNTS else value for name, value in row.items()}


def profile_row(spark: SparkSession, spec: TableSpec, figures: dict) -> DataFrame:
    """Figures as the one row that `quality.standard_checks` takes."""
    names = [f"nulls_{k}" for k in spec.pk]
    columns = ("bad_ops", "storable_keys", "newest_ms", "feed_newest_ms", *names, "total", "keyed_rows", "keys", "single_keys")
    keyed = figures | {"keyed_rows": figures["total"] - figures["unkeyed"]}
    return spark.createDataFrame([tuple(keyed[c] for c in columns)], ", ".join(f"{c} long" for c in columns))
