"""Change-feed operators: filter, flatten, latest version per key, conform, reconcile.

A change feed has the columns ``op``, ``ts_ms``, ``after`` and, where the source
gives them, ``before`` and ``seq`` (the order of events within one millisecond).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark import fixed_values as fv
from rillmark.spec import TableSpec


def newer_than(feed: DataFrame, mark_ms: int | None, lookback_ms: int = 0) -> DataFrame:
    """Events strictly after the mark; all of them when there is no mark."""
    if mark_ms is None:
        return feed
    return feed.where(F.col("ts_ms") > F.lit(mark_ms - lookback_ms))


def late_events(feed: DataFrame, mark_ms: int | None, lookback_ms: int = 0) -> DataFrame:
    """The side output of `newer_than`: events it leaves out."""
    if mark_ms is None:
        return feed.where(F.lit(False))
    return feed.where(F.col("ts_ms") <= F.lit(mark_ms - lookback_ms))


def storable(feed: DataFrame, ops: Sequence[str] = fv.STORED_OPS) -> DataFrame:
    """Events that carry a row to store."""
    return feed.where(F.col("op").isin(*ops) & F.col("after").isNotNull())


def with_sequence(feed: DataFrame, path: str) -> DataFrame:
    """Adds `seq` from a field of the envelope, such as the source's log position."""
    return feed.withColumn("seq", F.col(path))


def flatten(feed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The fields of `after` as columns, plus the event's time and operation."""
    return feed.select(
        "after.*",
        F.col("ts_ms").alias(fv.CDC_TS),
        F.col("op").alias(fv.CDC_OP),
        *keep,
    )


def snapshot_as_feed(rows: DataFrame, ts_ms: Column, seq: Column | None = None) -> DataFrame:
    """A table's rows as `r` events, to be united with its changes."""
    cols = [
        F.lit(fv.OP_SNAPSHOT).alias("op"),
        ts_ms.cast("long").alias("ts_ms"),
        F.struct(*rows.columns).alias("after"),
    ]
    return rows.select(*cols, *([] if seq is None else [seq.alias("seq")]))


def unite(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Feeds as one; columns that a feed lacks are null."""
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows with a null in the key).

    Both are plain filters. Rows without a key must not take part in the
    latest-per-key step: they would be taken for versions of one row.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return df.where(whole), df.where(~whole)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under `order` (descending time, then tie-breaks).

    Catalyst turns the rank filter into a limit per map task before the
    shuffle, so even a key that holds a third of all rows sends one row per
    task and no task receives its history.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def newest_first(spec_ts: str = fv.CDC_TS, ties: Sequence[str] = ()) -> list[Column]:
    return [F.col(spec_ts).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in ties]]


def current_state(history: DataFrame, spec: TableSpec, ties: Sequence[str] = ()) -> DataFrame:
    """The newest stored version of every key over all of bronze."""
    rows, _ = split_null_keys(history, spec.pk)
    return latest_per_key(rows, spec.pk, newest_first(spec.ts_col, ties))


def current_state_with_deletes(
    feed: DataFrame, keys: Sequence[str], ties: Sequence[str] = ("seq",)
) -> DataFrame:
    """The live row of every key: a key whose newest event is a delete is gone.

    A delete has no `after`; its key comes from `before`. The ranking runs on
    the envelope, and only the winners are flattened.
    """
    # "u" without a row cannot be stored and is no delete either.
    usable = feed.where((F.col("op") == fv.OP_DELETE) | F.col("after").isNotNull())
    keyed = usable.withColumns(
        {f"_key_{k}": F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")) for k in keys}
    )
    key_cols = [f"_key_{k}" for k in keys]
    rows, _ = split_null_keys(keyed, key_cols)
    newest = latest_per_key(rows, key_cols, newest_first("ts_ms", ties))
    return flatten(newest.where(F.col("op").isin(*fv.STORED_OPS)).drop(*key_cols))


def batch_counts(flat: DataFrame, keys: Sequence[str], ts_col: str = fv.CDC_TS) -> DataFrame:
    """Rows before and after the latest-per-key step, and the newest time: one pass.

    Counting per key first combines on the map side; the second aggregate only
    sees one partial row per task.
    """
    per_key = flat.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("newest")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_read"),
        F.count(F.lit(1)).alias("rows_deduped"),
        F.max("newest").alias("max_ts_ms"),
    )


def high_water_mark(feed: DataFrame) -> DataFrame:
    """Newest event time over all events read, deletes included."""
    return feed.agg(F.max("ts_ms").alias("last_processed_ts_ms"))


# Largest value of each integer type, narrowest first.
_INT_LIMITS = {T.ByteType: 2**7 - 1, T.ShortType: 2**15 - 1, T.IntegerType: 2**31 - 1, T.LongType: 2**63 - 1}


def _fitted(source: Column, have: T.DataType, want: T.DataType) -> Column:
    """The value in the wanted type, null where it does not fit."""
    if have == want:
        return source
    top, own = _INT_LIMITS.get(type(want)), _INT_LIMITS.get(type(have))
    if top is not None and isinstance(have, T.StringType):
        # Whole numbers only, by way of a decimal that holds them all.
        digits = F.when(source.rlike(r"^\s*[+-]?\d+\s*$"), source.try_cast("decimal(38,0)"))
        return F.when(digits.between(-top - 1, top), digits.cast(want))
    if own is not None and isinstance(want, T.DateType):
        # Change events carry dates as days since 1970.
        return F.date_from_unix_date(_fitted(source, have, T.IntegerType()))
    if top is None or own is None:
        return source.try_cast(want)
    if own <= top:
        return source.cast(want)
    # A range test keeps narrowing in generated code; `try_cast` would build
    # and drop an exception for each value that does not fit.
    return F.when(source.between(-top - 1, top), source.cast(want))


def conform(df: DataFrame, schema: T.StructType, bad_col: str = "n_bad") -> DataFrame:
    """Cast to the declared types; a value that does not fit becomes null and is counted.

    Nothing wraps round: an id of 40000 never turns into a negative SMALLINT.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out, bad = [], []
    for field in schema.fields:
        if field.name not in types:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        source = F.col(field.name)
        fitted = _fitted(source, types[field.name], field.dataType)
        out.append(fitted.alias(field.name))
        bad.append((source.isNotNull() & fitted.isNull()).cast("int"))
    total = sum(bad[1:], bad[0]) if bad else F.lit(0)
    extra = [c for c in df.columns if c not in {f.name for f in schema.fields}]
    return df.select(*out, *extra, total.alias(bad_col))


def with_declared_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Key columns in their declared types; a key that does not fit becomes a null key.

    Done before keys are checked or compared, so a misfit counts as a missing
    key and is never stored under a wrong or empty one.
    """
    declared = spec.schema()
    return conform(df, T.StructType([declared[k] for k in spec.pk]), "_bad_keys").drop("_bad_keys")


def reconcile(source: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row and key difference of two keyed tables, as counts per side.

    Each side is first cut to its keys with a count (combined before the
    shuffle), so repeated keys cannot blow up the join.
    """
    left = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_source"))
    right = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_stored"))
    side = (
        F.when(F.col("n_stored").isNull(), "only_source")
        .when(F.col("n_source").isNull(), "only_stored")
        .otherwise("both")
    )
    # A row without a whole key matches nothing and stays on its own side.
    joined = left.join(right, list(keys), "full_outer")
    return joined.groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum("n_source"), F.lit(0)).cast("long").alias("source_rows"),
        F.coalesce(F.sum("n_stored"), F.lit(0)).cast("long").alias("stored_rows"),
    )


def next_key(df: DataFrame, key: str, base: int) -> DataFrame:
    """One more than the largest key, or than `base` on an empty table."""
    return df.agg((F.coalesce(F.max(key), F.lit(base)) + 1).cast("long").alias("next_key"))


# Multiplier and modulus of the repeatable shuffle order.
MIX_MULTIPLIER = 2654435761
MIX_MODULUS = 2147483647


def mixed(key: Column) -> Column:
    """A spread-out order of an integer key that any SQL engine can repeat."""
    return F.pmod(key * F.lit(MIX_MULTIPLIER), F.lit(MIX_MODULUS))


def sample_k(df: DataFrame, key: str, k: int) -> DataFrame:
    """k rows in a repeatable pseudo-random order (a per-task top-k, then a merge)."""
    return df.orderBy(mixed(F.col(key)), F.col(key)).limit(k)
