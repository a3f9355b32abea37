"""Ordered work along time that no single task has to do for a whole key.

Windows over a key put all its rows in one task. Here a key's rows are cut into
time chunks, the window runs inside each chunk, and only a bounded summary per
chunk (at most two rows) is carried along the key. The results are exact.

Rows per chunk are bounded where the input has one row per key and
millisecond, which `one_per_ms` provides; keys must not be null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.functions.times import floor_to

CHUNK_MS = 900_000


HOUR_MS = 3_600_000


def fitting_chunk(
    df: DataFrame, keys: Sequence[str], ts: str, rows_per_chunk: int = 1_000_000,
    least_ms: int = 1, most_ms: int = 30 * 86_400_000,
) -> int:
    """A chunk width at which no key has many more than `rows_per_chunk` rows per chunk.

    For feeds that may hold many rows per key and millisecond. If every key is
    small a chunk may be as long as `most_ms`; else the busiest hour of any key
    decides. One or two aggregates, combined before the shuffle; one row of each
    comes to the driver.
    """
    count = F.count(F.lit(1)).alias("n")
    largest = df.groupBy(*keys).agg(count).agg(F.max("n")).first()[0]
    if not largest or largest <= rows_per_chunk:
        return most_ms
    hour = floor_to(F.col(ts), HOUR_MS).alias("_hour")
    busiest = df.groupBy(*keys, hour).agg(count).agg(F.max("n")).first()[0]
    return int(min(max(HOUR_MS * rows_per_chunk / busiest, least_ms), most_ms))


def one_per_ms(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, seq: str | None = None
) -> DataFrame:
    """The last value per key and millisecond (the largest where no order is given)."""
    pick = F.max(value) if seq is None else F.max_by(value, seq)
    return df.groupBy(*keys, ts).agg(pick.alias(value))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    amount: Column,
    out: str,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """(keys, ts, out): the sum of `amount` over a key up to and including each time.

    Amounts are first added up per key and millisecond; rows and chunk sums
    both read that shuffle. What earlier chunks add up to enters a chunk as one
    more row at its start, so nothing is joined.
    """
    steps = (
        df.groupBy(*keys, ts)
        .agg(F.sum(amount).alias("_step"))
        .withColumn("_chunk", floor_to(F.col(ts), chunk_ms))
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = (
        steps.groupBy(*keys, "_chunk")
        .agg(F.sum("_step").alias("_sum"))
        .select(
            *keys,
            F.lit(None).cast("long").alias(ts),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_step"),
            "_chunk",
        )
    )
    # The carried row has no time of its own and sorts first.
    inside = Window.partitionBy(*keys, "_chunk").orderBy(F.col(ts).asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        steps.unionByName(carried)
        .withColumn(out, F.sum("_step").over(inside))
        .where(F.col(ts).isNotNull())
        .select(*keys, ts, out)
    )


def islands(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    flag: str,
    max_gap_ms: int | None = None,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Maximal runs of rows with one `flag` value per key: (keys, flag, start_ms, end_ms, samples).

    `max_gap_ms` also ends a run where two rows are further apart. Runs inside
    a chunk are final; only a chunk's first and last run can go on in a
    neighbour, so only those are brought together per key.
    """
    far = F.lit(False)
    chunked = df.withColumn("_chunk", floor_to(F.col(ts), chunk_ms))
    w = Window.partitionBy(*keys, "_chunk").orderBy(ts)
    if max_gap_ms is not None:
        far = F.col(ts) - F.lag(ts).over(w) > max_gap_ms
    turned = F.coalesce(F.col(flag) != F.lag(flag).over(w), F.lit(False)) | F.coalesce(
        far, F.lit(False)
    )
    runs = (
        chunked.withColumn("_turn", turned.cast("int"))
        .withColumn(
            "_run", F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_chunk", "_run")
        .agg(
            F.first(flag).alias(flag),
            F.min(ts).alias("start_ms"),
            F.max(ts).alias("end_ms"),
            F.count(F.lit(1)).alias("samples"),
        )
        .withColumn("_last", F.max("_run").over(Window.partitionBy(*keys, "_chunk")))
    )
    # Inner runs keep their chunk as group, outer runs of a key share one.
    outer = (F.col("_run") == 0) | (F.col("_run") == F.col("_last"))
    grouped = runs.withColumn("_group", F.when(outer, F.lit(None).cast("long")).otherwise(F.col("_chunk")))
    order = Window.partitionBy(*keys, "_group").orderBy("start_ms")
    joins = (
        F.col("_group").isNull()
        & (F.col("_run") == 0)
        & (F.col(flag) == F.lag(flag).over(order))
    )
    if max_gap_ms is not None:
        joins = joins & (F.col("start_ms") - F.lag("end_ms").over(order) <= max_gap_ms)
    return (
        grouped.withColumn("_new", (~F.coalesce(joins, F.lit(False))).cast("int"))
        .withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_group", "_island")
        .agg(
            F.first(flag).alias(flag),
            F.min("start_ms").alias("start_ms"),
            F.max("end_ms").alias("end_ms"),
            F.sum("samples").cast("long").alias("samples"),
        )
        .select(*keys, flag, "start_ms", "end_ms", "samples")
    )


def with_halo(df: DataFrame, ts: str, reach_ms: int, chunk_ms: int) -> DataFrame:
    """Adds `_chunk`, repeating the last `reach_ms` of each chunk in the next one.

    A window that looks back no further than `reach_ms` is then exact inside a
    chunk; rows with `_halo` true are only there to be looked at.
    """
    if chunk_ms < reach_ms:
        raise ValueError("a chunk must be at least as long as the reach")
    own = floor_to(F.col(ts), chunk_ms)
    near_end = F.col(ts) >= own + (chunk_ms - reach_ms)
    places = F.when(near_end, F.array(own, own + chunk_ms)).otherwise(F.array(own))
    return (
        df.withColumn("_own", own)
        .withColumn("_chunk", F.explode(places))
        .withColumn("_halo", F.col("_chunk") != F.col("_own"))
        .drop("_own")
    )


def events_since_last(
    df: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[str], hit: Column, reset: Column,
    out: str, chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Adds `out`: hits since the last reset of the key, the row itself included.

    A chunk is summed up by its hits since its last reset and whether it had
    one. What a key brings along from earlier chunks enters a chunk as one more
    row at its start that stands for that many hits.
    """
    cut = df.withColumns(
        {"_chunk": floor_to(F.col(ts), chunk_ms), "_hit": hit.cast("long"), "_reset": reset.cast("long")}
    )

    def counted(rows: DataFrame) -> DataFrame:
        order = [F.col(c).asc_nulls_first() for c in (ts, *ties)]
        w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        at_reset = F.max(F.when(F.col("_reset") == 1, F.col("_hits"))).over(w)
        return rows.withColumn("_hits", F.sum("_hit").over(w)).withColumn(
            "_count", F.col("_hits") - F.coalesce(at_reset, F.lit(0))
        )

    tails = counted(cut.select(*keys, ts, *ties, "_chunk", "_hit", "_reset")).groupBy(*keys, "_chunk").agg(
        F.max_by("_count", F.struct(ts, *ties)).alias("_tail"),
        (F.max("_reset") == 1).alias("_had_reset"),
    )
    along = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # Chunks without a reset add up on top of the tail of the last one that had one.
    grown = tails.withColumn(
        "_total", F.sum(F.when(~F.col("_had_reset"), F.col("_tail")).otherwise(0)).over(along)
    ).withColumn("_anchor", F.when(F.col("_had_reset"), F.col("_tail") - F.col("_total")))
    brought = F.coalesce(F.last("_total", ignorenulls=True).over(before), F.lit(0)) + F.coalesce(
        F.last("_anchor", ignorenulls=True).over(before), F.lit(0)
    )
    carried = grown.select(*keys, "_chunk", brought.alias("_hit"), F.lit(0).cast("long").alias("_reset"))
    return (
        counted(cut.unionByName(carried, allowMissingColumns=True))
        .where(F.col(ts).isNotNull())
        .select(*df.columns, F.col("_count").alias(out))
    )
