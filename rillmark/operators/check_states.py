"""Check figures as states that add up: a report over any days without their rows.

A day's state is two tables. One has a row per key with its counts; it is
bucketed by key, so counts of many days are added up without an exchange. The
other has one row per batch and day with the figures that need no key: totals,
nulls, unknown operations, the newest time, and a sketch of the distinct keys.
A range of days is the sum of its states, and `quality.standard_checks` turns
the sum into the same report that a scan of the rows would give.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark import fixed_values as fv
from rillmark.operators import quality
from rillmark.session import use_utc
from rillmark.sinks.storage import exists, overwrite_partitions

DAY, BATCH = "state_day", "state_batch"


@dataclass(frozen=True)
class CheckStates:
    """The states of one table, in a key table and a day table."""

    spark: SparkSession
    table: str
    path: str
    keys: tuple[str, ...]
    buckets: int

    @classmethod
    def open(
        cls, spark: SparkSession, table: str, path: str, keys: dict[str, str], buckets: int | None = None
    ) -> CheckStates:
        """Creates `<table>_keys` and `<table>_days`, or attaches to them; `keys`: names and types."""
        use_utc(spark)
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        typed = ", ".join(f"`{k}` {t}" for k, t in keys.items())
        named = ", ".join(f"`{k}`" for k in keys)
        nulls = ", ".join(f"`nulls_{k}` BIGINT" for k in keys)
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table}_keys ({typed}, n BIGINT, n_stored BIGINT, {DAY} DATE, {BATCH} BIGINT) "
            f"USING parquet PARTITIONED BY ({DAY}, {BATCH}) CLUSTERED BY ({named}) SORTED BY ({named}) INTO {n} BUCKETS "
            f"LOCATION '{where}/keys'"
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table}_days (total BIGINT, bad_ops BIGINT, newest_ms BIGINT, {nulls}, "
            f"sketch BINARY, {DAY} DATE, {BATCH} BIGINT) USING parquet PARTITIONED BY ({DAY}, {BATCH}) LOCATION '{where}/days'"
        )
        for part in ("keys", "days"):
            if exists(spark, f"{path}/{part}"):
                spark.sql(f"MSCK REPAIR TABLE {table}_{part}")
        return cls(spark, table, path, tuple(keys), n)

    def add(
        self, rows: DataFrame, batch: int, ops: Sequence[str] = fv.STORED_OPS,
        op_col: str = fv.CDC_OP, ts_col: str = fv.CDC_TS,
    ) -> None:
        """Adds the states of a batch, by the UTC day of its events.

        One scan: the day figures are sums over the key counts. A batch that is
        added again takes its own place.
        """
        day = F.timestamp_millis(ts_col).cast("date").alias(DAY)
        stored = F.coalesce(F.col(op_col).isin(*ops), F.lit(False))
        known = F.col(op_col).isNotNull()
        by_key = rows.groupBy(*self.keys, day).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.when(stored, 1).otherwise(0)).alias("n_stored"),
            F.sum(F.when(known & ~stored, 1).otherwise(0)).alias("n_bad"), F.max(ts_col).alias("newest"),
        ).withColumn(BATCH, F.lit(batch).cast("long")).persist()
        whole = self._whole()
        # Days without a date are kept under the default partition.
        self._put("keys", by_key.where(whole).repartition(self.buckets, *self.keys).select(*self.keys, "n", "n_stored", DAY, BATCH))
        nulls = [F.sum(F.when(F.col(k).isNull(), F.col("n")).otherwise(0)).alias(f"nulls_{k}") for k in self.keys]
        named = F.when(whole, F.to_json(F.struct(*self.keys)))
        self._put(
            "days",
            by_key.groupBy(DAY, BATCH).agg(
                F.sum("n").alias("total"), F.sum("n_bad").alias("bad_ops"), F.max("newest").alias("newest_ms"), *nulls,
                F.hll_sketch_agg(named).alias("sketch"),
            ).select("total", "bad_ops", "newest_ms", *[f"nulls_{k}" for k in self.keys], "sketch", DAY, BATCH),
        )
        by_key.unpersist()

    def profile(self, first: str, last: str) -> DataFrame:
        """One row with the figures of `quality.batch_profile` over the days from `first` to `last`, and `about_keys`."""
        days = self._within("days", first, last).agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "bad_ops", *[f"nulls_{k}" for k in self.keys])],
            F.max("newest_ms").alias("newest_ms"), F.max("newest_ms").alias("feed_newest_ms"),
            F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch", True)), F.lit(0)).alias("about_keys"),
        )
        counts = self.key_counts(first, last).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("keyed_rows"), F.count(F.lit(1)).alias("keys"),
            F.count(F.when(F.col("n") == 1, 1)).alias("single_keys"),
            F.count(F.when(F.col("n_stored") > 0, 1)).alias("storable_keys"),
        )
        return days.join(counts)  # one row each

    def key_counts(self, first: str, last: str) -> DataFrame:
        """Counts per key over some days; buckets are added up where they lie."""
        return self._within("keys", first, last).groupBy(*self.keys).agg(
            F.sum("n").alias("n"), F.sum("n_stored").alias("n_stored")
        )

    def report(self, first: str, last: str, as_of_ms: int, limit_s: int = fv.FRESHNESS_LIMIT_S) -> DataFrame:
        """`quality.dq_report` over the events of some days."""
        return quality.graded(quality.standard_checks(self.profile(first, last), self.keys, as_of_ms, limit_s))

    def _within(self, part: str, first: str, last: str) -> DataFrame:
        return self.spark.table(f"{self.table}_{part}").where(F.col(DAY).between(F.lit(first).cast("date"), F.lit(last).cast("date")))

    def _whole(self) -> Column:
        whole = F.lit(True)
        for k in self.keys:
            whole = whole & F.col(k).isNotNull()
        return whole

    def _put(self, part: str, rows: DataFrame) -> None:
        overwrite_partitions(rows, f"{self.table}_{part}")
        self.spark.catalog.refreshTable(f"{self.table}_{part}")
