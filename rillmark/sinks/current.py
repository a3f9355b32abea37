"""Current state kept up to date: a keyed table that batches are merged into.

The table is bucketed and sorted by key and partitioned by shard, a hash of the
key. A batch is cut to its newest event per key and joined with the shards that
it touches, by sort-merge, bucket by bucket: the table's side is read in place
and never exchanged, and only touched shards are written again. Deletes stay as
rows without values, so an older event that comes late does not bring a row
back; `sweep` forgets those older than any event that can still come.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark import fixed_values as fv
from rillmark.operators import changes
from rillmark.sinks.storage import exists, overwrite_partitions, remove
from rillmark.spec import TableSpec

SHARD = "shard"


@dataclass(frozen=True)
class CurrentTable:
    """The newest event of every key, deletes among them."""

    spark: SparkSession
    table: str
    path: str
    spec: TableSpec
    ties: tuple[str, ...]
    buckets: int
    shards: int

    @classmethod
    def open(
        cls, spark: SparkSession, table: str, path: str, spec: TableSpec, ties: Sequence[str] = ("seq",),
        buckets: int | None = None, shards: int = 16,
    ) -> CurrentTable:
        """Creates the table, or attaches to the one that is there with its buckets and shards.

        Buckets are the tasks of a merge; shards bound what a small batch
        writes again. Both are kept for the life of the table.
        """
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(spec, ties).fields)
        keys = ", ".join(f"`{k}`" for k in spec.pk)
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {SHARD} INT) USING parquet "
            f"PARTITIONED BY ({SHARD}) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n} BUCKETS "
            f"LOCATION '{where}' TBLPROPERTIES ('shards' = '{shards}')"
        )
        if exists(spark, path):
            # Files may be there from an earlier session whose catalog is gone.
            spark.sql(f"MSCK REPAIR TABLE {table}")
        told = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
        made = next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r["col_name"] == "Num Buckets")
        return cls(spark, table, path, spec, tuple(ties), int(made), int(told["shards"]))

    def rows(self) -> DataFrame:
        """All keys, those deleted with only their key."""
        return self.spark.table(self.table)

    def live(self) -> DataFrame:
        """The live row of every key."""
        return self.rows().where(F.col(self.spec.op_col) != fv.OP_DELETE).drop(SHARD)

    def merge(self, events: DataFrame) -> list[int]:
        """Takes a batch of rows (`ingest.stream_rows` or bronze) in; returns the shards written.

        Merging a batch again changes nothing, so a merge that died half way is
        repeated whole.
        """
        names = _schema(self.spec, self.ties).fieldNames()
        whole, _ = changes.split_null_keys(events.select(*names), self.spec.pk)
        newest = changes.latest_per_key(whole, self.spec.pk, changes.newest_first(self.spec.ts_col, self.ties))
        sharded = newest.withColumn(SHARD, self._shard()).persist()
        # At most as many values as there are shards.
        touched = sorted(r[SHARD] for r in sharded.select(SHARD).distinct().collect())
        if touched:
            self._write(self.merged(sharded, touched))
        sharded.unpersist()
        return touched

    def merged(self, newest: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The touched shards with the newest events in their place."""
        base, batch = self.rows().where(F.col(SHARD).isin(*touched)).alias("b"), newest.hint("merge").alias("n")
        same = F.col(f"b.{self.spec.pk[0]}") == F.col(f"n.{self.spec.pk[0]}")
        for k in self.spec.pk[1:]:
            same = same & (F.col(f"b.{k}") == F.col(f"n.{k}"))
        order = (self.spec.ts_col, *self.ties)
        newer = F.col(f"b.{self.spec.pk[0]}").isNull() | (
            F.struct(*[F.col(f"n.{c}").alias(c) for c in order]) > F.struct(*[F.col(f"b.{c}").alias(c) for c in order])
        )
        chosen = F.col(f"n.{self.spec.pk[0]}").isNotNull() & newer
        return base.join(batch, same, "full_outer").select(
            *[F.when(chosen, F.col(f"n.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in newest.columns]
        )

    def sweep(self, before_ms: int) -> int:
        """Forgets deletes from before a time; returns how many. Only shards that hold some are written."""
        gone = (F.col(self.spec.op_col) == fv.OP_DELETE) & (F.col(self.spec.ts_col) < before_ms)
        found = {r[SHARD]: r["count"] for r in self.rows().where(gone).groupBy(SHARD).count().collect()}
        if not found:
            return 0
        left = self.rows().where(F.col(SHARD).isin(*found) & ~F.coalesce(gone, F.lit(False)))
        empty = set(found) - {r[SHARD] for r in left.select(SHARD).distinct().collect()}
        self._write(left)
        for shard in sorted(empty):
            # Nothing is left to write there, so the overwrite does not reach it.
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({SHARD} = {shard})")
            remove(self.spark, f"{self.path}/{SHARD}={shard}")
        return sum(found.values())

    def _shard(self):
        return F.pmod(F.xxhash64(*self.spec.pk), F.lit(self.shards)).cast("int")

    def _write(self, rows: DataFrame) -> None:
        # Rows come bucket by bucket, so a task writes one file for each of its shards.
        names = [*_schema(self.spec, self.ties).fieldNames(), SHARD]
        overwrite_partitions(rows.select(*names), self.table)
        self.spark.catalog.refreshTable(self.table)


def _schema(spec: TableSpec, ties: Sequence[str]) -> T.StructType:
    stored = spec.stored_schema()
    return T.StructType(stored.fields + [T.StructField(c, T.LongType()) for c in ties if c not in stored.fieldNames()])
