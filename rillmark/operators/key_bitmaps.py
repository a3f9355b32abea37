"""Foreign keys of new rows against an exact bitmap index of the parent's keys.

The index holds a bit for every integer: one row for 32,768 consecutive numbers
in which a key lies. A batch of parents is turned into bitmaps (combined before
the shuffle) and stored under its own number; a batch of children is cut to its
distinct values with counts and looks its bits up, so neither the parent nor
earlier children are read again. Keys that arrive in one batch with the rows
that point to them are known to them: parents are added first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.sinks.bronze import replace_partitions, written_before
from rillmark.spec import ForeignKey

INDEX = "parent string, key_column string, bucket long, bits binary, batch long"
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class KeyBitmaps:
    """The bitmaps of any number of parent keys, below one path."""

    spark: SparkSession
    path: str

    def add(self, rows: DataFrame, parent: str, column: str, batch: int) -> None:
        """Adds a batch's keys; a batch added again takes its own place."""
        if not isinstance(rows.schema[column].dataType, WHOLE):
            raise TypeError(f"{parent}.{column} is no integer; use integrity.orphan_keys")
        key = F.col(column).cast("long")
        bits = rows.where(F.col(column).isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits")
        )
        named = bits.select(
            F.lit(parent).alias("parent"), F.lit(column).alias("key_column"), "bucket", "bits",
            F.lit(batch).cast("long").alias("batch"),
        )
        replace_partitions(named, self.path, ("parent", "key_column", "batch"))

    def known(self, parent: str, column: str, up_to: int | None = None) -> DataFrame:
        """bucket, bits: all keys of a parent, or those of batches up to a number."""
        rows = written_before(self.spark, self.path, T.StructType.fromDDL(INDEX))
        if rows is None:
            return self.spark.createDataFrame([], "bucket long, bits binary")
        mine = rows.where((F.col("parent") == parent) & (F.col("key_column") == column))
        if up_to is not None:
            mine = mine.where(F.col("batch") <= up_to)
        return mine.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))

    def orphans(self, child: DataFrame, column: str, parent: str, parent_column: str, up_to: int | None = None) -> DataFrame:
        """fk_value, rows: values of a batch of children that no parent has."""
        used = child.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("long").alias("fk_value")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        asked = used.withColumns({
            "_bucket": F.bitmap_bucket_number("fk_value"), "_at": F.bitmap_bit_position("fk_value"),
        })
        bits = self.known(parent, parent_column, up_to)
        # The byte that holds the bit, as a number, then the bit in it.
        byte = F.conv(F.hex(F.substring("bits", F.shiftright("_at", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        held = F.coalesce(F.expr("shiftright(_byte, cast(_at % 8 as int)) & 1") == 1, F.lit(False))
        met = asked.join(bits, F.col("_bucket") == F.col("bucket"), "left").withColumn("_byte", byte)
        return met.where(~held).select("fk_value", "rows")

    def check_batch(
        self, tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey], batch: int
    ) -> DataFrame:
        """One row per foreign key of the batch's tables: orphan_values and orphan_rows among its new rows.

        Parents of the batch are added first, so rows of one batch may point to
        each other, a table to itself among them.
        """
        for parent, column in sorted({(fk.parent, fk.parent_column) for fk in keys if fk.parent in tables}):
            self.add(tables[parent], parent, column, batch)
        out = None
        for fk in (k for k in keys if k.child in tables):
            lost = self.orphans(tables[fk.child], fk.column, fk.parent, fk.parent_column, batch)
            row = lost.agg(
                F.count(F.lit(1)).alias("orphan_values"), F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows")
            ).select(
                F.lit(fk.child).alias("child"), F.lit(fk.column).alias("fk_column"), F.lit(fk.parent).alias("parent"),
                "orphan_values", "orphan_rows",
            )
            out = row if out is None else out.unionByName(row)
        if out is None:
            raise ValueError("no foreign key has its child in the batch")
        return out
