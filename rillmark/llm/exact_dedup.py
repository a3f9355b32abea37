"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 of the text. A batch is
grouped to one row per digest (combined before the shuffle, so a text that fills
a third of the batch sends one row per task), anti-joined with the index by
sort-merge, and what is new is appended. The index side of that join is read
bucket by bucket and never shuffled.

Defined cases: a null text counts as empty; a row without id is the last choice
in its group; rows repeated with one id and one text share their decision; an
empty batch adds nothing. Running a batch again under its own name changes
nothing, so a run that died half way can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.common import saved, shuffle_width

ENTRY = "digest BINARY, keep_id BIGINT, batch STRING"


@dataclass(frozen=True)
class DigestIndex:
    """One row per text ever kept: digest, id of the kept row, batch that brought it."""

    spark: SparkSession
    table: str
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, table: str, path: str, buckets: int | None = None) -> DigestIndex:
        """Creates the table over `path`, or attaches to the files that are there."""
        n = buckets or shuffle_width(spark)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({ENTRY}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {n} BUCKETS LOCATION '{path}'"
        )
        return cls(spark, table, path, n)

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        (
            fresh.repartition(self.buckets, "digest")
            .write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest")
            .option("path", self.path).saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)


def dedup(
    docs: DataFrame, index: DigestIndex, batch: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Decides every row of a batch and appends its new texts to the index.

    Of equal texts in the batch the row with the largest id is the candidate; it
    is kept unless an earlier batch has the text. Returns one row per input row:
    id, keep_id, group_size (rows of the batch with this text), kept, text_sha256.
    """
    # Columns get fixed names first, so none of the caller's can clash.
    digests = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias("digest"),
    )
    groups = saved(
        digests.groupBy("digest").agg(F.max("id").alias("newest"), F.count(F.lit(1)).alias("copies")),
        "digest-groups",
    )
    fresh = groups.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")
    index.append(fresh.select("digest", F.col("newest").alias("keep_id"), F.lit(batch).alias("batch")))
    # Written before the last join: both its sides are then plain shuffles, which AQE splits at a hot digest.
    verdicts = saved(
        groups.join(index.entries().hint("merge"), "digest").select(
            "digest", "keep_id", "copies", (F.col("batch") == batch).alias("here")
        ),
        "digest-verdicts",
    )
    return digests.join(verdicts, "digest").select(
        F.col("id").alias(id_col),
        "keep_id",
        F.col("copies").alias("group_size"),
        (F.col("here") & F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
