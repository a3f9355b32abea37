"""Reconciling two tables by value through a two-level tree of checksums.

Keys are hashed to leaves and leaves to branches. A leaf's checksum is a sum
over its rows, so it does not hang on their order and is combined before the
shuffle: each side sends one row per leaf. Branches are compared first, then
the leaves of branches that differ, and only rows in leaves that differ are
compared by key and value. Two tables that are alike exchange their leaves and
no row.

A checksum is the count of rows and two sums of 64-bit hashes with different
seeds; tables that differ are taken for alike only where all three agree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves by default; a leaf of a billion rows then holds about 15,000.
LEAVES, BRANCHES = 65_536, 256
SUMS = ("n", "sum_a", "sum_b")
#: Differing leaves that a scan is filtered by; more are joined.
LISTED = 1_000
#: Rows of both sides that a task compares. Left to itself AQE sizes tasks by compressed bytes, many times less than their rows in memory.
TASK_ROWS = 100_000


@dataclass(frozen=True)
class ValueTree:
    """Checksums of one table: `branch`, `leaf`, `n`, `sum_a`, `sum_b`."""

    leaves: DataFrame

    def branches(self) -> DataFrame:
        return self.leaves.groupBy("branch").agg(*[F.sum(c).alias(c) for c in SUMS])


def leaf_of(keys: Sequence[str], leaves: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(leaves)).cast("int")


def _value(columns: Sequence[str]) -> list[Column]:
    """Columns with nulls told apart from any value and from each other's places."""
    return [c for name in columns for c in (F.col(name), F.col(name).isNull())]


def tree(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int = LEAVES, branches: int = BRANCHES) -> ValueTree:
    """Sums over keys and columns, whose types must be the same on both sides."""
    names = [*keys, *columns]
    # Decimal sums: they neither overflow nor depend on the order.
    hashes = [F.xxhash64(F.lit(seed), *_value(names)).cast("decimal(38,0)") for seed in (1, 2)]
    leaf = leaf_of(keys, leaves)
    found = rows.groupBy(leaf.alias("leaf")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(hashes[0]).alias("sum_a"), F.sum(hashes[1]).alias("sum_b")
    )
    return ValueTree(found.withColumn("branch", F.col("leaf") % F.lit(branches)))


def _differ(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """Places whose sums are not the same on both sides, or on one side only, and their rows on both."""
    named = right.select(F.col(by).alias("_by"), *[F.col(c).alias(f"_{c}") for c in SUMS])
    same = F.lit(True)
    for c in SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(named, F.col(by) == F.col("_by"), "full_outer").where(~same).select(
        F.coalesce(by, "_by").alias(by), (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("rows")
    )


def differing_leaves(left: ValueTree, right: ValueTree) -> DataFrame:
    """Leaves that differ: branches first, then the leaves of those that do."""
    branches = _differ(left.branches(), right.branches(), "branch").select(F.col("branch").alias("_branch"))
    under = F.col("branch") == F.col("_branch")
    return _differ(
        left.leaves.join(branches, under, "left_semi"), right.leaves.join(branches, under, "left_semi"), "leaf"
    )


def reconcile_values(
    source: DataFrame, stored: DataFrame, keys: Sequence[str], columns: Sequence[str],
    leaves: int = LEAVES, branches: int = BRANCHES,
) -> DataFrame:
    """keys, difference: `only_source`, `only_stored` or `value`, for each key that is not the same on both sides.

    A key that occurs several times is the same if its rows are, however often
    each occurs on either side being counted. Null keys are keys.
    """
    lost = differing_leaves(tree(source, keys, columns, leaves, branches), tree(stored, keys, columns, leaves, branches)).persist()
    found = lost.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).first()
    tasks = -(-(found["rows"] or 1) // TASK_ROWS)
    if found["n"] <= LISTED:
        # Bounded: at most LISTED numbers, so the scan of each side drops all other rows.
        listed = [r["leaf"] for r in lost.collect()]
        within = lambda df: df.where(leaf_of(keys, leaves).isin(listed))
    else:
        within = lambda df: df.withColumn("_leaf", leaf_of(keys, leaves)).join(
            lost.select(F.col("leaf").alias("_leaf")), "_leaf", "left_semi"
        ).drop("_leaf")
    lost.unpersist()

    def of(df: DataFrame, side: str) -> DataFrame:
        counts = [F.lit(int(s == side)).cast("long").alias(s) for s in ("n_source", "n_stored")]
        return within(df).select(*keys, *columns, *counts)

    sums = [F.sum("n_source").alias("n_source"), F.sum("n_stored").alias("n_stored")]
    both = of(source, "n_source").unionByName(of(stored, "n_stored")).withColumn("_from", F.spark_partition_id())
    # Rows alike are one row with their number, before keys are brought together; those of each task that read them meet
    # apart, so a row that fills a side is spread.
    alike = both.repartition(tasks, *keys, *columns, "_from").groupBy(*keys, *columns, "_from").agg(*sums)
    values = alike.drop("_from").repartition(tasks, *keys).groupBy(*keys, *columns).agg(*sums)
    return values.groupBy(*keys).agg(
        F.sum("n_source").alias("source"), F.sum("n_stored").alias("stored"),
        F.max((F.col("n_source") != F.col("n_stored")).cast("int")).alias("differs"),
    ).where("differs = 1").select(
        *keys,
        F.when(F.col("stored") == 0, "only_source").when(F.col("source") == 0, "only_stored").otherwise("value").alias("difference"),
    )
