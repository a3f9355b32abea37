"""Source constraints as checks: NOT NULL, length, primary and foreign keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.operators.quality import batch_profile
from rillmark.spec import ForeignKey, TableSpec


def _melt_counts(df: DataFrame, flags: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """Counts many row conditions in one aggregate, then one row per condition."""
    sums = [
        F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).cast("long").alias(f"f{i}")
        for i, (_, _, bad) in enumerate(flags)
    ]
    one = df.agg(F.count(F.lit(1)).alias("total_rows"), *sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("constraint"),
                F.lit(col).alias("column_name"),
                F.col(f"f{i}").alias("violation_rows"),
            )
            for i, (kind, col, _) in enumerate(flags)
        ]
    )
    return one.select("total_rows", F.explode(rows).alias("r")).select(
        "r.constraint", "r.column_name", "r.violation_rows", "total_rows"
    )


def column_constraints(df: DataFrame, schema: T.StructType) -> DataFrame:
    """NOT NULL and VARCHAR(n) of a schema, all columns in one pass."""
    flags = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        if not f.nullable:
            flags.append(("not_null", f.name, F.col(f.name).isNull()))
        if isinstance(f.dataType, (T.VarcharType, T.CharType)):
            too_long = F.length(F.col(f.name)) > f.dataType.length
            flags.append(("max_length", f.name, too_long))
    return _melt_counts(df, flags)


def length_compliance(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows over a length limit, per column; null passes."""
    flags = [("max_length", c, F.length(F.col(c)) > n) for c, n in limits.items()]
    return _melt_counts(df, flags)


def primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null in the key and rows of keys that occur more than once."""
    return batch_profile(df, keys, None, None).select(
        F.col("total").alias("total_rows"),
        (F.col("total") - F.col("keyed_rows")).alias("null_key_rows"),
        (F.col("keyed_rows") - F.col("single_keys")).alias("repeated_key_rows"),
    )


def orphan_keys(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Foreign-key values without a parent, with the rows that use them.

    The child is cut to (value, count) before the join: a value that fills a
    third of the child is one row there, and the join never meets skew.
    """
    used = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("fk_value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_column).alias("fk_value"))
    return used.join(known, "fk_value", "left_anti")


def foreign_key_report(
    tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]
) -> DataFrame:
    """Rows and values without a parent, one row per foreign key."""
    reports = []
    for fk in keys:
        lost = orphan_keys(tables[fk.child], fk.column, tables[fk.parent], fk.parent_column)
        reports.append(
            lost.agg(
                F.count(F.lit(1)).alias("orphan_values"),
                F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("orphan_rows"),
            ).select(
                F.lit(fk.child).alias("child"),
                F.lit(fk.column).alias("fk_column"),
                F.lit(fk.parent).alias("parent"),
                "orphan_values",
                "orphan_rows",
            )
        )
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def table_constraints(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A source table's column and key constraints as one report."""
    columns = column_constraints(df, spec.schema())
    pk = primary_key(df, spec.pk)
    name = "+".join(spec.pk)
    keys = pk.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit("key_not_null").alias("constraint"),
                    F.col("null_key_rows").alias("violation_rows"),
                ),
                F.struct(
                    F.lit("key_unique").alias("constraint"),
                    F.col("repeated_key_rows").alias("violation_rows"),
                ),
            )
        ).alias("r"),
        "total_rows",
    ).select("r.constraint", F.lit(name).alias("column_name"), "r.violation_rows", "total_rows")
    return columns.unionByName(keys).withColumn("table", F.lit(spec.name))
