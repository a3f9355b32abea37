"""Severity of a failed check, by scope and at delivery."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillmark import fixed_values as fv


def _level(label: str, severity: str) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(label).alias("sev_label"))


def scoped_severity(error_type: Column, violations: Column, total: Column) -> Column:
    """struct(severity, sev_label) from the share of rows that failed.

    Without rows the share counts as one.
    """
    share = F.when(total > 0, violations.cast("double") / total).otherwise(F.lit(1.0))
    critical, error = _level("SEV-1", "critical"), _level("SEV-2", "error")
    warning = _level("SEV-3", "warning")
    key_error = error_type.isin("null_pk", "duplicate_pk")
    return (
        F.when(key_error & (share >= fv.PK_CRITICAL_RATIO), critical)
        .when((error_type == "invalid_cdc_op") & (share < fv.OP_WARNING_RATIO), warning)
        .when(error_type == "stale_data", warning)
        .otherwise(error)
    )


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    literal_map = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    return F.try_element_at(literal_map, key)


def delivery_severity(
    error_type: Column,
    table: dict[str, tuple[str, str]] = fv.DELIVERY_SEVERITY_EXTENDED,
    default: tuple[str, str] = fv.DEFAULT_SEVERITY,
) -> Column:
    """struct(severity, sev_label) that an event is delivered with.

    The table is a fixed handful of entries, so it is a literal map in the
    projection: no join, no shuffle, no broadcast.
    """
    labels = {k: v[0] for k, v in table.items()}
    levels = {k: v[1] for k, v in table.items()}
    return F.struct(
        F.coalesce(_lookup(levels, error_type), F.lit(default[1])).alias("severity"),
        F.coalesce(_lookup(labels, error_type), F.lit(default[0])).alias("sev_label"),
    )


def display_label(error_type: Column) -> Column:
    """Label shown in a receipt log; `SEV-?` for unknown types."""
    labels = {k: v[0] for k, v in fv.DELIVERY_SEVERITY_EXTENDED.items()}
    return F.coalesce(_lookup(labels, error_type), F.lit(fv.UNKNOWN_SEV_LABEL))


def title_error_type(title: Column) -> Column:
    """Error type of a rule title, null when unknown."""
    return _lookup(fv.TITLE_TO_ERROR_TYPE, title)


def routing_key(topic: Column, keys: dict[str, str], base: str = "") -> Column:
    """Key of the topic, else the base key, else null (dry run)."""
    set_keys = {t: k for t, k in keys.items() if k}
    fallback = F.lit(base or None).cast("string")
    return F.coalesce(_lookup(set_keys, topic), fallback) if set_keys else fallback
