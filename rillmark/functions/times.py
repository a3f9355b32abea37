"""Epoch-millisecond and calendar expressions (UTC)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillmark import fixed_values as fv


def epoch_ms(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp, floored. Accepts TIMESTAMP_NTZ as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def utc_date_parts(ms: Column) -> dict[str, Column]:
    """year/month/day INT columns of an epoch-ms column."""
    ts = F.timestamp_millis(ms)
    return {"year": F.year(ts), "month": F.month(ts), "day": F.day(ts)}


def run_date_parts(run_ms: int) -> dict[str, Column]:
    """year/month/day INT literals of a run's start time."""
    day = datetime.fromtimestamp(run_ms / 1000, tz=timezone.utc)
    return {p: F.lit(getattr(day, p)).cast("int") for p in fv.DATE_PARTITIONS}


def iso_utc(ms: Column) -> Column:
    """ISO-8601 text with an explicit UTC offset."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'")


def floor_to(ms: Column, width_ms: int) -> Column:
    """Start of the width-sized cell that holds `ms` (also right below zero)."""
    return ms - F.pmod(ms, F.lit(width_ms))


def ceil_to(ms: Column, width_ms: int) -> Column:
    """First multiple of the width that is not before `ms`."""
    return ms + F.pmod(-ms, F.lit(width_ms))
