"""Text expressions of alert messages and keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillmark import fixed_values as fv


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def dedup_key(table: Column, error_type: Column, suffix: Column | None = None) -> Column:
    """`cdc-<table>-<type>[-<suffix>]`; an empty or null suffix adds nothing."""
    tail = [] if suffix is None else [blank_to_null(suffix)]
    return F.concat_ws("-", F.lit("cdc"), table, error_type, *tail)


def message_key(scope: Column, error_type: Column) -> Column:
    """Key of an alert message: `<table or infra>:<type>`."""
    return F.concat_ws(":", scope, error_type)


def route_topic(
    topic: Column,
    pattern: str = fv.TOPIC_ROUTE_REGEX,
    replacement: str = fv.TOPIC_ROUTE_REPLACEMENT,
) -> Column:
    """Renames a topic when the pattern matches all of it, else leaves it."""
    whole = f"^(?:{pattern})$"
    return F.when(topic.rlike(whole), F.regexp_replace(topic, whole, replacement)).otherwise(topic)


def percent_text(part: Column, total: Column) -> Column:
    """`12.34%`, or `N/A` without rows; exact halves go to the even digit.

    Worked out in whole hundredths of a percent, so no binary fraction decides
    the last digit.
    """
    total = total.cast("long")
    scaled = part.cast("long") * 10000
    rest = F.pmod(scaled, total)
    lower = F.round((scaled - rest) / total).cast("long")
    up = (rest * 2 > total) | ((rest * 2 == total) & (lower % 2 == 1))
    hundredths = lower + up.cast("long")
    shown = F.format_string("%d.%02d%%", F.floor(hundredths / 100), F.pmod(hundredths, F.lit(100)))
    return F.when(total > 0, shown).otherwise("N/A")


def constraint_name(constraint: Column) -> Column:
    """First word in brackets of a constraint's text, or the text itself."""
    inner = F.regexp_extract(constraint, r"\((\w+)", 1)
    return F.coalesce(blank_to_null(inner), constraint, F.lit("unknown"))


def violations_from_message(message: Column, total: Column) -> Column:
    """Rows behind a `Value: <passing fraction>` message; at least one.

    Kept for messages that come from elsewhere: our checks count exactly. The
    number may carry an exponent. A text without a number counts all rows.
    """
    number = F.regexp_extract(message, r"Value:\s*(\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)", 1)
    fraction = blank_to_null(number).cast("double")
    rows = F.greatest(F.lit(1), F.bround((1 - fraction) * total).cast("long"))
    return F.when(fraction.isNotNull(), rows).otherwise(total.cast("long"))


def failed_constraint_message(constraint: Column, message: Column) -> Column:
    """One `name: text` piece of a failed constraint."""
    text = F.when(
        message.contains("Empty state for analyzer"), fv.NOT_EVALUATED
    ).otherwise(F.coalesce(blank_to_null(message), F.lit(fv.NO_DETAIL)))
    return F.concat(constraint_name(constraint), F.lit(": "), text)


def _four_digits(x: Column) -> Column:
    """Four significant digits for 1 <= |x| < 1000, trailing zeros dropped."""
    size = F.abs(x)
    shown = (
        F.when(size < 9.9995, F.format_string("%.3f", x))
        .when(size < 99.995, F.format_string("%.2f", x))
        .when(size < 999.95, F.format_string("%.1f", x))
        .otherwise(F.format_string("%.0f", x))
    )
    return _trimmed(shown)


def _trimmed(shown: Column) -> Column:
    """Without trailing zeros of the fraction."""
    return F.regexp_replace(F.regexp_replace(shown, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _small(x: Column, unit: str) -> Column:
    """Values below one, with the m/u/n prefixes."""
    size = F.abs(x)
    return (
        F.when(size >= 1e-3, F.concat(_four_digits(x * 1e3), F.lit("m" + unit)))
        .when(size >= 1e-6, F.concat(_four_digits(x * 1e6), F.lit("u" + unit)))
        .otherwise(F.concat(_four_digits(x * 1e9), F.lit("n" + unit)))
    )


def humanize(x: Column, largest: str | None = None) -> Column:
    """Number with a metric prefix: 1234567 -> 1.235M.

    With a `largest` prefix, larger numbers keep it and one decimal: 1234.6k.
    """
    size = F.abs(x)
    # Metric prefixes.
    steps = ((1e12, "T"), (1e9, "G"), (1e6, "M"), (1e3, "k"), (1.0, ""))
    shown = F.when(x == 0, F.lit("0"))
    if largest is not None:
        steps = steps[[prefix for _, prefix in steps].index(largest):]
        scale = steps[0][0]
        beyond = F.concat(_trimmed(F.format_string("%.1f", x / scale)), F.lit(largest))
        shown = shown.when(size >= 1000 * scale, beyond)
    for scale, prefix in steps:
        shown = shown.when(size >= scale, F.concat(_four_digits(x / scale), F.lit(prefix)))
    return F.when(x.isNotNull(), shown.otherwise(_small(x, "")))


def humanize_duration(seconds: Column) -> Column:
    """Seconds as `1d 2h 3m 4s`, below a minute with four significant digits."""
    sign = F.when(seconds < 0, "-").otherwise("")
    size = F.abs(seconds)
    whole = F.floor(size).cast("long")
    s, m = F.pmod(whole, F.lit(60)), F.pmod(F.floor(whole / 60), F.lit(60))
    h, d = F.pmod(F.floor(whole / 3600), F.lit(24)), F.floor(whole / 86400)
    return F.when(
        seconds.isNotNull(),
        F.when(size == 0, "0s")
        .when(size >= 86400, F.format_string("%s%dd %dh %dm %ds", sign, d, h, m, s))
        .when(size >= 3600, F.format_string("%s%dh %dm %ds", sign, h, m, s))
        .when(size >= 60, F.format_string("%s%dm %ds", sign, m, s))
        .when(size >= 1, F.concat(_four_digits(seconds), F.lit("s")))
        .otherwise(_small(seconds, "s")),
    )
