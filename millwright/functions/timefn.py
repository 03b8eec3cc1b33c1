"""Time helpers: differences, shift buckets, humanised age, ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .coerce import col_or

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def micros(c) -> Column:
    c = col_or(c)
    return F.unix_micros(c.cast("timestamp"))


def seconds_between(later, earlier) -> Column:
    """(later - earlier) in fractional seconds, null if either side is null."""
    return (micros(later) - micros(earlier)) / F.lit(1e6)


def shift_of(ts) -> Column:
    """06-14 DAY, 14-22 EVENING, otherwise NIGHT (UTC hour)."""
    h = F.hour(col_or(ts))
    return (F.when((h >= 6) & (h < 14), F.lit("DAY"))
             .when((h >= 14) & (h < 22), F.lit("EVENING"))
             .otherwise(F.lit("NIGHT")))


def age_text(ts, as_of) -> Column:
    """``Ns ago`` / ``Nm ago`` / ``Nh ago`` (under 48 h) / ``Nd ago``; null -> N/A."""
    secs = F.greatest(F.lit(0), F.floor(seconds_between(as_of, ts)).cast("long"))
    mins = F.floor(secs / 60).cast("long")
    hours = F.floor(mins / 60).cast("long")
    days = F.floor(hours / 24).cast("long")
    return (F.when(col_or(ts).isNull(), F.lit("N/A"))
             .when(secs < 60, F.concat(secs.cast("string"), F.lit("s ago")))
             .when(mins < 60, F.concat(mins.cast("string"), F.lit("m ago")))
             .when(hours < 48, F.concat(hours.cast("string"), F.lit("h ago")))
             .otherwise(F.concat(days.cast("string"), F.lit("d ago"))))


def iso_text(ts) -> Column:
    return F.date_format(col_or(ts), ISO_FORMAT)
