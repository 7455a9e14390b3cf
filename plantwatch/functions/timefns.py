"""Timestamp repair and the two ways of counting days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The text shape of raw timestamps.
RAW_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DOUBLE_FRACTION = r"\.(\d{6})\.000000$"
# The shape nearly all raw timestamps have; a cast reads its first 26 characters as the format does.
USUAL = r"^(19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{6}(\.000000)?\z"

MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def repair_ts(name: str | Column) -> Column:
    """Raw text to timestamp; text of any other shape becomes NULL instead of failing.

    Text of the usual shape is cast, in about half the time a format takes; the rest is read by the format.
    """
    raw = F.col(name) if isinstance(name, str) else name
    text = F.regexp_replace(raw, DOUBLE_FRACTION, ".$1")
    return F.when(raw.rlike(USUAL), F.substring(raw, 1, 26).try_cast("timestamp")).otherwise(
        F.try_to_timestamp(text, F.lit(RAW_FORMAT)))


def raw_text(ts: Column) -> Column:
    """Timestamp to the raw text that :func:`repair_ts` reads."""
    return F.concat(F.date_format(ts, RAW_FORMAT), F.lit(".000000"))


def calendar_days(end: Column, start: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(end, start)


def elapsed_days(end: Column, start: Column) -> Column:
    """Whole 24-hour periods from ``start`` to ``end``, rounded down also when negative."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS_PER_DAY)))


def elapsed_hours(end: Column, start: Column) -> Column:
    """Hours between two instants, with their fraction."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(float(MICROS_PER_HOUR))


def whole_second_hours(end: Column, start: Column) -> Column:
    """Hours between two instants, each cut to its second."""
    return (end.cast("long") - start.cast("long")) / F.lit(3600)


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)
