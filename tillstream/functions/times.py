from __future__ import annotations

from pyspark.sql import Column, functions as F

# Epoch milliseconds of 0001-01-01 and of the last millisecond of 9999, the span that prints as yyyy-MM-dd.
_MIN_MS, _MAX_MS = -62135596800000, 253402300799999


def valid_millis(ts: Column) -> Column:
    return ts.between(_MIN_MS, _MAX_MS)


def day_of_millis(ts: Column) -> Column:
    """Epoch ms -> `yyyy-MM-dd` in the session time zone."""
    return F.date_format(F.timestamp_millis(ts), "yyyy-MM-dd")


def hour_of_millis(ts: Column) -> Column:
    """Epoch ms -> `HH` in the session time zone."""
    return F.date_format(F.timestamp_millis(ts), "HH")


def date_part(time_text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` -> the part before the blank."""
    return F.get(F.split(time_text, " "), F.lit(0))


def hour_part(time_text: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss` -> the hour digits; null when there is no time part."""
    return F.get(F.split(F.get(F.split(time_text, " "), F.lit(1)), ":"), F.lit(0))


def previous_day(day: Column) -> Column:
    """`yyyy-MM-dd` text minus one day; text that is no date is an error."""
    return F.date_format(F.date_sub(F.to_date(day, "yyyy-MM-dd"), 1), "yyyy-MM-dd")
