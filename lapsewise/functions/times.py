"""Epoch-millisecond columns to calendar parts, in the session time zone (UTC)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60 * 1000
MS_PER_HOUR = 60 * MS_PER_MINUTE
MS_PER_DAY = 24 * MS_PER_HOUR


def time_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss")


def date_text(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def hour_of_day(ms: Column) -> Column:
    return F.hour(F.timestamp_millis(ms))


def day_of_month(ms: Column) -> Column:
    return F.dayofmonth(F.timestamp_millis(ms))


def weekday(ms: Column) -> Column:
    """Monday is 0."""
    return F.weekday(F.timestamp_millis(ms))


def whole_days_between(start_ms: Column, end_ms: Column) -> Column:
    """Days from start to end, cut to a whole number."""
    return ((end_ms - start_ms) / F.lit(float(MS_PER_DAY))).cast("int")
