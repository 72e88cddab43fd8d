"""Time expressions. All instants are UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col, micros


def parse_utc(text: ColumnLike) -> Column:
    """ISO text with Z, an offset, or no zone (then UTC); bad text gives NULL."""
    return F.try_to_timestamp(F.trim(col(text)))


def floor_time(t: ColumnLike, minutes: int) -> Column:
    """Start of the epoch-aligned interval that holds t."""
    width = int(minutes) * 60_000_000
    us = micros(t)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width)))


def day_sequence(start: ColumnLike, end: ColumnLike) -> Column:
    """Array of days, both ends included."""
    return F.sequence(F.to_date(col(start)), F.to_date(col(end)))


def time_index(start: ColumnLike, end: ColumnLike, minutes: int) -> Column:
    """Array of instants from floor(start) to floor(end), both included."""
    step = max(1, int(minutes))
    width = step * 60
    lo = F.floor(micros(start) / (width * 1e6))
    hi = F.floor(micros(end) / (width * 1e6))
    ticks = F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(ticks, lambda k: F.timestamp_seconds(k * width))


def day_of_year(d: ColumnLike) -> Column:
    """Three digits."""
    return F.lpad(F.dayofyear(col(d)).cast("string"), 3, "0")


def year2(d: ColumnLike) -> Column:
    return F.date_format(col(d), "yy")


def gps_week(d: ColumnLike) -> Column:
    days = F.datediff(F.to_date(col(d)), F.lit(fixed.GPS_EPOCH).cast("date"))
    return F.floor(days / 7).cast("long")


def gps_day_of_week(d: ColumnLike) -> Column:
    days = F.datediff(F.to_date(col(d)), F.lit(fixed.GPS_EPOCH).cast("date"))
    return F.pmod(days, F.lit(7)).cast("long")


def gps_seconds_of_week(t: ColumnLike) -> Column:
    epoch = F.unix_micros(F.lit(fixed.GPS_EPOCH).cast("timestamp"))
    return F.pmod(micros(t) - epoch, F.lit(604_800_000_000)) / 1e6


def utc_hour(t: ColumnLike, start: ColumnLike) -> Column:
    """Hours since midnight of the day of ``start``; may pass 24."""
    anchor = F.unix_micros(F.date_trunc("day", col(start).cast("timestamp")))
    return (micros(t) - anchor) / 3.6e9


def hour_label(hour: ColumnLike) -> Column:
    return F.lpad(F.pmod(F.floor(col(hour)), F.lit(24)).cast("string"), 2, "0")


def midpoint(a: ColumnLike, b: ColumnLike) -> Column:
    ua = micros(a)
    return F.timestamp_micros(ua + F.floor((micros(b) - ua) / 2).cast("long"))


def delta_seconds(a: ColumnLike, b: ColumnLike) -> Column:
    return F.abs(micros(a) - micros(b)) / 1e6


def delta_minutes(a: ColumnLike, b: ColumnLike) -> Column:
    return F.abs(micros(a) - micros(b)) / 6e7


def plot_time(t: ColumnLike) -> Column:
    """Hourly stamps end their hour; figures use the middle."""
    return F.timestamp_micros(micros(t) - 1_800_000_000)
