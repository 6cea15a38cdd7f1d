"""Epoch seconds to timestamps, days and rendered dates, in the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: form of the rendered date, e.g. ``Fri Jul 01 16:39:41 UTC 2016``.
DATE_TEXT = "EEE MMM dd HH:mm:ss zzz yyyy"


def event_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def date_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), DATE_TEXT)


def day_of_month(seconds: Column) -> Column:
    return F.dayofmonth(F.timestamp_seconds(seconds)).cast("string")


def full_day(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def now_seconds() -> Column:
    return F.unix_seconds(F.current_timestamp())
