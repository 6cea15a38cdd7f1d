"""Raw readings in their by-day layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from isobar.functions.times import day_of_month, event_time, full_day
from isobar.operators.bykey import by_day, newest

RAW_KEY = ["id", "date", "eventtime"]
_VALUES = ["humidity", "pressure", "temperature", "winddirection", "windspeed"]


def to_raw_day(telegrams: DataFrame, keep: tuple[str, ...] = (), as_float: bool = False) -> DataFrame:
    """Telegrams in the raw table's columns, plus the full ``day``."""
    seconds = F.col("time")
    number = "float" if as_float else "double"
    source = {"temperature": "temp"}
    return telegrams.select(
        F.col("id").cast("string").alias("id"),
        day_of_month(seconds).alias("date"),
        event_time(seconds).alias("eventtime"),
        *[F.col(source.get(v, v)).cast(number).alias(v) for v in _VALUES],
        full_day(seconds).alias("day"),
        *keep,
    )


def last_write_wins(raw: DataFrame, arrival: str) -> DataFrame:
    """One row per ``(id, date, eventtime)``: the one that arrived last.

    ``arrival`` is a number, so every buffer is fixed-width and the dedupe stays a
    hash aggregate; all columns share the ordering and so come from one row.
    A row without arrival comes before all others.
    """
    return newest(raw, [*RAW_KEY, "day"], arrival).select(*RAW_KEY, *_VALUES, "day")


def clustered(raw: DataFrame) -> DataFrame:
    """Laid out for writing by day: ordered by id and time inside each file."""
    return by_day(raw, "id", "eventtime")
