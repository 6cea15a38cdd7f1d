"""Nested responses to flat telegrams, and telegrams to and from message text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.functions import times
from isobar.schemas import CSV_READING, ENVELOPE, RESPONSE, TELEGRAM

# Fixed value: a constant key for published telegrams, for those who want one partition.
MESSAGE_KEY = "unitedkingdom"

_CORRUPT = "_corrupt"


def flatten_responses(df: DataFrame, ingest: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One telegram per station of each response in ``value``.

    ``time`` is the ingest clock (or the given column), not the reading's own stamp;
    that one is carried as ``observed_at``.
    """
    ingest = times.now_seconds() if ingest is None else ingest
    # The outer form keeps the optimizer from testing the list for emptiness first, which
    # would parse every document a second time; documents without stations go here.
    stations = (
        df.select(
            *keep,
            ingest.cast("bigint").alias("time"),
            F.posexplode_outer(F.from_json("value", RESPONSE).getField("list")).alias("at", "station"),
        )
        .filter(F.col("at").isNotNull())
        .select(*keep, "time", "station.*")
    )
    return stations.select(
        *keep,
        F.col("id").cast("int").alias("id"),
        F.col("name").alias("location"),
        F.col("coord.lat").alias("latitude"),
        F.col("coord.lon").alias("longitude"),
        F.col("main.temp").alias("temp"),
        F.col("main.pressure").alias("pressure"),
        F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("windspeed"),
        F.col("wind.deg").alias("winddirection"),
        "time",
        F.col("dt").alias("observed_at"),
    )


def response_envelope(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Status, server time and station count of each response in ``value``."""
    r = F.from_json("value", ENVELOPE)
    return df.select(*keep, r.alias("r")).select(
        *keep,
        F.col("r.cod").try_cast("int").alias("cod"),
        F.col("r.calctime").alias("calctime"),
        F.col("r.cnt").cast("int").alias("cnt"),
        F.size("r.list").alias("n_stations"),
    )


def within_box(df: DataFrame, left: float, bottom: float, right: float, top: float) -> DataFrame:
    """Readings inside a closed longitude/latitude box."""
    return df.filter(F.col("longitude").between(left, right) & F.col("latitude").between(bottom, top))


def to_messages(telegrams: DataFrame, key: str | Column | None = None) -> DataFrame:
    """Telegrams as ``(key, value)`` text; nulls are left out of the JSON.

    The key is the station's id, which spreads the stations over the partitions of a topic
    and keeps each in order, or what is given: a text for all or a column.
    """
    key = F.col("id").cast("string") if key is None else F.lit(key) if isinstance(key, str) else key
    return telegrams.select(key.alias("key"), F.to_json(F.struct(*TELEGRAM.names)).alias("value"))


def parse_messages(messages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``value``; adds ``rejected``, the reason a message is unusable, else null."""
    schema = T.StructType(TELEGRAM.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(
        F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    # Going through a generator keeps later filters above the parser, which would
    # otherwise be copied into them and run once per use.
    rows = messages.select(*keep, F.col("value").cast("string").alias("value"), F.inline(F.array(parsed)))
    reason = F.expr(
        f"CASE WHEN value IS NULL OR trim(value) = '' OR {_CORRUPT} IS NOT NULL THEN 'malformed' "
        "WHEN id IS NULL THEN 'no id' END"
    )
    return rows.withColumn("rejected", reason).drop(_CORRUPT)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("rejected").isNull()).drop("value", "rejected")


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("rejected").isNotNull()).select("value", "rejected")


def parse_csv_readings(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``city,epoch,value`` lines to columns."""
    return df.select(*keep, F.from_csv("value", F.lit(CSV_READING)).alias("r")).select(*keep, "r.*")
