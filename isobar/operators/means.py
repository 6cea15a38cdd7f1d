"""Means per station. All are partial/final hash aggregates: a hot station is
reduced inside each task before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from isobar.functions.times import event_time
from isobar.schemas import MEASURES, STATION_KEY


def _aggregates():
    return [*[F.avg(m).alias(m) for m in MEASURES], F.max("time").alias("time")]


def station_means(telegrams: DataFrame) -> DataFrame:
    """Plain means of the measures and the newest time, per station and position."""
    return telegrams.groupBy(*STATION_KEY).agg(*_aggregates())


def station_means_sql(telegrams: DataFrame) -> DataFrame:
    """Four means per id, as SQL text."""
    # Which means, under which names.
    return telegrams.sparkSession.sql(
        """SELECT id, AVG(temp) AS temp, AVG(humidity) AS humidity,
                  AVG(winddirection) AS winddirection, AVG(windspeed) AS windspeed
           FROM {telegrams} GROUP BY id""",
        telegrams=telegrams,
    )


def keyed_means(messages: DataFrame) -> DataFrame:
    """Mean of integer message values per key; values that are no integer are skipped."""
    return messages.groupBy("key").agg(F.avg(F.col("value").try_cast("int")).alias("mean"))


def window_means(telegrams: DataFrame, width: str = "60 seconds", delay: str | None = None) -> DataFrame:
    """``station_means`` per tumbling event-time window.

    On a stream ``delay`` sets the watermark, which bounds the window state.
    """
    timed = telegrams.withColumn("et", event_time(F.col("time")))
    if delay is not None:
        timed = timed.withWatermark("et", delay)
    return (
        timed.groupBy(F.window("et", width).alias("w"), *STATION_KEY)
        .agg(*_aggregates())
        .select(
            F.unix_seconds("w.start").alias("window_start"),
            F.unix_seconds("w.end").alias("window_end"),
            *STATION_KEY, *MEASURES, "time",
        )
    )
