"""The ``events`` table read as station telegrams, responses and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def counter() -> Column:
    """The integer ``k`` of an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


def as_telegrams(events: DataFrame) -> DataFrame:
    """Telegram columns and ``event_id``."""
    return events.withColumn("k", counter()).selectExpr(
        "event_id",
        "CAST(user_id AS INT) AS id",
        "event_type AS location",
        "50 + (user_id % 100) / 10 AS latitude",
        "-(user_id % 80) / 10 AS longitude",
        "value AS temp",
        "value + k AS pressure",
        "CAST(k AS DOUBLE) AS humidity",
        "k / 10 AS windspeed",
        "k * 3.6D AS winddirection",
        "unix_seconds(CAST(ts AS TIMESTAMP)) AS time",
    )


def telegrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_telegrams(table(spark, sf_dir, "events"))


def spread(rows: DataFrame) -> DataFrame:
    """The same rows, spread evenly over the tasks. A compact table is read by few tasks, but texts made from
    it take a hundred times its space: they are made, and later read, by as many as there are."""
    return rows.hint("rebalance")


def as_responses(readings: DataFrame) -> DataFrame:
    """Each reading as a response document that lists it one to three times, under ids
    1000 apart. ``landed_at`` is one minute after the reading; the document's own stamp
    differs for every reading, so that it orders those of one second."""

    return readings.selectExpr(
        "event_id",
        "time + 60 AS landed_at",
        """to_json(struct(
             '200' AS cod, (event_id % 3 + 1) / 1000 AS calctime, event_id % 3 + 1 AS cnt,
             transform(sequence(0, CAST(event_id % 3 AS INT)), i -> struct(
               id + 1000 * i AS id, location AS name, struct(longitude AS lon, latitude AS lat) AS coord,
               struct(temp, temp AS temp_min, pressure, humidity) AS main, 1700000000 + event_id AS dt,
               struct(windspeed AS speed, winddirection AS deg) AS wind, struct(80 AS all) AS clouds
             )) AS list)) AS value""",
    )


def as_lines(readings: DataFrame) -> DataFrame:
    """``city,epoch,value`` text per reading."""
    return readings.select("event_id", F.concat_ws(",", "location", "time", "temp").alias("value"))

