"""Latest state per station: insert new ids, refresh the measures of known ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.times import date_text
from isobar.schemas import LATEST, LATEST_MEASURES

_FIRST_SEEN = ["place", "location"]
_NEWEST = [*LATEST_MEASURES, "time"]


def _in_latest_order(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LATEST.fields])


def resolve_batch(means: DataFrame) -> DataFrame:
    """One latest-state row per id out of a batch of station means.

    Within a batch the groups of an id apply in order of time (on equal times the
    smallest location, then position, applies last): the first gives place and
    position, the last non-null mean gives each measure.
    """
    newest_first = F.struct((-F.col("time")).alias("age"), "location", "latitude", "longitude")
    keyed = means.withColumn("k", newest_first)

    def last(column: str) -> Column:
        return F.min_by(column, F.when(F.col(column).isNotNull(), F.col("k")))

    one = keyed.groupBy("id").agg(
        F.max_by("location", F.when(F.col("location").isNotNull(), F.col("k"))).alias("place"),
        F.max_by(F.struct("latitude", "longitude"), "k").alias("at"),
        *[last(m).alias(m) for m in ("windspeed", "winddirection", "pressure", "humidity")],
        last("temp").alias("temperature"),
        F.max("time").alias("seconds"),
    )
    return _in_latest_order(
        one.withColumn("location", F.concat("at.latitude", F.lit(","), "at.longitude"))
        .withColumn("time", date_text(F.col("seconds")))
    )


def flag_known(current: DataFrame, batch: DataFrame, flag: str = "known") -> DataFrame:
    """The batch with a column that tells whether the id is in the current state, which
    holds each id once."""
    known = current.select("id", F.lit(True).alias(flag))
    return batch.join(known, "id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def classify(current: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The batch rows that insert and those that update, by presence of the id."""
    flagged = flag_known(current, batch)
    return tuple(flagged.where(F.col("known") == update).drop("known") for update in (False, True))


def upsert(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Next state from the current one and a resolved batch.

    Known ids keep place and position and take every non-null measure; unknown ids
    are inserted whole.
    """
    old, new = current.alias("old"), batch.alias("new")
    joined = old.join(new, F.col("old.id") == F.col("new.id"), "full_outer")
    return _in_latest_order(
        joined.select(
            F.coalesce("old.id", "new.id").alias("id"),
            *[F.coalesce(f"old.{c}", f"new.{c}").alias(c) for c in _FIRST_SEEN],
            *[F.coalesce(f"new.{c}", f"old.{c}").alias(c) for c in _NEWEST],
        )
    )


def fold_versions(versions: DataFrame, version: str = "v") -> DataFrame:
    """Apply any number of stacked states in version order: same result as ``upsert``
    one by one, with a single shuffle on id."""

    def when_present(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(version))

    return _in_latest_order(
        versions.groupBy("id").agg(
            *[F.min_by(c, when_present(c)).alias(c) for c in _FIRST_SEEN],
            *[F.max_by(c, when_present(c)).alias(c) for c in _NEWEST],
        )
    )
