"""Raw by-day table in parquet: readings by station, day of month and second."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.operators.rawday import RAW_KEY, last_write_wins, to_raw_day
from isobar.schemas import RAW_DAY
from isobar.sources.daystore import DayStore


@dataclass(frozen=True)
class RawStore:
    root: str
    as_float: bool = False
    fold_every: int = 60

    @property
    def days(self) -> DayStore:
        return DayStore(self.root, RAW_DAY, (*RAW_KEY, "day"), ("id", "eventtime"), self.fold_every)

    def write(self, telegrams: DataFrame, batch_id: int, arrival: str | None = None) -> None:
        """Store one batch. ``arrival`` orders repeated keys inside the batch; without
        it an arbitrary one of them is kept."""
        keep = (arrival,) if arrival else ()
        raw = to_raw_day(telegrams, keep, self.as_float)
        if not arrival:
            raw, arrival = raw.withColumn("_arrival", F.lit(0)), "_arrival"
        self.days.append(last_write_wins(raw, arrival), batch_id)

    def read(self, spark: SparkSession, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        return self.days.read(spark, first_day, last_day)
