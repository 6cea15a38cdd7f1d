"""A keyed table by day that a stream writes batch by batch, in a bounded number of folders.

Each micro-batch owns the folder ``v=<batch_id>`` with one partition per day, so a repeated batch is written once.
Across batches the later one wins on equal keys; that is settled when reading, where the day filter prunes partitions.

Every ``fold_every`` batches the writer itself folds them: once event time has moved on to another day, the days
before it go to ``closed/v=<batch_id>``, and what is still open to ``folded/v=<batch_id>``. Both are written before
anything is deleted, and what is complete is never written again, so a fold that was broken off at any place
goes on when its batch is repeated. There are fewer than ``fold_every`` batches, one folded folder and one closed
folder for each day at most. Rows that come late for a closed day wait in the folded part for the next closing.

A folder belongs to one stream checkpoint, since batch ids start over with a new one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from isobar.operators.bykey import by_day, newest
from isobar.sources.versions import complete_versions, days_of, delete_folder, read_versions, version_path, write_version


#: Fixed value: the partition of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class DayStore:
    """``schema`` has the text column ``day`` last, and ``key`` the columns that name a row, ``day`` among them."""

    root: str
    schema: T.StructType
    key: tuple[str, ...]
    order: tuple[str, ...]
    fold_every: int = 60

    @property
    def folded(self) -> str:
        return f"{self.root}/folded"

    @property
    def closed(self) -> str:
        return f"{self.root}/closed"

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Store one batch, with one row per key, and fold when it is time."""
        write_version(by_day(rows, *self.order), self.root, batch_id, "day")
        if (batch_id + 1) % self.fold_every == 0:
            self.fold(rows.sparkSession, batch_id)

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        """Fold all batches up to ``batch_id``. Harmless when repeated."""
        batches = [v for v in complete_versions(spark, self.root) if v <= batch_id]
        done = complete_versions(spark, self.folded)
        older = [v for v in done if v < batch_id]
        if batch_id not in done:
            sources = [(self.root, batches), (self.folded, older)]
            days = {day for root, versions in sources for v in versions for day in days_of(spark, root, v)} - {NO_DAY}
            rows = newest(self._rows(spark, sources), list(self.key), "v").select(*self.schema.names)
            last_closed = max(
                (d for v in complete_versions(spark, self.closed) if v < batch_id for d in days_of(spark, self.closed, v)), default=""
            )
            over = sorted(days)[:-1]
            close = over if over and over[-1] > last_closed else []
            over_now = F.coalesce(F.col("day").isin(close), F.lit(False)) if close else F.lit(False)
            if close:
                write_version(by_day(rows.where(over_now), *self.order), self.closed, batch_id, "day")
            write_version(by_day(rows.where(~over_now), *self.order), self.folded, batch_id, "day")
        for root, versions in ((self.root, batches), (self.folded, older)):
            for v in versions:
                delete_folder(spark, version_path(root, v))

    def read(self, spark: SparkSession, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """One row per key, of all days or those from ``first_day`` to ``last_day``."""
        roots = (self.root, self.folded, self.closed)
        rows = self._rows(spark, [(root, complete_versions(spark, root)) for root in roots])
        if first_day is not None:
            rows = rows.filter(F.col("day") >= first_day)
        if last_day is not None:
            rows = rows.filter(F.col("day") <= last_day)
        return newest(rows, list(self.key), "v").select(*self.schema.names)

    def folders(self, spark: SparkSession) -> int:
        """How many folders a reader lists, not counting days."""
        return sum(len(complete_versions(spark, root)) for root in (self.root, self.folded, self.closed))

    def _rows(self, spark: SparkSession, sources: list[tuple[str, list[int]]]) -> DataFrame:
        parts = [read_versions(spark, root, versions, self.schema) for root, versions in sources if versions]
        if not parts:
            return spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField("v", T.LongType())]))
        return reduce(DataFrame.unionByName, parts)
