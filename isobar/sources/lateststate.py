"""Latest-state table: a base snapshot and the batches since.

A batch writes only its own rows, whatever the size of the state, and every
``compact_every`` batches base and batches are folded into a new base, and what only older
bases need is deleted, so the number of folders is bounded. A batch writes
folder ``v=<batch_id>`` and a base is built from older folders only, so running a batch
again gives the same files: restarts are harmless. The folder belongs to one stream
checkpoint, since batch ids start over with a new one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from isobar.operators.upsert import fold_versions, resolve_batch
from isobar.schemas import LATEST
from isobar.sources.versions import complete_versions, delete_folder, is_complete, read_versions, version_path, write_version


@dataclass(frozen=True)
class LatestState:
    root: str
    compact_every: int = 60

    @property
    def _bases(self) -> str:
        return f"{self.root}/base"

    @property
    def _batches(self) -> str:
        return f"{self.root}/batch"

    def apply(self, means: DataFrame, batch_id: int) -> None:
        """Upsert one batch of station means."""
        write_version(resolve_batch(means), self._batches, batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(means.sparkSession, batch_id)
            self.prune(means.sparkSession)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Fold everything up to the batch into a base."""
        if not is_complete(spark, self._bases, batch_id):
            write_version(self._read(spark, batch_id, older_base_than=batch_id), self._bases, batch_id)

    def read(self, spark: SparkSession, as_of: int | None = None) -> DataFrame:
        """The state after batch ``as_of``, or after the newest one. What was pruned is gone:
        asking for it is an error."""
        return self._read(spark, as_of, older_base_than=None)

    def ids(self, spark: SparkSession) -> DataFrame:
        return self.read(spark).select("id")

    def prune(self, spark: SparkSession, keep_bases: int = 2) -> None:
        """Delete what precedes the oldest of the newest ``keep_bases`` bases."""
        bases = complete_versions(spark, self._bases)
        if len(bases) < keep_bases:
            return
        oldest = bases[-keep_bases]
        for version in bases[:-keep_bases]:
            delete_folder(spark, version_path(self._bases, version))
        for version in complete_versions(spark, self._batches):
            if version <= oldest:
                delete_folder(spark, version_path(self._batches, version))

    def _read(self, spark: SparkSession, as_of: int | None, older_base_than: int | None) -> DataFrame:
        bases = [
            b for b in complete_versions(spark, self._bases)
            if (as_of is None or b <= as_of) and (older_base_than is None or b < older_base_than)
        ]
        base = bases[-1] if bases else -1
        stored = complete_versions(spark, self._batches)
        batches = [b for b in stored if b > base and (as_of is None or b <= as_of)]
        if as_of is not None and not bases and 0 not in stored and complete_versions(spark, self._bases):
            raise ValueError(f"the state after batch {as_of} has been pruned")
        if bases and not batches:
            return spark.read.schema(LATEST).parquet(version_path(self._bases, base))
        parts = []
        if bases:
            parts.append(read_versions(spark, self._bases, [base], LATEST))
        if batches:
            parts.append(read_versions(spark, self._batches, batches, LATEST))
        if not parts:
            return spark.createDataFrame([], LATEST)
        return fold_versions(reduce(DataFrame.unionByName, parts))
