"""Health signals of running streams."""

from __future__ import annotations

import json
import logging
import threading
from collections import Counter, deque

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from isobar.schemas import PROGRESS
from isobar.sources.versions import write_text

log = logging.getLogger("isobar.streaming")


def figures_of(progress) -> dict:
    """The figures of one batch. It is idle if it had no input."""
    return {
        "name": progress.name,
        "batch_id": progress.batchId,
        "rows": progress.numInputRows,
        "elapsed_ms": progress.durationMs.get("triggerExecution"),
        "late": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
        "idle": progress.numInputRows == 0,
    }


class StreamHealth(StreamingQueryListener):
    """Logs the figures of every batch of every query and warns about empty batches and late rows.

    An empty batch is a signal that the producer may be down; the query goes on. ``batches`` and
    ``idle`` show the latest ``keep`` figures; the log has all, and ``late`` the rows that
    the watermark has kept out so far, by query.
    """

    def __init__(self, keep: int = 1000):
        self.batches: deque[dict] = deque(maxlen=keep)
        self.idle: deque[str] = deque(maxlen=keep)
        self.late: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.name)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        figures = figures_of(p) | {"rows_per_second": p.processedRowsPerSecond}
        self.batches.append(figures)
        log.info("batch %s", figures)
        if figures["late"]:
            self.late[p.name] += figures["late"]
            log.warning("%s left out %d late rows", p.name, figures["late"])
        if figures["idle"]:
            self._idle(p.name)

    def onQueryIdle(self, event) -> None:
        self._idle(str(event.id))

    def onQueryTerminated(self, event) -> None:
        log.info("ended %s", event.id)

    def _idle(self, name: str) -> None:
        self.idle.append(name)
        log.warning("no input for %s; check that the producer is running", name)


class ProgressTable(StreamingQueryListener):
    """Lands the figures of every batch as rows in a folder that all can reach: JSON lines, a file for each
    ``per_file`` batches of a run, written anew with each batch until it is full.

    ``read`` gives them as a table, so that idle producers, slow batches and late rows are a query, also for
    other sessions and after the stream has ended.
    """

    def __init__(self, spark: SparkSession, path: str, per_file: int = 100):
        self.spark, self.path, self.per_file = spark, path, per_file
        self._lines: dict[str, list[str]] = {}
        self._written: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        lines = self._lines.setdefault(run, [])
        lines.append(json.dumps(figures_of(p) | {"at": p.timestamp}))
        write_text(self.spark, f"{self.path}/{run}-{self._written[run]}.json", "\n".join(lines) + "\n")
        if len(lines) >= self.per_file:
            self._lines[run] = []
            self._written[run] += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._lines.pop(str(event.runId), None)
            self._change.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Until the last figures of a query that has ended are there: they come after it ends."""
        with self._change:
            return self._change.wait_for(lambda: str(query.runId) in self._ended, seconds)

    @staticmethod
    def read(spark: SparkSession, path: str) -> DataFrame:
        """``(name, batch_id, rows, elapsed_ms, late, idle, at)``: the newest figures of every batch."""
        rows = spark.read.schema(PROGRESS).json(path)
        values = [c for c in PROGRESS.names if c not in ("name", "batch_id")]
        newest = rows.groupBy("name", "batch_id").agg(F.max_by(F.struct(*values), "at").alias("newest"))
        return newest.select("name", "batch_id", "newest.*")
