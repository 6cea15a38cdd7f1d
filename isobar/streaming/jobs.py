"""The two long-running streams: acquisition, and means per station."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from isobar.functions.times import full_day
from isobar.operators.means import station_means, window_means
from isobar.operators.telegram import (
    accepted, flatten_responses, parse_messages, quarantined, to_messages, within_box,
)
from isobar.schemas import STATION_KEY, WINDOW_DAY
from isobar.sources.daystore import DayStore
from isobar.sources.lateststate import LatestState
from isobar.sources.rawstore import RawStore
from isobar.sources.versions import write_version

# How often responses are picked up, and how long a batch of means is.
POLL = "10 seconds"
BATCH = "60 seconds"

Publisher = Callable[[DataFrame, int], None]


def _start(
    stream: DataFrame, handle: Publisher, checkpoint: str, every: str, drain: bool, name: str | None, mode: str = "append"
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).foreachBatch(handle).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()


def run_acquisition(
    responses: DataFrame,
    publish: Publisher,
    raw: RawStore,
    checkpoint: str,
    *,
    key: str | None = None,
    box: tuple[float, float, float, float] | None = None,
    every: str = POLL,
    drain: bool = False,
    name: str | None = "acquisition",
) -> StreamingQuery:
    """Responses to telegrams; each batch is published and kept in the raw table.

    ``box`` is left, bottom, right, top. The ingest time is when the response landed if
    the stream says so, which makes a repeated batch identical, and else the clock. ``key``
    replaces the station's id as the key of messages.
    ``drain`` stops once what is there has been handled. Running queries of one session
    differ in ``name``.
    """
    landed = F.col("landed_at") if "landed_at" in responses.columns else None

    def handle(batch: DataFrame, batch_id: int) -> None:
        telegrams = flatten_responses(batch, landed)
        if box is not None:
            telegrams = within_box(telegrams, *box)
        telegrams = telegrams.persist()
        try:
            publish(to_messages(telegrams, key), batch_id)
            raw.write(telegrams, batch_id, arrival="observed_at")
        finally:
            telegrams.unpersist()

    return _start(responses, handle, checkpoint, every, drain, name)


def run_station_means(
    messages: DataFrame,
    state: LatestState,
    quarantine: str,
    checkpoint: str,
    *,
    every: str = BATCH,
    drain: bool = False,
    name: str | None = "station_means",
) -> StreamingQuery:
    """Means per station of what arrived in each batch, upserted into the latest state.
    Messages that cannot be used go to ``quarantine``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_messages(batch).persist()
        try:
            write_version(quarantined(parsed), quarantine, batch_id)
            state.apply(station_means(accepted(parsed)), batch_id)
        finally:
            parsed.unpersist()

    return _start(messages, handle, checkpoint, every, drain, name)


def window_store(output: str, fold_every: int = 60) -> DayStore:
    """Where ``run_window_means`` keeps its rows: one for each window and station."""
    key = ("window_start", "window_end", *STATION_KEY, "day")
    return DayStore(output, WINDOW_DAY, key, ("window_start", "id"), fold_every)


def run_window_means(
    messages: DataFrame,
    output: str | DayStore,
    checkpoint: str,
    *,
    width: str = BATCH,
    delay: str = BATCH,
    every: str = BATCH,
    closed: bool = False,
    ticks: DataFrame | None = None,
    drain: bool = False,
    name: str | None = "window_means",
) -> StreamingQuery:
    """Means per station and event-time window, in a ``window_store``.

    A window is written whenever it changes; with ``closed`` it is written once, as it leaves the state
    because the watermark has passed it. ``ticks``, a stream with a column ``time`` of epoch seconds, moves the
    watermark on where readings may stay away, and makes no windows.

    Readings that arrive more than ``delay`` behind the newest are left out;
    ``StreamHealth`` counts them.
    """
    telegrams = accepted(parse_messages(messages))
    if ticks is not None:
        telegrams = telegrams.unionByName(ticks.select(F.col("time").cast("long").alias("time")), allowMissingColumns=True)
    means = window_means(telegrams, width, delay)
    store = output if isinstance(output, DayStore) else window_store(output)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Here, since a filter on the stream itself would keep ticks from the watermark.
        rows = batch.where("id IS NOT NULL")
        store.append(rows.withColumn("day", full_day(F.col("window_start"))), batch_id)

    return _start(means, handle, checkpoint, every, drain, name, mode="append" if closed else "update")
