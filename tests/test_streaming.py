import json
import time

import pytest

from isobar.operators.means import window_means
from isobar.plans.queries import QUERIES
from isobar.sources.lateststate import LatestState
from isobar.sources.messages import (
    file_messages, kafka_messages, landed_responses, publish_to_files, topic_set,
)
from isobar.sources.rawstore import RawStore
from isobar.sources.versions import complete_versions, version_path
from isobar.streaming.health import ProgressTable, StreamHealth
from isobar.streaming.jobs import run_acquisition, run_station_means, run_window_means, window_store
from test_telegram import STATION, TELEGRAMS

START = 1700000000


def reading(id, temp, time, location="Alpha"):
    return TELEGRAMS[0] | {"id": id, "temp": temp, "time": time, "location": location}


def put(folder, name, *values):
    folder.mkdir(exist_ok=True)
    lines = [json.dumps({"key": "k", "value": v if isinstance(v, str) else json.dumps(v)}) for v in values]
    (folder / name).write_text("\n".join(lines) + "\n")


def drain_means(spark, root):
    state = LatestState(str(root / "state"), compact_every=2)
    messages = file_messages(spark, str(root / "in"), files_per_batch=1)
    query = run_station_means(messages, state, str(root / "bad"), str(root / "checkpoint"), drain=True)
    query.awaitTermination()
    return state


def temperatures(spark, state):
    return {r.id: (r.place, r.temperature) for r in state.read(spark).collect()}


def test_means_over_restarts(spark, tmp_path):
    put(tmp_path / "in", "a.json", reading(1, 10.0, START), reading(1, 20.0, START + 30), '{"id": 1, "temp')
    state = drain_means(spark, tmp_path)
    assert temperatures(spark, state) == {1: ("Alpha", 15.0)}
    assert spark.read.parquet(str(tmp_path / "bad")).select("rejected").collect()[0][0] == "malformed"

    time.sleep(1.1)  # the file source orders by modification time
    put(tmp_path / "in", "b.json", reading(1, 30.0, START + 60, "Renamed"), reading(2, 5.0, START + 60))
    state = drain_means(spark, tmp_path)
    # Each batch has its own means: 30, not the mean over all three readings.
    assert temperatures(spark, state) == {1: ("Alpha", 30.0), 2: ("Alpha", 5.0)}

    state = drain_means(spark, tmp_path)
    assert temperatures(spark, state)[1] == ("Alpha", 30.0)
    assert complete_versions(spark, str(tmp_path / "state" / "batch")) == [0, 1]


def test_batch_run_again_after_a_lost_commit(spark, tmp_path):
    put(tmp_path / "in", "a.json", reading(1, 10.0, START))
    drain_means(spark, tmp_path)
    for marker in (tmp_path / "checkpoint" / "commits").glob("*0*"):
        marker.unlink()
    state = drain_means(spark, tmp_path)
    assert temperatures(spark, state) == {1: ("Alpha", 10.0)}
    assert complete_versions(spark, str(tmp_path / "state" / "batch")) == [0]


def test_acquisition(spark, tmp_path):
    inbox = tmp_path / "landed"
    inbox.mkdir()
    document = {"cod": "200", "calctime": 0.01, "cnt": 2}
    far = STATION | {"id": 2, "coord": {"lon": 20.0, "lat": 50.0}}
    (inbox / "r1.json").write_text(json.dumps(document | {"list": [STATION, far]}, indent=2))
    (inbox / "r2.json").write_text("service unavailable")
    raw = RawStore(str(tmp_path / "raw"))
    for _ in range(2):
        run_acquisition(
            landed_responses(spark, str(inbox)), publish_to_files(str(tmp_path / "out")), raw,
            str(tmp_path / "checkpoint"), box=(-3.0, 50.0, 0.0, 60.0), drain=True,
        ).awaitTermination()
    assert [(r.id, r.temperature) for r in raw.read(spark).collect()] == [("1", 10.0)]
    sent = spark.read.json(version_path(str(tmp_path / "out"), 0)).collect()
    assert len(sent) == 1 and sent[0].key == "1"
    value = json.loads(sent[0].value)
    assert value["id"] == 1 and "observed_at" not in value
    assert value["time"] == int((inbox / "r1.json").stat().st_mtime)

    # What was published feeds the other stream.
    state = LatestState(str(tmp_path / "state"))
    run_station_means(
        file_messages(spark, str(tmp_path / "out")), state, str(tmp_path / "bad"), str(tmp_path / "c2"), drain=True
    ).awaitTermination()
    assert temperatures(spark, state) == {1: ("Alpha", 10.0)}


def test_windows_update_and_late_readings_drop(spark, tmp_path):
    def run():
        messages = file_messages(spark, str(tmp_path / "in"), files_per_batch=1)
        run_window_means(messages, str(tmp_path / "out"), str(tmp_path / "checkpoint"), drain=True).awaitTermination()
        out = str(tmp_path / "out")
        versions = [version_path(out, v) for v in complete_versions(spark, out)]
        newest = {}
        for r in sorted(spark.read.option("basePath", out).parquet(*versions).collect(), key=lambda r: r.v):
            newest[r.window_start, r.id] = r.temp
        return newest

    minute = START - START % 60
    put(tmp_path / "in", "a.json", reading(1, 10.0, minute))
    assert run() == {(minute, 1): 10.0}
    time.sleep(1.1)
    put(tmp_path / "in", "b.json", reading(1, 20.0, minute + 30), reading(1, 1.0, minute + 600))
    assert run() == {(minute, 1): 15.0, (minute + 600, 1): 1.0}
    time.sleep(1.1)
    put(tmp_path / "in", "c.json", reading(1, 99.0, minute + 59), reading(1, 3.0, minute + 610))
    assert run() == {(minute, 1): 15.0, (minute + 600, 1): 2.0}


def test_windows_agree_with_the_batch_form(spark, tmp_path):
    rows = [reading(i % 3, float(i), START + 7 * i) for i in range(40)]
    put(tmp_path / "in", "a.json", *rows)
    run_window_means(
        file_messages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c"), drain=True
    ).awaitTermination()
    batch = window_means(spark.createDataFrame(rows))
    streamed = spark.read.parquet(version_path(str(tmp_path / "out"), 0)).select(*batch.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_windows_are_written_once(spark, tmp_path):
    """A window is written when the watermark has passed it; ticks move the watermark while no readings come."""
    (tmp_path / "ticks").mkdir()
    store = window_store(str(tmp_path / "out"), fold_every=4)

    def run(*files, ticks=()):
        for name, *rows in files:
            put(tmp_path / "in", name, *rows)
        for k, t in enumerate(ticks):
            (tmp_path / "ticks" / f"{t}-{k}.json").write_text(json.dumps({"time": t}) + "\n")
            time.sleep(1.1)
        (tmp_path / "in").mkdir(exist_ok=True)
        run_window_means(
            file_messages(spark, str(tmp_path / "in"), files_per_batch=1), store, str(tmp_path / "checkpoint"), closed=True,
            ticks=spark.readStream.schema("time long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "ticks")), drain=True,
        ).awaitTermination()
        return sorted((r.window_start, r.id, r.temp) for r in store.read(spark).collect())

    minute = START - START % 60
    assert run(("a.json", reading(1, 10.0, minute), reading(1, 20.0, minute + 59), reading(2, 1.0, minute + 90))) == []
    found = run(("b.json", reading(1, 30.0, minute + 61), reading(2, 9.0, minute + 190)), ticks=[minute + 190])
    assert found[:1] == [(minute, 1, 15.0)]
    # Too late: its window is gone.
    run(("c.json", reading(1, 99.0, minute + 1)), ticks=[minute + 400])
    found = run(ticks=[minute + 401])
    assert found == [(minute, 1, 15.0), (minute + 60, 1, 30.0), (minute + 60, 2, 1.0), (minute + 180, 2, 9.0)]
    written = [spark.read.schema("window_start long, id int").parquet(f"{r}/v={v}") for r in (store.root, store.folded, store.closed)
               for v in complete_versions(spark, r)]
    keys = [tuple(r) for df in written for r in df.collect()]
    assert len(keys) == len(set(keys)) == 4


def test_window_folders_stay_bounded(spark, tmp_path):
    store = window_store(str(tmp_path / "out"), fold_every=3)
    for k in range(10):
        put(tmp_path / "in", f"{k}.json", reading(1, float(k), START + 60 * k))
        run_window_means(file_messages(spark, str(tmp_path / "in")), store, str(tmp_path / "checkpoint"), drain=True).awaitTermination()
        assert store.folders(spark) <= 2 + 1 + 1
        time.sleep(1.1)
    assert store.read(spark).count() == 10


def test_progress_is_a_table(spark, tmp_path):
    """Rows by batch, readable while the stream runs and after; a batch that is repeated counts once."""
    table = ProgressTable(spark, str(tmp_path / "progress"), per_file=2)
    spark.streams.addListener(table)
    try:
        for k in range(3):
            put(tmp_path / "in", f"{k}.json", *[reading(i, 1.0, START) for i in range(k + 1)])
        state = LatestState(str(tmp_path / "state"))
        query = run_station_means(
            file_messages(spark, str(tmp_path / "in"), files_per_batch=1), state, str(tmp_path / "bad"), str(tmp_path / "c"), drain=True,
            name="means",
        )
        query.awaitTermination()
        assert table.wait(query)
    finally:
        spark.streams.removeListener(table)
    rows = ProgressTable.read(spark, str(tmp_path / "progress")).orderBy("batch_id").collect()
    assert [(r.name, r.batch_id, r.idle, r.late) for r in rows] == [("means", k, False, 0) for k in range(3)]
    assert sorted(r.rows for r in rows) == [1, 2, 3] and all(r.elapsed_ms > 0 for r in rows)
    assert len(list((tmp_path / "progress").glob("*.json"))) == 2


def test_health_reports_batches_and_silence(spark, tmp_path):
    health = StreamHealth()
    spark.streams.addListener(health)
    try:
        put(tmp_path / "in", "a.json", reading(1, 10.0, START))
        drain_means(spark, tmp_path)
        state = LatestState(str(tmp_path / "state"))
        query = run_station_means(
            file_messages(spark, str(tmp_path / "in")), state, str(tmp_path / "bad"), str(tmp_path / "checkpoint"),
            every="100 milliseconds",
        )
        deadline = time.time() + 30
        while not (health.idle and health.batches) and time.time() < deadline:
            time.sleep(0.2)
        query.stop()
    finally:
        spark.streams.removeListener(health)
    assert any(b["rows"] == 1 and b["elapsed_ms"] > 0 for b in health.batches)
    assert health.idle


def test_topics():
    assert topic_set("a,b,a") == "a,b" and topic_set(["x", "y", "x"]) == "x,y"


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="kafka"):
        kafka_messages(spark, "localhost:9092", "test")


@pytest.mark.parametrize("name", ["stream_latest_state", "stream_window_means", "stream_acquire_raw"])
def test_registered_streams_over_a_folder_of_parts(spark, tmp_path, name):
    """A table of three part files gives what one file gives."""
    single = "/root/testdata/sf0.001"
    spark.read.parquet(f"{single}/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    found, expected = (sorted(map(tuple, QUERIES[name](spark, d).collect()), key=repr) for d in (str(tmp_path), single))
    assert len(found) > 0 and found == expected


def test_late_rows_are_counted():
    class Progress:
        class state:  # noqa: N801
            numRowsDroppedByWatermark = 3

        name, batchId, numInputRows, processedRowsPerSecond, durationMs, stateOperators = "w", 1, 5, 1.0, {}, [state]

    health = StreamHealth()
    for _ in range(2):
        health.onQueryProgress(type("Event", (), {"progress": Progress}))
    assert health.late == {"w": 6} and health.batches[-1]["late"] == 3
