from functools import reduce

import pytest
from pyspark.sql import functions as F

from isobar.functions.times import date_text
from isobar.operators.upsert import classify, fold_versions, resolve_batch, upsert
from isobar.schemas import LATEST, MEASURES, STATION_KEY
from isobar.sources.lateststate import LatestState
from isobar.sources.versions import complete_versions

MEANS = "id int, location string, latitude double, longitude double, temp double, humidity double, " \
        "windspeed double, winddirection double, pressure double, time bigint"


def means(spark, *rows):
    """Rows of id, location, latitude, temperature (also used for the other measures) and time."""
    full = [(i, loc, lat, -1.0, t, t, t, t, t, time) for i, loc, lat, t, time in rows]
    return spark.createDataFrame(full, MEANS)


def batches(spark):
    return [
        means(spark, (1, "Alpha", 50.0, 10.0, 100), (2, "Beta", 51.0, 20.0, 100)),
        means(spark, (1, "Renamed", 55.0, 11.0, 160), (3, "Gamma", 52.0, 30.0, 160)),
        means(spark, (2, "Beta", 51.0, None, 150), (3, "Gamma", 52.0, 31.0, 90)),
        means(spark, (4, "Delta", 53.0, 40.0, 300)),
    ]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brief(df):
    return {r.id: (r.place, r.location, r.temperature) for r in df.collect()}


def empty(spark):
    return spark.createDataFrame([], LATEST)


def test_update_keeps_place_and_position(spark):
    first, second = (resolve_batch(b) for b in batches(spark)[:2])
    state = upsert(upsert(empty(spark), first), second)
    assert state.schema.names == LATEST.names
    assert brief(state) == {
        1: ("Alpha", "50.0,-1.0", 11.0), 2: ("Beta", "51.0,-1.0", 20.0), 3: ("Gamma", "52.0,-1.0", 30.0),
    }


def test_upserting_twice_changes_nothing(spark):
    first, second = (resolve_batch(b) for b in batches(spark)[:2])
    once = upsert(first, second)
    assert rows(upsert(once, second)) == rows(once)


def test_missing_mean_does_not_overwrite_and_later_batches_win(spark):
    state = reduce(upsert, [resolve_batch(b) for b in batches(spark)])
    assert brief(state)[2][2] == 20.0
    # Batch 3 carried an older reading for id 3; arrival order decides all the same.
    assert brief(state)[3][2] == 31.0
    expected = spark.range(1).select(date_text(F.lit(90))).head()[0]
    assert {r.id: r.time for r in state.collect()}[3] == expected


def test_two_places_in_one_batch(spark):
    batch = means(spark, (1, "Late", 60.0, 5.0, 200), (1, "Early", 40.0, 3.0, 100), (1, "Also late", 41.0, 7.0, 200))
    row = resolve_batch(batch).head()
    assert (row.place, row.location, row.temperature) == ("Early", "40.0,-1.0", 7.0)


def test_classify(spark):
    first, second = (resolve_batch(b) for b in batches(spark)[:2])
    inserts, updates = classify(first, second)
    assert [r.id for r in inserts.collect()] == [3] and [r.id for r in updates.collect()] == [1]


def test_fold_equals_one_by_one(spark):
    resolved = [resolve_batch(b) for b in batches(spark)]
    stacked = reduce(
        lambda a, b: a.unionByName(b), [r.withColumn("v", F.lit(i)) for i, r in enumerate(resolved)]
    )
    assert rows(fold_versions(stacked)) == rows(reduce(upsert, resolved, empty(spark)))


@pytest.mark.parametrize("compact_every", [1, 2, 60])
def test_state_on_disk(spark, tmp_path, compact_every):
    state = LatestState(str(tmp_path / "state"), compact_every)
    assert rows(state.read(spark)) == []
    expected = empty(spark)
    for i, batch in enumerate(batches(spark)):
        state.apply(batch, i)
        expected = upsert(expected, resolve_batch(batch))
        assert rows(state.read(spark)) == rows(expected)
    assert sorted(r.id for r in state.ids(spark).collect()) == [1, 2, 3, 4]
    if compact_every == 60:
        assert brief(state.read(spark, as_of=0)).keys() == {1, 2}
    else:
        with pytest.raises(ValueError, match="pruned"):
            state.read(spark, as_of=0)


def test_many_batches_keep_few_folders(spark, tmp_path):
    state = LatestState(str(tmp_path / "state"), compact_every=3)
    one = batches(spark)[0]
    for k in range(20):
        state.apply(one, k)
        folders = complete_versions(spark, f"{state.root}/batch") + complete_versions(spark, f"{state.root}/base")
        assert len(folders) <= 2 + 2 * 3
    assert brief(state.read(spark)).keys() == {1, 2}


@pytest.mark.parametrize("compact_every", [1, 2])
def test_replayed_batch_gives_the_same_state(spark, tmp_path, compact_every):
    state = LatestState(str(tmp_path / "state"), compact_every)
    for i, batch in enumerate(batches(spark)):
        state.apply(batch, i)
    before = rows(state.read(spark))
    state.apply(batches(spark)[-1], 3)
    assert rows(state.read(spark)) == before


def test_empty_batch(spark, tmp_path):
    state = LatestState(str(tmp_path / "state"))
    state.apply(batches(spark)[0].filter("id > 99"), 0)
    assert rows(state.read(spark)) == []
    state.apply(batches(spark)[0], 1)
    assert brief(state.read(spark)).keys() == {1, 2}


def test_unfinished_folder_is_not_read(spark, tmp_path):
    root = tmp_path / "state"
    state = LatestState(str(root))
    state.apply(batches(spark)[0], 0)
    state.apply(batches(spark)[1], 1)
    (root / "batch" / "v=1" / "_SUCCESS").unlink()
    assert complete_versions(spark, str(root / "batch")) == [0]
    assert brief(state.read(spark)).keys() == {1, 2}


def test_prune(spark, tmp_path):
    root = tmp_path / "state"
    state = LatestState(str(root), compact_every=1)
    for i, batch in enumerate(batches(spark)):
        state.apply(batch, i)
    before = rows(state.read(spark))
    state.prune(spark, keep_bases=1)
    assert complete_versions(spark, str(root / "base")) == [3]
    assert complete_versions(spark, str(root / "batch")) == []
    assert rows(state.read(spark)) == before


def test_columns_of_means_are_those_expected():
    assert set(STATION_KEY) | set(MEASURES) | {"time"} == {c.split()[0] for c in MEANS.split(", ")}
