"""How the streaming queries land their input: by every task, in files that can be listed together."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from isobar.plans import queries
from isobar.plans.queries import QUERIES

N = 3000


@pytest.fixture
def events(spark, tmp_path):
    """A table in a single file with a single row group, which one task reads."""
    spark.range(0, N, 1, 1).selectExpr(
        "id AS event_id", "TIMESTAMP_NTZ '2024-01-03 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 40 AS user_id",
        "'view' AS event_type", "id / 8D AS value", """concat('{"k": ', id % 100, '}') AS props""",
    ).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    return str(tmp_path / "sf")


@pytest.fixture
def landed_at(spark, tmp_path, monkeypatch):
    """Small parts of a shuffle stay apart, as large ones do by themselves; queries land below one folder."""
    monkeypatch.setattr(queries, "shared_dir", lambda _, name: f"{tmp_path}/shared")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    for name, size in small.items():
        spark.conf.set(name, size)
    yield f"{tmp_path}/shared"
    for name in small:
        spark.conf.unset(name)


@pytest.mark.parametrize(
    "name,batches,rows",
    [("stream_progress", 4, 4), ("stream_acquire_messages", 2, 2 * N), ("stream_restart", 3, None)],
)
def test_responses_are_landed_by_several_tasks(spark, events, landed_at, name, batches, rows):
    found = QUERIES[name](spark, events)
    if rows is not None:
        assert found.count() == rows
    with_rows = spark.read.parquet(f"{landed_at}/landed").groupBy(F.input_file_name()).count()
    assert with_rows.count() >= 2 * batches
    assert spark.read.parquet(f"{landed_at}/landed").count() == N


def test_documents_are_files_of_one_folder(spark, events, landed_at):
    found = QUERIES["landed_responses"](spark, events)
    assert found.count() == sum(i % 3 + 1 for i in range(N))
    documents = [f for f in glob.glob(f"{landed_at}/in/**", recursive=True) if f.endswith(".txt")]
    assert 10 < len(documents) <= 2 + N // 200 and {os.path.dirname(f) for f in documents} == {f"{landed_at}/in"}
