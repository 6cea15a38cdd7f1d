"""The exact mode against counts, and what it sends over the network."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from isobar.operators import exactmode
from isobar.operators.exactmode import exact_modes
from isobar.plans.queries import QUERIES


COUNTED_BY_SHUFFLE = exactmode.FEW_VALUES


def by_hand(values):
    counts = Counter(v + 0.0 for v in values if v is not None and v == v)
    if not counts:
        return (0, False, None, 0)
    value, n = min(counts.items(), key=lambda c: (-c[1], c[0]))
    return (sum(counts.values()), n > 1, value if n > 1 else None, n)


def columns_of(spark, columns, parts=3):
    names = list(columns)
    rows = list(zip(*columns.values(), strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(parts)


def cases(rng, n):
    nan = float("nan")
    return {
        "unlike": [rng.random() for _ in range(n)],
        "one_twice": [rng.random() for _ in range(n - 1)] + [5.0],
        "few": [rng.randrange(9) / 4 for _ in range(n)],
        "ties": [float(k // 2) for k in range(n)],
        "one_value": [3.5] * n,
        "hot": [1.5 if k % 3 == 0 else rng.random() for k in range(n)],
        "gaps": [rng.choice([None, nan, float(k)]) for k in range(n)],
        "zeros": [(-0.0, 0.0, float(k))[k % 3] for k in range(n)],
        "rare": [float(rng.randrange(n // 3)) for _ in range(n)],
        "infinite": [rng.choice([float("inf"), float("-inf"), float(k)]) for k in range(n)],
        "empty": [None] * n,
    }


@pytest.fixture(autouse=True)
def slots_for_few_values(monkeypatch):
    """Small columns go through slots here, which they would not otherwise."""
    monkeypatch.setattr(exactmode, "FEW_VALUES", 0)


@pytest.mark.parametrize("tracked", [6000, 0])
@pytest.mark.parametrize("first", [1000, 5])
def test_against_counts(spark, monkeypatch, tracked, first):
    monkeypatch.setattr(exactmode, "SURELY_TRACKED", tracked)
    monkeypatch.setattr(exactmode, "FIRST_SLOTS", first)
    made = cases(random.Random(1), 400)
    made["one_twice"][0] = 5.0
    rows = {r["field"]: tuple(r)[1:] for r in exact_modes(columns_of(spark, made)).collect()}
    assert rows == {name: by_hand(values) for name, values in made.items()}


@pytest.mark.parametrize("limit,value", [("MOST_VALUES", 0), ("BROADCAST_SLOTS", 0), ("FEW_VALUES", 1 << 20)])
def test_beyond_the_limits(spark, monkeypatch, limit, value):
    """Values are counted by a shuffle where slots are too many, or values few."""
    monkeypatch.setattr(exactmode, limit, value)
    monkeypatch.setattr(exactmode, "FIRST_SLOTS", 1)
    made = cases(random.Random(2), 300)
    rows = {r["field"]: tuple(r)[1:] for r in exact_modes(columns_of(spark, made)).collect()}
    assert rows == {name: by_hand(values) for name, values in made.items()}


def test_several_shards_and_flushes(spark, monkeypatch):
    n = 120_000
    df = spark.range(0, n, 1, 4).selectExpr(
        "CAST(xxhash64(id) AS DOUBLE) / 7 AS unlike", "CAST(xxhash64(id % 60000) AS DOUBLE) AS pairs",
        "CAST(if(id IN (5, 70000, 110000), -1, id) AS DOUBLE) AS thrice",
    )
    monkeypatch.setattr(exactmode, "SHARD_BITS", 12)
    expected = {
        r["field"]: (r["has_mode"], r["mode"], r["n"]) for c in df.columns
        for r in df.groupBy(F.col(c).alias("v")).count().agg(F.min(F.struct((-F.col("count")).alias("m"), "v")).alias("t"))
        .selectExpr(f"'{c}' AS field", "t.m < -1 AS has_mode", "if(t.m < -1, t.v, NULL) AS mode", "-t.m AS n").collect()
    }
    rows = {r["field"]: (r["has_mode"], r["mode"], r["n_mode"]) for r in exact_modes(df).collect()}
    assert rows == expected and rows["thrice"] == (True, -1.0, 3) and not rows["unlike"][0]


def test_a_table_without_rows(spark):
    assert [tuple(r) for r in exact_modes(spark.createDataFrame([], "x double")).collect()] == [("x", 0, False, None, 0)]


def test_few_rows_are_sent_for_values_that_differ(spark):
    """Ten million different doubles: slots in long arrays, and only the values of shared slots."""
    n = 10_000_000
    rows = spark.range(0, n, 1, 8).selectExpr("0 AS id", "sqrt(CAST(id AS DOUBLE)) AS x")
    slots, bits = exactmode.slot_counts(rows, n)
    sent = slots.agg(F.count(F.lit(1)), F.sum("n")).first()
    assert sent[1] < n / 50 and sent[0] < n / 100
    in_arrays = 8 * 2 * (1 << (bits - exactmode.SLOT_BITS - exactmode.SHARD_BITS))
    assert in_arrays < n / 100
    assert exactmode.by_slots(rows, {0: n})[0] == exactmode.Mode(None, 1)


def test_the_query_counts_different_values_too(spark, tmp_path):
    values = spark.range(12).selectExpr(
        "id AS event_id", "CAST(id % 5 AS DOUBLE) AS value", "id AS o_orderkey", "CAST(NULL AS DOUBLE) AS o_totalprice",
        "CAST(id % 2 AS DOUBLE) AS l_quantity", "1.5D AS l_extendedprice", "if(id < 3, NULL, sqrt(id)) AS l_discount",
        "double('NaN') AS l_tax",
    )
    for name in ("events", "orders", "lineitem"):
        values.write.parquet(f"{tmp_path}/{name}.parquet")
    rows = {r["field"]: (r["n"], r["n_unique"], r["has_mode"]) for r in QUERIES["mode_or_none"](spark, str(tmp_path)).collect()}
    assert rows == {
        "value": (12, 5, True), "o_orderkey": (12, 12, False), "o_totalprice": (0, 0, False), "l_quantity": (12, 2, True),
        "l_extendedprice": (12, 1, True), "l_discount": (9, 9, False), "l_tax": (0, 0, False),
    }


def test_millions_of_values_are_counted_without_python(spark, monkeypatch):
    """A shuffle of counts takes less time than slots, and no memory of Python."""
    monkeypatch.setattr(exactmode, "FEW_VALUES", COUNTED_BY_SHUFFLE)
    monkeypatch.setattr(exactmode, "slot_counts", lambda *_: pytest.fail("slots for few values"))
    n = 2_000_000
    df = spark.range(0, n, 1, 4).selectExpr("sqrt(CAST(id AS DOUBLE)) AS unlike", f"CAST(if(id = 7, {n - 2}, id) AS DOUBLE) AS twice")
    assert {tuple(r) for r in exact_modes(df).collect()} == {("unlike", n, False, None, 1), ("twice", n, True, float(n - 2), 2)}


FILE_PROFILES = {
    "profile_json_file": (
        "orders", ["if(id = 7, 3, id) AS o_orderkey", "'P' AS o_orderstatus", "id % 9 / 4D AS o_totalprice", "'LOW' AS o_orderpriority"],
        {"o_orderkey": (1_049_999, True, 3.0), "o_totalprice": (9, True, 0.0), "o_orderstatus": (1, True, None), "o_orderpriority": (1, True, None)},
    ),
    "profile_csv_file": (
        "lineitem", ["id % 9 / 4D AS l_quantity", "if(id = 7, 3, id) / 4D AS l_extendedprice", "id % 5 / 4D AS l_discount", "0.5D AS l_tax",
                     "'N' AS l_returnflag", "'O' AS l_linestatus"],
        {"l_quantity": (9, True, 0.0), "l_extendedprice": (1_049_999, True, 0.75), "l_discount": (5, True, 0.0), "l_tax": (1, True, 0.5)},
    ),
}


@pytest.mark.parametrize("name", FILE_PROFILES)
def test_file_profiles_count_many_values_without_python(spark, monkeypatch, tmp_path, name):
    """More values than once went through numpy in every task: the memory of Python does not depend on the table."""
    monkeypatch.setattr(exactmode, "FEW_VALUES", COUNTED_BY_SHUFFLE)
    monkeypatch.setattr(exactmode, "slot_counts", lambda *_: pytest.fail("slots for few values"))
    table, columns, expected = FILE_PROFILES[name]
    spark.range(0, 1_050_000, 1, 4).selectExpr(*columns).write.parquet(f"{tmp_path}/{table}.parquet")
    rows = {r["field"]: (r["n_unique"], r["has_mode"], r["mode"]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
    assert rows == expected
