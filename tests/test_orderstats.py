import random

import pytest
from pyspark.sql import functions as F

from isobar.operators import orderstats
from isobar.operators.orderstats import order_statistics


def middle(values):
    n = len(values)
    return (values[(n - 1) // 2] + values[n // 2]) / 2.0 if n else None


def by_hand(values):
    ordered = sorted(values)
    n = len(ordered)
    q1, q3 = middle(ordered[: n // 2]), middle(ordered[n // 2 + 1 :])
    return middle(ordered), q1, q3, None if q1 is None or q3 is None else q3 - q1


def found(spark, values, parts=4):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "x double")
    row = order_statistics(df.repartition(parts)).head()
    return (row.median, row.q1, row.q3, row.iqr), row.n


@pytest.fixture
def tiny_limits(monkeypatch):
    """Few values may be sorted at once, so that small inputs go through all rounds."""
    monkeypatch.setattr(orderstats, "SORTED_VALUES", 5)


def test_worked_examples(spark):
    assert found(spark, range(1, 9))[0] == (4.5, 2.5, 7.0, 4.5)
    assert found(spark, range(1, 6))[0] == (3.0, 1.5, 4.5, 3.0)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 8, 9])
def test_small_sizes(spark, n):
    values = [3.0 * i % 7 for i in range(n)]
    assert found(spark, values) == (by_hand(values), n)


@pytest.mark.parametrize(
    "name,make",
    [
        ("uniform", lambda r: r.random()),
        ("few values", lambda r: r.randrange(4)),
        ("hot value", lambda r: 7.0 if r.random() < 0.34 else r.gauss(7, 1)),
        ("mostly one value", lambda r: 1.0 if r.random() < 0.9 else r.random()),
        ("wide range", lambda r: r.choice([-1, 1]) * 10 ** r.uniform(-300, 300)),
        ("two points", lambda r: r.choice([0.0, 1.0])),
        ("constant", lambda r: 2.5),
        ("infinities", lambda r: r.choice([float("inf"), float("-inf"), 0.0, r.random()])),
    ],
)
def test_rounds_of_narrowing(spark, tiny_limits, name, make):
    r = random.Random(name)
    values = [make(r) for _ in range(3001)]
    got, n = found(spark, values)
    expected = by_hand(values)
    assert got[:3] == expected[:3] and n == 3001


def test_even_size_with_narrowing(spark, tiny_limits):
    r = random.Random(5)
    values = [r.gauss(0, 1) for _ in range(2000)]
    assert found(spark, values)[0] == by_hand(values)


def test_misleading_sketch_is_harmless(spark, tiny_limits, monkeypatch):
    """Whatever the splits propose, the counts decide."""
    real = orderstats._sketch

    def wrong(df, intervals):
        real(df, intervals)
        for iv in intervals:
            iv.splits = [iv.splits[0]] * len(iv.splits) if iv.splits else iv.splits

    monkeypatch.setattr(orderstats, "_sketch", wrong)
    monkeypatch.setattr(orderstats, "SORTED_VALUES", 400)
    values = [float(v % 9) for v in range(500)] + [float(v) for v in range(300)]
    assert found(spark, values)[0] == by_hand(values)


def test_nulls_and_nan_are_left_out(spark):
    values = [1.0, None, 2.0, float("nan"), 3.0]
    assert found(spark, values) == (by_hand([1.0, 2.0, 3.0]), 3)


def test_many_columns_at_once(spark, tiny_limits):
    df = spark.range(1000).select(*[((F.col("id") * (i + 3)) % 101).cast("double").alias(f"odd name {i}") for i in range(9)])
    rows = {r.field: r for r in order_statistics(df).collect()}
    for i in range(9):
        values = [float(v * (i + 3) % 101) for v in range(1000)]
        row = rows[f"odd name {i}"]
        assert (row.median, row.q1, row.q3, row.iqr) == by_hand(values)
    assert len(rows) == 9
