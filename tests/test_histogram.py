import random

from isobar.operators.histogram import histogram10


def counts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r.n for r in histogram10(df).orderBy("bin").collect()]


def brute_force(values):
    values = [v for v in values if v is not None]
    low, high = min(values), max(values)
    width = (high - low) / 10
    bins = [0] * 10
    for v in values:
        k = 0
        while k < 9 and v > low + (k + 1) * width:
            k += 1
        bins[k] += 1
    return bins


def test_values_on_edges(spark):
    assert counts(spark, [float(v) for v in range(1, 12)]) == [2, 1, 1, 1, 1, 1, 1, 1, 1, 1]


def test_constant_column(spark):
    assert counts(spark, [3.0, 3.0, 3.0]) == [3] + [0] * 9


def test_nulls_only(spark):
    assert counts(spark, [None, None]) == [0] * 10


def test_agrees_with_brute_force(spark):
    r = random.Random(1)
    for make in (r.random, lambda: r.gauss(0, 5), lambda: r.randrange(30) / 10, lambda: r.expovariate(3)):
        values = [make() for _ in range(700)] + [None]
        got = counts(spark, values)
        assert got == brute_force(values) and sum(got) == 700


def test_labels_and_bounds(spark):
    df = spark.createDataFrame([(0.0,), (10.0,)], "x double")
    first, *_, last = histogram10(df).orderBy("bin").collect()
    assert (first.lo, first.hi, first.label) == (0.0, 1.0, "0.0-1.0")
    assert (last.lo, last.hi, last.label) == (9.0, 10.0, "9.0-10.0")


def test_more_columns_than_one_pass_takes(spark):
    df = spark.range(100).selectExpr(*[f"CAST(id * {i + 1} AS DOUBLE) AS f{i}" for i in range(11)])
    rows = histogram10(df).collect()
    assert len(rows) == 110 and all(r.n == 10 for r in rows)
