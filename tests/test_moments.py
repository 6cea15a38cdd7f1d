import math
import random
import statistics

from isobar.operators.correlation import default_pairs, pearson
from isobar.operators.fieldtypes import field_types, type_counts
from isobar.operators.numeric import numeric_summary


def test_summary(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 9)], "x double")
    row = numeric_summary(df).head()
    assert (row.n, row.minimum, row.maximum, row.range, row.average, row.variance) == (8, 1, 8, 7, 4.5, 5.25)
    assert math.isclose(row.stddev, math.sqrt(5.25))


def test_summary_of_nothing(spark):
    row = numeric_summary(spark.createDataFrame([(None,)], "x double")).head()
    assert (row.n, row.minimum, row.average, row.variance) == (0, None, None, None)


def test_pearson(spark):
    r = random.Random(3)
    rows = [(x, 2 * x + r.gauss(0, 0.5), 1.0) for x in (r.gauss(0, 1) for _ in range(300))]
    df = spark.createDataFrame(rows + [(None, 4.0, 1.0)], "x double, y double, c double")
    got = {(g.x, g.y): g for g in pearson(df, [("x", "y"), ("x", "c")]).collect()}
    expected = statistics.correlation([a for a, _, _ in rows], [b for _, b, _ in rows])
    assert math.isclose(got["x", "y"].r, expected) and got["x", "y"].n == 300
    assert got["x", "y"].strength == "Very strong positive relationship"
    assert got["x", "c"].r is None and got["x", "c"].strength is None


def test_pair_choice(spark):
    assert default_pairs(["a", "b"]) == [("a", "b")]
    assert default_pairs(["a"]) == default_pairs(["a", "b", "c"]) == []
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1)], "a double, b double")
    assert len(pearson(df).collect()) == 1
    assert pearson(df.selectExpr("a")).collect() == []


def test_field_types(spark):
    df = spark.createDataFrame(
        [(2, "x", "5"), (1, "12", "7"), (3, "", "oops"), (4, "1..2", "8")], "i int, a string, b string"
    )
    rows = {r.field: tuple(r)[1:] for r in field_types(df, "i").collect()}
    assert rows == {
        "i": ("Numeric", 4, 0, 0), "a": ("Numeric", 4, 1, 2), "b": ("Numeric", 4, 0, 1),
    }
    assert tuple(type_counts(field_types(df, "i")).head()) == (3, 3, 0)


def test_kinds_come_from_the_first_row(spark):
    df = spark.createDataFrame([(1, "x"), (2, "5")], "i int, a string")
    kinds = {r.field: (r.kind, r.n_invalid) for r in field_types(df, "i").collect()}
    assert kinds["a"] == ("String", 0)
