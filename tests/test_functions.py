import pytest
from pyspark.sql import functions as F

from isobar.functions.numbers import is_blank, is_invalid, kind_of, number_or_zero, to_double
from isobar.functions.sql import ident, number, text
from isobar.functions.strength import strength
from isobar.functions.times import date_text, day_of_month, event_time, full_day

NUMERIC = ["1", "-1234.45E12", ".5", "+3", "-0.0002E-32", "1..2", "12-5", "2016-07", "12E"]
TEXT = ["5.", "1e5", "", "NaN", "2016-07-01", " 5", "abc", None]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def test_numeric_pattern(spark):
    rows = texts(spark, NUMERIC + TEXT).selectExpr("i", f"{kind_of('v')} AS kind").orderBy("i").collect()
    assert [r.kind for r in rows] == ["Numeric"] * len(NUMERIC) + ["String"] * len(TEXT)


def test_numeric_by_cast(spark):
    cases = {
        "5.": 5.0, "1e5": 1e5, " 5 ": 5.0, "-3.25E2": -325.0, "inf": float("inf"), "-Infinity": float("-inf"),
        "1d": None, "2F": None, "0x1p3": None, "1..2": None, "2016-07": None, "": None, "abc": None, "1_000": None,
    }
    rows = texts(spark, cases).selectExpr("v", f"{to_double('v')} AS x", f"{kind_of('v', 'cast')} AS kind").collect()
    assert {r.v: r.x for r in rows} == cases
    assert all((r.kind == "Numeric") == (cases[r.v] is not None) for r in rows)


def test_blank_and_invalid(spark):
    rows = texts(spark, ["", "  ", None, "4", "x"]).selectExpr(
        f"{is_blank('v')} AS b", f"{is_invalid('v')} AS bad", f"{number_or_zero('v')} AS z"
    )
    assert [tuple(r) for r in rows.collect()] == [
        (True, False, 0.0), (True, False, 0.0), (True, False, 0.0), (False, False, 4.0), (False, True, None),
    ]


def test_unknown_inference():
    with pytest.raises(ValueError):
        kind_of("v", "guess")


def test_strength(spark):
    cases = {
        0.7: "Very strong positive relationship", 0.695: "Very strong positive relationship",
        0.69: "Strong positive relationship", 0.4: "Strong positive relationship",
        0.3: "Moderate positive relationship", 0.2: "Weak positive relationship",
        0.19: "No or negligible relationship", 0.0: "No or negligible relationship",
        -0.25: "Weak negative relationship", -0.35: "Moderate negative relationship",
        -0.5: "Strong negative relationship", -1.0: "Very strong negative relationship", None: None,
    }
    df = spark.createDataFrame([(r,) for r in cases], "r double")
    assert {r.r: r.s for r in df.selectExpr("r", f"{strength('r')} AS s").collect()} == cases


def test_times(spark):
    df = spark.createDataFrame([(1467387581,)], "t bigint")
    row = df.select(
        date_text(F.col("t")), day_of_month(F.col("t")), full_day(F.col("t")),
        F.unix_seconds(event_time(F.col("t"))),
    ).head()
    assert tuple(row) == ("Fri Jul 01 15:39:41 UTC 2016", "1", "2016-07-01", 1467387581)


def test_times_follow_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        df = spark.createDataFrame([(1467387581,)], "t bigint")
        assert df.select(date_text(F.col("t"))).head()[0] == "Fri Jul 01 16:39:41 BST 2016"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_literals(spark):
    odd = "a`b'c\\d"
    df = spark.createDataFrame([(1,)], "x int").withColumnRenamed("x", odd)
    row = df.selectExpr(f"{ident(odd)} AS x", f"{text(odd)} AS y").head()
    assert tuple(row) == (1, odd)
    values = [1e-05, -1.5, 0.1 + 0.2, 1e300, float("inf"), float("-inf")]
    assert list(df.selectExpr(*[number(v) for v in values]).head()) == values
