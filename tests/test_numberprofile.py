"""The shared passes against the single operators, and how often they read the table."""

import glob
import json
import math
import os
import random
import subprocess
import sys

import pytest

from isobar.operators import exactmode, numberprofile, orderstats
from isobar.operators.correlation import pearson
from isobar.operators.exactmode import exact_modes
from isobar.operators.histogram import histogram10
from isobar.operators.numberprofile import profile_numbers
from isobar.operators.numeric import numeric_summary
from isobar.operators.orderstats import order_statistics
from isobar.plans.profile import profile_frame, report_json

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
INF = float("inf")


def made(spark, n=700, parts=5):
    rng = random.Random(7)
    rows = [
        (
            rng.random(), rng.gauss(1e6, 3), float(rng.randrange(9)), 3.5, rng.choice([None, 1.0, 2.0]), None,
            rng.choice([INF, 1.0, 2.0]), rng.choice([INF, -INF]), rng.choice([-INF, rng.random()]), rng.choice([-0.0, 0.0, float("nan")]),
            rng.expovariate(1) * 1e300, rng.randrange(50),
        )
        for _ in range(n)
    ]
    kinds = ", ".join(f"f{k} double" for k in range(11)) + ", whole int"
    return spark.createDataFrame(rows, kinds).repartition(parts)


def by_field(df, *names):
    return {tuple(r[k] for k in names): r.asDict() for r in df.collect()}


def alike(a, b):
    if isinstance(a, float) and isinstance(b, float) and not (math.isinf(a) or math.isinf(b)):
        return math.isnan(a) and math.isnan(b) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b


def same(found, expected, columns):
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        for c in columns:
            assert alike(found[key][c], row[c]), (key, c, found[key][c], row[c])


@pytest.mark.parametrize("limits", [None, 5])
def test_agrees_with_single_operators(spark, monkeypatch, limits):
    if limits:
        monkeypatch.setattr(orderstats, "SORTED_VALUES", limits)
        monkeypatch.setattr(exactmode, "SURELY_TRACKED", 0)
    df = made(spark)
    pairs = [("f0", "f1"), ("f1", "f2"), ("f2", "f3"), ("f0", "f4"), ("f4", "f5"), ("f0", "whole")]
    done = profile_numbers(df, df.columns, pairs)
    records = by_field(done.records, "field")
    same(records, by_field(numeric_summary(df), "field"), ["n", "minimum", "maximum", "range", "average", "variance", "stddev"])
    same(records, by_field(order_statistics(df), "field"), ["median", "q1", "q3", "iqr"])
    same(records, by_field(exact_modes(df), "field"), ["has_mode", "mode"])
    same(by_field(done.histograms, "field", "bin"), by_field(histogram10(df), "field", "bin"), ["lo", "hi", "label", "n"])
    same(by_field(done.correlations, "x", "y"), by_field(pearson(df, pairs), "x", "y"), ["n", "r", "strength"])


def test_infinite_values_are_counted_apart(spark):
    df = spark.createDataFrame([(1.0, INF, 1.0), (2.0, -INF, INF), (INF, INF, None), (-INF, None, None)], "a double, b double, c double")
    for found in (histogram10(df), profile_numbers(df, df.columns).histograms):
        n = {(r.field, r.bin): r.n for r in found.collect() if r.n}
        assert n == {("a", 0): 1, ("a", 9): 1, ("a", -1): 1, ("a", 10): 1, ("b", -1): 1, ("b", 10): 2, ("c", 0): 1, ("c", 10): 1}
    document = json.loads(report_json(profile_frame(df)), parse_constant=pytest.fail)
    a, b, _ = document["Fields"]
    assert (a["Minimum"], a["Maximum"], a["Average"], a["Variance"], a["Median"]) == ("-Infinity", "Infinity", None, None, 1.5)
    assert (b["Maximum"], b["Mode"], b["Range"]) == ("Infinity", "Infinity", "Infinity")


def test_edges_of_the_widest_range(spark):
    df = spark.createDataFrame([(-1.7e308,), (0.0,), (1.7e308,)], "x double")
    for found in (histogram10(df), profile_numbers(df, ["x"]).histograms):
        rows = sorted(found.collect(), key=lambda r: r.bin)
        assert [r.n for r in rows] == [1, 0, 0, 0, 1, 0, 0, 0, 0, 1] and rows[0].lo == -1.7e308


def test_no_columns_and_no_rows(spark):
    df = made(spark, 3)
    assert profile_numbers(df, []).records.collect() == []
    empty = profile_numbers(df.limit(0), ["f0"], [("f0", "f1")])
    assert empty.records.head().n == 0 and empty.correlations.head().n == 0 and empty.histograms.count() == 10
    only = profile_numbers(df, [], [("f0", "f1")]).correlations.head()
    assert only.n == 3


def test_pairs_of_columns_that_are_not_profiled(spark):
    df = made(spark, 50)
    done = profile_numbers(df, ["f0"], [("f1", "f2")])
    assert [r.field for r in done.records.collect()] == ["f0"] and done.correlations.head().n == 50


COUNT_SCANS = """
import sys
from isobar.session import build_session
from isobar.operators.numberprofile import profile_numbers
folder = sys.argv[1]
spark = build_session("scans", "local[4]", **{
    "spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + folder + "/log",
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.checkpoint.dir": folder + "/shared",
    "spark.sql.shuffle.partitions": "4"})
spark.range(0, 400000, 1, 4).selectExpr(
    *[f"CAST(xxhash64(id, {k}) % 1000 AS DOUBLE) / {k + 1} + if(id % 9 = 0, 0, 1) AS f{k}" for k in range(10)],
    "if(id % 3 = 0, 7.5, sqrt(id)) AS hot",
).write.parquet(folder + "/table")
spark.sparkContext.setJobGroup("profile", "profile")
df = spark.read.parquet(folder + "/table")
rows = profile_numbers(df, df.columns, [("f0", "f1"), ("f1", "hot")]).records.collect()
assert len(rows) == 11 and all(r.has_mode for r in rows)
spark.stop()
"""


def scans_of(plan, name="Scan parquet"):
    return plan["nodeName"].startswith(name) + sum(scans_of(p, name) for p in plan["children"])


def test_three_scans_serve_all_columns(tmp_path):
    """Eleven columns and two pairs, by the event log: a mode that repeats often needs no scan of its own."""
    (tmp_path / "log").mkdir()
    subprocess.run([sys.executable, "-c", COUNT_SCANS, str(tmp_path)], cwd=ROOT, check=True, capture_output=True, timeout=300)
    [log] = glob.glob(f"{tmp_path}/log/*")
    scans = rows_sent = 0
    with open(log) as lines:
        for event in map(json.loads, lines):
            if event["Event"].endswith("SparkListenerSQLExecutionStart"):
                scans += scans_of(event["sparkPlanInfo"])
            if event["Event"] == "SparkListenerTaskEnd":
                rows_sent += event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
    assert scans == 3
    # Twelve rows of sketches and counts a task, and the values of the intervals that are sorted.
    assert rows_sent < 11 * 6 * orderstats.SORTED_VALUES / 4


def test_bounds_are_searched_by_halves():
    """At most four comparisons find one of twelve pivots; a search by all of them made the loop too long to compile."""
    pivots = [f"p{k}" for k in range(numberprofile.PIVOTS)]
    sql = numberprofile._search(pivots, lambda k: str(2 * k), lambda k: str(2 * k + 1))
    depth = deepest = 0
    for c in sql.replace("if(", "["):
        depth += (c == "[") - (c == ")")
        deepest = max(deepest, depth)
    assert deepest <= 8 and sql.count("x >") == len(pivots)


def test_places_among_bounds(spark):
    bounds, width = [-INF, -1.5, 0.0, 2.0, INF], 7
    padded = numberprofile._padded(bounds, width)
    values = [-INF, -1e300, -1.5, -1.0, 0.0, 1.0, 2.0, 2.5, INF]
    df = spark.createDataFrame([(v, *padded) for v in values], "x double, " + ", ".join(f"b{k} double" for k in range(width)))
    names = [f"b{k}" for k in range(width)]
    found = df.selectExpr(
        "x", f"{numberprofile._search(names, str)} AS below",
        f"{numberprofile._search(names, lambda k: str(2 * k), lambda k: str(2 * k + 1))} AS place",
    ).collect()
    for r in found:
        assert r.below == sum(r.x > b for b in bounds)
        assert r.place == sum((r.x > b) + (r.x >= b) for b in bounds)
