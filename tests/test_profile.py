import json
import os

import pytest

from isobar.plans.profile import (
    NO_MODE, InvalidValues, ProfileConfig, profile_file, profile_frame, report, report_json, type_frame,
)


@pytest.fixture
def people(tmp_path):
    path = tmp_path / "people.csv"
    lines = ["name,age,height"] + [f"p{i % 3},{i},{i * 2}.5" for i in range(1, 9)]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_report_of_a_file(spark, people, tmp_path):
    meta = tmp_path / "meta.json"
    done = profile_file(spark, ProfileConfig(people, metafile=str(meta)))
    document = json.loads(meta.read_text())
    assert document == report(done) == json.loads(report_json(done))
    assert meta.read_text().startswith('{\n    "filetype"')
    assert {k: document[k] for k in ("filetype", "inputfile", "FieldSeparator", "HeaderPresent", "No Of Fields")} == {
        "filetype": "CSV", "inputfile": people, "FieldSeparator": ",", "HeaderPresent": "True", "No Of Fields": 3,
    }
    name, age, height = document["Fields"]
    assert name == {
        "Name": "name", "Type": "String", "NumUniqueValues": 3, "UniqueValues": f"{meta}.values", "Mode": "p1",
    }
    assert {r.value for r in spark.read.parquet(f"{meta}.values").collect()} == {"p0", "p1", "p2"}
    assert age == {
        "Name": "age", "Type": "Numeric", "Minimum": 1.0, "Maximum": 8.0, "Range": 7.0, "Average": 4.5,
        "Median": 4.5, "Mode": NO_MODE, "Variance": 5.25, "Standard Deviation": pytest.approx(5.25**0.5),
        "First Quartile": 2.5, "Third Quartile": 7.0, "IQR": 4.5,
    }
    assert document["Pearsons CC (age Vs height)"] == pytest.approx(1.0)
    assert done.histograms.filter("field = 'age'").count() == 10
    assert done.frequencies.filter("field = 'name'").count() == 3
    assert all(os.path.isdir(p) for p in (done.frequencies_path, done.typed.landed))
    done.discard()
    assert os.path.exists(done.frequencies_path) and not os.path.exists(done.typed.landed)
    unwritten = profile_file(spark, people)
    assert unwritten.strings.count() == 1
    unwritten.discard()
    assert not any(os.path.exists(p) for p in (unwritten.frequencies_path, unwritten.typed.landed))


def test_settings():
    text = '{"infile": "x", "separator": ";", "hasheader": "True", "format": "csv", "other": 1}'
    assert ProfileConfig.from_json(text) == ProfileConfig("x", None, "csv", "True", ";")
    with pytest.raises(ValueError):
        ProfileConfig.from_json('{"metafile": "m"}')


@pytest.fixture
def gaps(tmp_path):
    path = tmp_path / "gaps.csv"
    path.write_text("k,x\na,1\nb,\nc,3\nd,oops\ne,5\n")
    return str(path)


def test_blank_rules(spark, gaps):
    options = {"sep": ",", "header": True}
    skipped = profile_file(spark, gaps, **options)
    row = skipped.numeric.head()
    assert (row.n, row.average, skipped.typed.n_blank, skipped.typed.n_invalid) == (3, 3.0, {"x": 1}, {"x": 1})
    zero = profile_file(spark, gaps, blank="zero", **options).numeric.head()
    assert (zero.n, zero.minimum, zero.average) == (4, 0.0, 2.25)
    with pytest.raises(InvalidValues, match="blank"):
        profile_file(spark, gaps, blank="fail", **options)
    with pytest.raises(InvalidValues, match="no numbers"):
        profile_file(spark, gaps, strict=True, **options)
    with pytest.raises(ValueError):
        profile_file(spark, gaps, blank="other", **options)


def test_json_file(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text("".join(json.dumps({"id": i, "tag": "t", "at": {"x": i % 2}}) + "\n" for i in range(6)))
    done = profile_file(spark, str(path))
    document = report(done)
    assert document["filetype"] == "JSON" and "FieldSeparator" not in document
    kinds = {f["Name"]: f["Type"] for f in document["Fields"]}
    assert kinds == {"id": "Numeric", "tag": "String", "at": "String"}
    assert document["Fields"][2]["NumUniqueValues"] == 2
    at = done.distinct.filter("field = 'at'").select("value").collect()
    assert sorted(r[0] for r in at) == ['{"x": 0}', '{"x": 1}']


def test_frame(spark):
    df = spark.createDataFrame(
        [(1, "3", "x", {"a": 1}), (2, "4", "x", {"a": 1})], "n int, t string, s string, m map<string, int>"
    ).withColumnRenamed("s", "odd `name`")
    with pytest.raises(ValueError, match="first_by"):
        type_frame(df)
    typed = type_frame(df, first_by="n")
    assert typed.kinds == {"n": "Numeric", "t": "Numeric", "odd `name`": "String", "m": "String"}
    done = profile_frame(df, first_by="n", land=True)
    fields = {f["Name"]: f for f in report(done)["Fields"]}
    assert fields["odd `name`"]["Mode"] == "x" and fields["m"]["Mode"] == '{"a":1}'
    assert fields["t"]["Average"] == 3.5


def test_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, 9.0), (2.0, 4.0, 1.0)], "a double, b double, c double")
    assert profile_frame(df).correlations.collect() == []
    assert len(profile_frame(df, pairs=[("a", "b"), ("a", "c")]).correlations.collect()) == 2


def test_table_without_rows(spark):
    document = report(profile_frame(spark.createDataFrame([], "a double, s string"), first_by="a"))
    numeric, text = document["Fields"]
    assert numeric["Minimum"] is None and numeric["Median"] is None and numeric["Mode"] == NO_MODE
    assert text["NumUniqueValues"] == 0
