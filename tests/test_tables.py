import json

import pytest

from isobar.plans.profile import InvalidValues, type_text_table
from isobar.sources.tables import (
    HEAD_CHARS, SAMPLE_CHARS, BinaryInput, column_names, contains_nul, detect_format, first_lines, read_text_table,
)


def table(spark, path, text, **options):
    path.write_text(text, encoding="utf-8")
    return read_text_table(spark, str(path), **options)


def rows(t):
    return sorted(tuple(r) for r in t.rows.collect())


@pytest.mark.parametrize("sep", [",", "\t", ";", "|"])
def test_delimiters_with_header(spark, tmp_path, sep):
    lines = [["city", "temp", "code"]] + [["London", f"{i}.5", f"c{i}"] for i in range(20)]
    t = table(spark, tmp_path / "t", "\n".join(sep.join(line) for line in lines) + "\n")
    assert (t.filetype, t.delimiter, t.header) == ("CSV", sep, True)
    assert t.kinds == {"city": "String", "temp": "Numeric", "code": "String"}
    assert len(rows(t)) == 20 and rows(t)[0] == ("London", "0.5", "c0")


def test_headerless(spark, tmp_path):
    text = "\n".join(f"{i};{i * 2}" for i in range(10)) + "\n"
    t = table(spark, tmp_path / "t", text, names=["", "twice"])
    assert t.header is False and t.kinds == {"var0": "Numeric", "twice": "Numeric"}
    assert len(rows(t)) == 10


def test_names():
    assert column_names(3) == ["var0", "var1", "var2"]
    assert column_names(3, ["a", None]) == ["a", "var1", "var2"]
    with pytest.raises(ValueError):
        column_names(1, ["a", "b"])


def test_given_settings_win(spark, tmp_path):
    t = table(spark, tmp_path / "t", "a;b,1\nc;d,2\n", sep=",", header=False)
    assert rows(t) == [("a;b", "1"), ("c;d", "2")]


def test_one_column_falls_back_to_comma(spark, tmp_path):
    t = table(spark, tmp_path / "t", "1\n22\n333\n", header=False)
    assert t.delimiter == "," and rows(t) == [("1",), ("22",), ("333",)]


def test_quotes_blanks_and_short_rows(spark, tmp_path):
    t = table(spark, tmp_path / "t", 'n,s\n1,"a, ""b"""\n,x\n3\n', sep=",", header=True)
    assert rows(t) == [("", "x"), ("1", 'a, "b"'), ("3", "")]


def test_line_breaks_in_quotes(spark, tmp_path):
    t = table(spark, tmp_path / "t", 'n,s\n1,"a\nb"\n2,c\n', sep=",", header=True, multiline=True)
    assert rows(t) == [("1", "a\nb"), ("2", "c")]


def test_json_lines(spark, tmp_path):
    text = (
        '{"id": 1, "name": "Zoë", "at": {"lat": 1.5, "tags": ["a"]}, "ok": true, "txt": "12"}\n'
        '{"id": 2, "name": "b", "extra": 5, "at": null, "ok": false, "txt": "x"}\n'
        '{"id": "7", "txt": ""}\n'
    )
    t = table(spark, tmp_path / "t", text)
    assert t.filetype == "JSON"
    assert t.kinds == {"id": "Numeric", "name": "String", "at": "String", "ok": "String", "txt": "Numeric"}
    assert {r.id: tuple(r)[1:] for r in t.rows.collect()} == {
        "1": ("Zoë", '{"lat": 1.5, "tags": ["a"]}', "true", "12"), "2": ("b", None, "false", "x"), "7": (None, None, None, ""),
    }


def test_inference_by_cast(spark, tmp_path):
    text = "a,b\n1e5,12-5\n2,3\n"
    assert table(spark, tmp_path / "t", text, sep=",", header=True).kinds == {"a": "String", "b": "Numeric"}
    assert table(spark, tmp_path / "u", text, sep=",", header=True, infer="cast").kinds == {
        "a": "Numeric", "b": "String",
    }


def test_binary_is_refused(spark, tmp_path):
    for text in ("a,b\n1,2\n3,\x00\n", "a,b\n1,2\n3,4,\x00\n", '{"a": 1}\n{"a": "\x00"}\n'):
        given = {"sep": ",", "header": True}
        with pytest.raises(BinaryInput):
            type_text_table(table(spark, tmp_path / "t", text, **given))
        assert type_text_table(table(spark, tmp_path / "t", text, check_binary=False, **given)).df.count() == 2
    escaped = '{"a": "x"}\n{"a": "\\u0000"}\n'
    assert type_text_table(table(spark, tmp_path / "t", escaped)).n_malformed == 0


def test_damaged_lines_are_counted(spark, tmp_path):
    done = type_text_table(table(spark, tmp_path / "t", "n,s\n1,a\n2\n3,b,more\nnan,c\nx,d\n", sep=",", header=True))
    assert (done.n_malformed, done.n_blank, done.n_invalid, done.n_nan) == (2, {"n": 0}, {"n": 1}, {"n": 1})
    done = type_text_table(table(spark, tmp_path / "t", '{"a": 1}\n{"a": 2\n{"a": 3}\n'))
    assert (done.n_malformed, done.n_blank) == (1, {"a": 1})
    for text in ("n,s\n1,a\n2\n", "n,s\n1,a\nnan,b\n", "n,s\n1,a\nx,b\n", '{"a": 1}\n{"a"\n'):
        with pytest.raises(InvalidValues):
            type_text_table(table(spark, tmp_path / "t", text, sep=",", header=True), strict=True)


def test_repeated_header_names(spark, tmp_path):
    t = table(spark, tmp_path / "t", "a,A,a_2,b,a\n1,2,3,4,5\n", sep=",", header=True)
    assert t.rows.columns == ["a", "A_2", "a_2_2", "b", "a_3"]
    assert rows(t) == [("1", "2", "3", "4", "5")]


def test_nul_count(spark):
    df = spark.createDataFrame([("a",), ("b\x00",), (None,)], "value string")
    assert contains_nul(df).head().n_nul == 1


def test_format_detection():
    assert detect_format('{"a": 1}  \n') == "JSON"
    assert detect_format("{}") == "CSV"
    assert detect_format('[{"a": 1}]') == "CSV"
    assert detect_format("") == "CSV"


def test_first_lines_pass_over_a_lone_header(spark, tmp_path):
    (tmp_path / "a").write_text("n,s\n")
    (tmp_path / "b").write_text("n,s\n1,x\n2,y\n")
    assert first_lines(spark, str(tmp_path), 2) == ["n,s", "1,x"]
    t = read_text_table(spark, str(tmp_path), sep=",", header=True)
    assert rows(t) == [("1", "x"), ("2", "y")]


def test_first_lines_after_many_lone_headers(spark, tmp_path):
    for k in range(20):
        (tmp_path / f"a{k:02}").write_text("temp,s\n" if k % 2 else "")
    (tmp_path / "b").write_text("temp,s\n1,x\n2,y\n3,z\n")
    t = read_text_table(spark, str(tmp_path), sep=",", header=True)
    assert t.kinds == {"temp": "Numeric", "s": "String"} and len(rows(t)) == 3


def test_only_lone_headers(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"a{k}").write_text("temp,s\n")
    assert rows(read_text_table(spark, str(tmp_path), sep=",", header=True)) == []


def test_long_lines_stay_where_they_are(spark, tmp_path):
    """Single lines of 15 MB: what the driver looks at is a small piece of them."""
    n = 15_000_000
    (tmp_path / "csv").write_text("x" * n)
    (tmp_path / "rows").write_text("name,n\n" + "y" * n + ",5\n")
    (tmp_path / "json").write_text('{"id": 7, "text": "' + "z" * n + '", "at": {"deep": [' + "1," * 1000 + '1]}}\n{"id": 8}\n')
    for name in ("csv", "rows", "json"):
        assert sum(len(line) for line in first_lines(spark, str(tmp_path / name))) <= 2 * HEAD_CHARS
    t = read_text_table(spark, str(tmp_path / "csv"), sep=",", header=False)
    assert t.rows.selectExpr("length(var0)").head()[0] == n
    t = read_text_table(spark, str(tmp_path / "json"))
    assert t.kinds == {"id": "Numeric", "text": "String", "at": "String"}
    assert [tuple(r) for r in t.rows.selectExpr("id", "length(text)").collect()] == [("7", n), ("8", None)]
    # Cells beyond the piece can't be named.
    with pytest.raises(ValueError, match="beyond"):
        read_text_table(spark, str(tmp_path / "rows"), sep=",", header=True)


def test_keys_of_the_first_object(spark, tmp_path):
    first = {"b": 1, "a.b": "x", "A`": 2.5, "c d": None, "e": "NaN", "f": True, "g": "3", "h": [1], "i": 10**30, "": "q"}
    t = table(spark, tmp_path / "t", json.dumps(first) + "\n")
    assert t.rows.columns == list(first)
    assert {k for k, kind in t.kinds.items() if kind == "Numeric"} == {"b", "A`", "g", "i"}
    with pytest.raises(ValueError, match="no JSON object"):
        table(spark, tmp_path / "u", '{"a": 1, }}\n{"a": 2}\n')


def test_short_lines_fill_the_sample(spark, tmp_path):
    (tmp_path / "t").write_text("".join(f"{k % 10}\n" for k in range(3000)))
    assert 2 * len(first_lines(spark, str(tmp_path / "t"))) >= SAMPLE_CHARS
    assert table(spark, tmp_path / "t2", "", sep=",", header=False).rows.columns == []
