from isobar.operators.frequency import distinct_values, modes, number_frequencies, text_frequencies


def mode(spark, values, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    frequencies = (number_frequencies if kind == "double" else text_frequencies)(df, ["x"])
    rows = modes(frequencies).collect()
    return tuple(rows[0])[1:] if rows else None


def test_mode(spark):
    assert mode(spark, [1.0, 2.0, 2.0, 3.0]) == (3, True, 2.0)


def test_no_mode_when_nothing_repeats(spark):
    assert mode(spark, [1.0, 2.0, 3.0]) == (3, False, None)
    assert mode(spark, [5.0]) == (1, False, None)


def test_ties_take_the_smallest(spark):
    assert mode(spark, [4.0, -1.0, 4.0, -1.0, 9.0]) == (3, True, -1.0)
    assert mode(spark, ["b", "a", "b", "a"], "string") == (2, True, "a")


def test_nulls_do_not_count_and_blanks_do(spark):
    assert mode(spark, [None, None, "x"], "string") == (1, False, None)
    assert mode(spark, ["", "", "x"], "string") == (2, True, "")
    assert mode(spark, [None], "string") is None


def test_frequencies_of_several_fields(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "s string, n int")
    rows = {tuple(r) for r in text_frequencies(df, ["s", "n"]).collect()}
    assert rows == {("s", "a", 2), ("s", "b", 1), ("n", "1", 2), ("n", "2", 1)}


def test_distinct_values_have_no_limit(spark):
    df = spark.range(3000).selectExpr("CAST(id AS STRING) AS many", "CAST(id % 3 AS STRING) AS few")
    frequencies = text_frequencies(df, ["many", "few"])
    assert {r.field: r.n_unique for r in modes(frequencies).collect()} == {"many": 3000, "few": 3}
    assert distinct_values(frequencies).filter("field = 'many'").distinct().count() == 3000
