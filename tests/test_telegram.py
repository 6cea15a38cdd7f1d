import json

from pyspark.sql import functions as F

from isobar.operators import telegram
from isobar.operators.means import keyed_means, station_means, station_means_sql, window_means

STATION = {
    "id": 1, "name": "Alpha", "coord": {"lon": -1.5, "lat": 50.1},
    "main": {"temp": 10.0, "temp_min": 9.0, "temp_max": 11.0, "pressure": 1000.0, "humidity": 60},
    "dt": 1700000000, "wind": {"speed": 2.0, "deg": 90.0}, "clouds": {"all": 80},
    "weather": [{"id": 1, "main": "Dry", "description": "dry and still", "icon": "x1"}],
}
TELEGRAMS = [
    {"id": 1, "location": "Alpha", "latitude": 50.1, "longitude": -1.5, "temp": 10.0, "pressure": 1000.0,
     "humidity": 60.0, "windspeed": 2.0, "winddirection": 90.0, "time": 1700000000},
    {"id": 1, "location": "Alpha", "latitude": 50.1, "longitude": -1.5, "temp": 20.0, "pressure": 1002.0,
     "humidity": 70.0, "windspeed": 4.0, "winddirection": 270.0, "time": 1700000030},
]


def responses(spark, *stations_lists):
    docs = [
        json.dumps({"cod": "200", "calctime": 0.25, "cnt": len(s) + extra, "list": s})
        for s, extra in stations_lists
    ]
    return spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "n int, value string")


def messages(spark, *values):
    return spark.createDataFrame([("k", v if isinstance(v, str) else json.dumps(v)) for v in values], "key string, value string")


def test_flatten(spark):
    calm = {k: v for k, v in STATION.items() if k != "wind"} | {"id": 2}
    df = responses(spark, ([], 0), ([STATION], 0), ([STATION | {"id": 3}, calm], 5))
    rows = telegram.flatten_responses(df, F.lit(1700000099), keep=["n"]).orderBy("n", "id").collect()
    assert [(r.n, r.id, r.windspeed) for r in rows] == [(1, 1, 2.0), (2, 2, None), (2, 3, 2.0)]
    first = rows[0].asDict()
    assert first == {
        "n": 1, "id": 1, "location": "Alpha", "latitude": 50.1, "longitude": -1.5, "temp": 10.0,
        "pressure": 1000.0, "humidity": 60.0, "windspeed": 2.0, "winddirection": 90.0,
        "time": 1700000099, "observed_at": 1700000000,
    }


def test_flatten_skips_what_is_no_response(spark):
    df = spark.createDataFrame([("not json",), ("{}",), (None,)], "value string")
    assert telegram.flatten_responses(df).collect() == []


def test_ingest_clock(spark):
    row = telegram.flatten_responses(responses(spark, ([STATION], 0))).head()
    assert row.time > 1700000000


def test_envelope(spark):
    df = responses(spark, ([STATION], 4))
    assert tuple(telegram.response_envelope(df).head()) == (200, 0.25, 5, 1)


def test_box_is_closed(spark):
    df = spark.createDataFrame([(-3.0, 50.0), (0.0, 60.0), (0.1, 55.0)], "longitude double, latitude double")
    assert telegram.within_box(df, -3.0, 50.0, 0.0, 60.0).count() == 2


def test_parse_and_quarantine(spark):
    parsed = telegram.parse_messages(
        messages(spark, TELEGRAMS[0], '{"id": 1, "location', {"location": "nobody"}, "", {"id": "x"})
    )
    assert [r.id for r in telegram.accepted(parsed).collect()] == [1]
    assert sorted(r.rejected for r in telegram.quarantined(parsed).collect()) == [
        "malformed", "malformed", "malformed", "no id",
    ]


def test_whole_numbers_and_absent_fields(spark):
    parsed = telegram.parse_messages(messages(spark, {"id": 7, "temp": 12}))
    row = telegram.accepted(parsed).head()
    assert (row.id, row.temp, row.pressure, row.time) == (7, 12.0, None, None)


def test_round_trip(spark):
    df = telegram.accepted(telegram.parse_messages(messages(spark, *TELEGRAMS)))
    sent = telegram.to_messages(df)
    assert {r.key for r in sent.collect()} == {"1"}
    assert {r.key for r in telegram.to_messages(df, telegram.MESSAGE_KEY).collect()} == {telegram.MESSAGE_KEY}
    again = telegram.accepted(telegram.parse_messages(sent))
    assert sorted(again.collect()) == sorted(df.collect())


def test_means(spark):
    df = telegram.accepted(telegram.parse_messages(messages(spark, *TELEGRAMS)))
    expected = {
        "id": 1, "location": "Alpha", "latitude": 50.1, "longitude": -1.5, "temp": 15.0, "humidity": 65.0,
        "windspeed": 3.0, "winddirection": 180.0, "pressure": 1001.0, "time": 1700000030,
    }
    assert [r.asDict() for r in station_means(df).collect()] == [expected]
    row = station_means_sql(df).head().asDict()
    assert row == {k: expected[k] for k in ("id", "temp", "humidity", "winddirection", "windspeed")}
    # 1700000000 is 20 s into its minute and the second reading 50 s into it.
    assert [(r.window_start, r.temp) for r in window_means(df).collect()] == [(1699999980, 15.0)]


def test_keyed_means(spark):
    rows = [("K1", "14"), ("K2", "15"), ("K1", "16"), ("K2", "17"), ("K2", "n/a")]
    df = spark.createDataFrame(rows, "key string, value string")
    assert {r.key: r["mean"] for r in keyed_means(df).collect()} == {"K1": 15.0, "K2": 16.0}


def test_comma_form(spark):
    df = spark.createDataFrame([("London,1700000000,12.5",), ("Cardiff,x,1.0",)], "value string")
    assert [tuple(r) for r in telegram.parse_csv_readings(df).collect()] == [
        ("London", 1700000000, 12.5), ("Cardiff", None, 1.0),
    ]
