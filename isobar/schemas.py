"""Fixed schemas: no stream here ever infers one."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_INT, _LONG, _DOUBLE, _TEXT = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()

# One station reading as it travels in a message value.
TELEGRAM = _struct(
    id=_INT, location=_TEXT, latitude=_DOUBLE, longitude=_DOUBLE, temp=_DOUBLE, pressure=_DOUBLE,
    humidity=_DOUBLE, windspeed=_DOUBLE, winddirection=_DOUBLE, time=_LONG,
)

# A polled response, narrowed to the nested fields that are read.
STATION = _struct(
    id=_LONG,
    name=_TEXT,
    coord=_struct(lon=_DOUBLE, lat=_DOUBLE),
    main=_struct(temp=_DOUBLE, pressure=_DOUBLE, humidity=_DOUBLE),
    dt=_LONG,
    wind=_struct(speed=_DOUBLE, deg=_DOUBLE),
)
RESPONSE = _struct(cod=_TEXT, calctime=_DOUBLE, cnt=_DOUBLE, list=T.ArrayType(STATION))

# The same without the readings, for what is said about the response as a whole.
ENVELOPE = _struct(cod=_TEXT, calctime=_DOUBLE, cnt=_DOUBLE, list=T.ArrayType(_struct(id=_LONG)))

# Latest state: one row per station; ``location`` is the position as 'lat,lon' text.
LATEST = _struct(
    id=_INT, place=_TEXT, location=_TEXT, windspeed=_DOUBLE, winddirection=_DOUBLE, pressure=_DOUBLE,
    humidity=_DOUBLE, temperature=_DOUBLE, time=_TEXT,
)

# Raw readings by day. ``date`` is the day of the month as text; ``day`` is the full
# date and the partition column.
RAW_DAY = _struct(
    id=_TEXT, date=_TEXT, eventtime=T.TimestampType(), humidity=_DOUBLE, pressure=_DOUBLE,
    temperature=_DOUBLE, winddirection=_DOUBLE, windspeed=_DOUBLE, day=_TEXT,
)

# Means by station and window; ``day`` is that of the window's start and the partition column.
WINDOW_DAY = _struct(
    window_start=_LONG, window_end=_LONG, id=_INT, location=_TEXT, latitude=_DOUBLE, longitude=_DOUBLE, temp=_DOUBLE,
    humidity=_DOUBLE, windspeed=_DOUBLE, winddirection=_DOUBLE, pressure=_DOUBLE, time=_LONG, day=_TEXT,
)

# Figures of a stream's batches.
PROGRESS = _struct(
    name=_TEXT, batch_id=_LONG, rows=_LONG, elapsed_ms=_LONG, late=_LONG, idle=T.BooleanType(), at=_TEXT,
)

# A comma-form reading.
CSV_READING = "city STRING, time BIGINT, value DOUBLE"

MEASURES = ["temp", "humidity", "windspeed", "winddirection", "pressure"]
LATEST_MEASURES = ["windspeed", "winddirection", "pressure", "humidity", "temperature"]
STATION_KEY = ["id", "location", "latitude", "longitude"]
