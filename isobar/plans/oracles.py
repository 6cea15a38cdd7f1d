"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from isobar.plans.queries import BOX, LINE_MEASURES, SPLIT_SECOND, SPLIT_SECONDS

_T = """t AS (
  SELECT event_id, CAST(user_id AS INTEGER) AS id, event_type AS location,
         CAST(50 + (user_id % 100) / 10 AS DOUBLE) AS latitude,
         CAST((-(user_id % 80)) / 10 AS DOUBLE) AS longitude,
         value AS temp, value + k AS pressure, CAST(k AS DOUBLE) AS humidity,
         CAST(k / 10 AS DOUBLE) AS windspeed, k * CAST(3.6 AS DOUBLE) AS winddirection,
         CAST(floor(epoch(ts)) AS BIGINT) AS time
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) e)"""

_COLUMNS = "id, location, latitude, longitude, temp, pressure, humidity, windspeed, winddirection, time"
_MEANS = (
    "avg(temp) AS temp, avg(humidity) AS humidity, avg(windspeed) AS windspeed, "
    "avg(winddirection) AS winddirection, avg(pressure) AS pressure, max(time) AS time"
)
_ROUNDED_MEANS = (
    "round(avg(temp), 6) AS temp, round(avg(humidity), 6) AS humidity, "
    "round(avg(windspeed), 6) AS windspeed, round(avg(winddirection), 6) AS winddirection, "
    "round(avg(pressure), 6) AS pressure, max(time) AS time"
)


def _date_text(seconds: str) -> str:
    return (
        f"strftime(make_timestamp({seconds} * 1000000), '%a %b %d %H:%M:%S') || ' UTC ' || "
        f"strftime(make_timestamp({seconds} * 1000000), '%Y')"
    )


def _resolved(name: str, where: str) -> str:
    """One latest-state row per id from the readings that satisfy the condition."""
    return f"""{name}_m AS (
  SELECT id, location, latitude, longitude, {_MEANS} FROM t WHERE {where}
  GROUP BY id, location, latitude, longitude),
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY time DESC, location, latitude, longitude) AS newest,
         row_number() OVER (PARTITION BY id ORDER BY time, location DESC, latitude DESC, longitude DESC) AS oldest
  FROM {name}_m),
{name} AS (
  SELECT n.id, o.location AS place,
         CAST(o.latitude AS VARCHAR) || ',' || CAST(o.longitude AS VARCHAR) AS location,
         n.windspeed, n.winddirection, n.pressure, n.humidity, n.temp AS temperature,
         {_date_text('n.time')} AS time
  FROM {name}_r n JOIN {name}_r o ON n.id = o.id AND n.newest = 1 AND o.oldest = 1)"""


_HALVES = f"{_resolved('cur', f'time < {SPLIT_SECOND}')}, {_resolved('nxt', f'time >= {SPLIT_SECOND}')}"
_STATE = (
    "round(windspeed, 6) AS windspeed, round(winddirection, 6) AS winddirection, "
    "round(pressure, 6) AS pressure, round(humidity, 6) AS humidity, round(temperature, 6) AS temperature"
)

_RAW = """SELECT CAST(id AS VARCHAR) AS id, CAST(day(make_timestamp(time * 1000000)) AS VARCHAR) AS date,
       time AS eventtime, humidity, pressure, temp AS temperature, winddirection, windspeed,
       strftime(make_timestamp(time * 1000000), '%Y-%m-%d') AS day"""

_RAW_BY_DAY = f"""WITH {_T}, sent AS (
  SELECT *, event_id AS arrival FROM t
  UNION ALL SELECT * REPLACE (temp + 1 AS temp), event_id + 1000000000000 AS arrival FROM t),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id, time ORDER BY arrival DESC) AS rn FROM sent)
{_RAW} FROM ranked WHERE rn = 1"""


def _unpivoted(columns: list[str], source: str, kind: str = "DOUBLE") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, CAST({c} AS {kind}) AS value FROM {source}" for c in columns
    )


_LINES = _unpivoted(LINE_MEASURES, "lineitem")
_NUMBERS = f"v AS ({_LINES} UNION ALL {_unpivoted(['value'], 'events')})"
_TEXTS = (
    f"v AS ({_unpivoted(['o_orderstatus', 'o_orderpriority'], 'orders', 'VARCHAR')} "
    f"UNION ALL {_unpivoted(['c_name', 'c_mktsegment'], 'customer', 'VARCHAR')})"
)
_SUMMARY = (
    "count(value) AS n, round(min(value), 6) AS minimum, round(max(value), 6) AS maximum, "
    "round(max(value) - min(value), 6) AS range, round(avg(value), 6) AS average, "
    "CAST(format('{:.7e}', var_pop(value)) AS DOUBLE) AS variance, round(stddev_pop(value), 6) AS stddev"
)


def _quartiles(values: str) -> str:
    """CTEs down to ``q``: the middle pairs of each field by 0-based rank."""
    return f"""ranked AS (
  SELECT field, value, row_number() OVER (PARTITION BY field ORDER BY value) - 1 AS r,
         count(*) OVER (PARTITION BY field) AS n FROM {values} WHERE value IS NOT NULL),
q AS (
  SELECT field, max(n) AS n,
         avg(value) FILTER (WHERE r IN ((n - 1) // 2, n // 2)) AS median,
         avg(value) FILTER (WHERE r IN ((n // 2 - 1) // 2, (n // 2) // 2)) AS q1,
         avg(value) FILTER (WHERE r IN (n // 2 + 1 + (n - n // 2 - 2) // 2,
                                        n // 2 + 1 + (n - n // 2 - 1) // 2)) AS q3
  FROM ranked GROUP BY field)"""


def _modes(values: str) -> str:
    """CTEs down to ``m``: distinct count and mode per field, smallest of ties."""
    return f"""f AS (SELECT field, value, count(*) AS n FROM {values} WHERE value IS NOT NULL GROUP BY field, value),
fr AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rn,
              count(*) OVER (PARTITION BY field) AS n_unique FROM f),
m AS (SELECT field, n_unique, n > 1 AS has_mode, CASE WHEN n > 1 THEN value END AS mode, n AS n_mode FROM fr WHERE rn = 1)"""


_MODE_VALUES = f"""v AS ({_LINES} UNION ALL {_unpivoted(['value'], 'events')}
UNION ALL {_unpivoted(['o_orderkey', 'o_totalprice'], 'orders')})"""


# Fixed value: the pattern of a numeric first cell, as in ``functions/numbers.py``.
_NUMERIC_TEXT = r"^[-+]?\d*\.*\d+E*[-+]?\d*$"
_EVENT_FIELDS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _kinds(columns: list[str], source: str, first_by: str, cast: bool = False) -> str:
    test = "TRY_CAST(first AS DOUBLE) IS NOT NULL" if cast else f"regexp_matches(first, '{_NUMERIC_TEXT}')"
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS field, arg_min(CAST({c} AS VARCHAR), {first_by}) AS first, count(*) AS n_rows,
  count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '') AS n_blank,
  count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> ''
                   AND TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE) IS NULL) AS bad FROM {source}"""
        for c in columns
    )
    return f"""SELECT field, CASE WHEN {test} THEN 'Numeric' ELSE 'String' END AS kind, n_rows, n_blank,
       CAST(CASE WHEN {test} THEN bad ELSE 0 END AS BIGINT) AS n_invalid FROM ({parts}) p"""


def _pair(x: str, y: str, source: str) -> str:
    return f"""SELECT '{x}' AS x, '{y}' AS y, count(*) AS n,
       CASE WHEN min({x}) = max({x}) OR min({y}) = max({y}) THEN NULL
            ELSE covar_pop(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE)) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)
       END AS r FROM {source}"""


_PEARSON = f"""WITH {_T}, l AS (SELECT *, CAST(1.5 AS DOUBLE) AS constant FROM lineitem), p AS (
{_pair('l_quantity', 'l_extendedprice', 'l')} UNION ALL {_pair('l_discount', 'l_tax', 'l')}
UNION ALL {_pair('l_quantity', 'constant', 'l')} UNION ALL {_pair('temp', 'pressure', 't')}
UNION ALL {_pair('windspeed', 'winddirection', 't')} UNION ALL {_pair('temp', 'time', 't')})
SELECT x, y, n, round(r, 6) AS r, CASE
  WHEN r IS NULL THEN NULL
  WHEN abs(round(r, 2)) < 0.20 THEN 'No or negligible relationship'
  ELSE (CASE WHEN abs(round(r, 2)) >= 0.70 THEN 'Very strong ' WHEN abs(round(r, 2)) >= 0.40 THEN 'Strong '
             WHEN abs(round(r, 2)) >= 0.30 THEN 'Moderate ' ELSE 'Weak ' END)
       || (CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END) || ' relationship' END AS strength
FROM p"""

_INFINITE = """i AS (SELECT CASE WHEN l_linenumber = 3 THEN 'inf'::DOUBLE ELSE l_extendedprice::DOUBLE END AS some_above,
  CASE WHEN l_linenumber = 3 THEN 'inf'::DOUBLE WHEN l_linenumber = 5 THEN '-inf'::DOUBLE ELSE l_extendedprice::DOUBLE END AS some_both,
  CASE WHEN l_linenumber < 3 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END AS all_infinite FROM lineitem)"""
_INFINITE_FIELDS = ["some_above", "some_both", "all_infinite"]
_HISTOGRAM = f"""WITH {_INFINITE}, v AS ({_LINES} UNION ALL {_unpivoted(['value'], 'events')}
  UNION ALL {_unpivoted(_INFINITE_FIELDS, 'i')}),
e AS (SELECT field, min(value) FILTER (WHERE isfinite(value)) AS mn, max(value) FILTER (WHERE isfinite(value)) AS mx,
  (mx - mn) / 10 AS w FROM v GROUP BY field),
b AS (SELECT v.field, CASE WHEN value = 'inf' THEN 10 WHEN value = '-inf' THEN -1
      ELSE {' + '.join(f'CAST(value > mn + {k} * w AS INTEGER)' for k in range(1, 10))} END AS bin
      FROM v JOIN e ON v.field = e.field WHERE value IS NOT NULL),
c AS (SELECT field, bin, count(*) AS n FROM b GROUP BY field, bin)
SELECT e.field, CAST(g.k AS INTEGER) AS bin, round(mn + g.k * w, 6) AS lo, round(mn + (g.k + 1) * w, 6) AS hi,
       CAST(mn + g.k * w AS VARCHAR) || '-' || CAST(mn + (g.k + 1) * w AS VARCHAR) AS label,
       coalesce(c.n, 0) AS n
FROM e CROSS JOIN range(10) g(k) LEFT JOIN c ON c.field = e.field AND c.bin = g.k
UNION ALL SELECT field, CAST(bin AS INTEGER), NULL, NULL, CASE WHEN bin < 0 THEN '-Infinity' ELSE 'Infinity' END, n
FROM c WHERE bin NOT BETWEEN 0 AND 9"""


def _named(value: str) -> tuple[str, str]:
    """A figure as the number and the text that JSON has for it."""
    return (
        f"CASE WHEN isfinite({value}) THEN round({value}, 6) END",
        f"CASE WHEN {value} = 'inf' THEN 'Infinity' WHEN {value} = '-inf' THEN '-Infinity' END",
    )


def _infinite_report() -> str:
    """Sums of infinite values are infinite or, of both signs, no number; so are their differences."""
    # SQL refuses to subtract infinite values in aggregates, so the rules are spelt out.
    both, some = "n_up > 0 AND n_down > 0", "n_up + n_down > 0"
    total = f"CASE WHEN {both} THEN 'nan' WHEN n_up > 0 THEN 'inf' WHEN n_down > 0 THEN '-inf' ELSE total / n END::DOUBLE"
    moment = f"CASE WHEN {some} THEN 'nan'::DOUBLE ELSE 0 END"
    metrics = {
        "Minimum": "low", "Maximum": "high", "Range": "high - low", "Average": total, "Median": "median", "First Quartile": "q1",
        "Third Quartile": "q3", "IQR": "q3 - q1", "Variance": moment, "Standard Deviation": moment, "Mode": "mode",
    }
    listed = " UNION ALL ".join(
        f"SELECT field, '{metric}' AS metric, {_named(f'({value})')[0]} AS number, {_named(f'({value})')[1]} AS text FROM s"
        for metric, value in metrics.items()
    )
    return f"""WITH {_INFINITE}, v AS ({_unpivoted(_INFINITE_FIELDS, 'i')}), {_quartiles('v')}, {_modes('v')},
s AS (SELECT field, count(value) AS n, min(value) AS low, max(value) AS high, count_if(value = 'inf') AS n_up,
  count_if(value = '-inf') AS n_down, sum(value) FILTER (WHERE isfinite(value)) AS total, any_value(median) AS median,
  any_value(q1) AS q1, any_value(q3) AS q3, any_value(mode) AS mode
  FROM v JOIN q USING (field) JOIN m USING (field) GROUP BY field)
{listed}"""


_WINDOW_MEANS = f"""WITH {_T}
SELECT (time // 60) * 60 AS window_start, (time // 60) * 60 + 60 AS window_end,
       id, location, latitude, longitude, {_ROUNDED_MEANS}
FROM t GROUP BY ALL"""

# A batch leaves out readings whose window ends no later than a minute before the newest reading of earlier batches.
_CLOSED_WINDOWS = f"""WITH {_T},
b AS (SELECT *, least({' + '.join(f'CAST(time >= {at} AS INTEGER)' for at in SPLIT_SECONDS)}
  + CAST(event_id % 7 = 3 AS INTEGER), 3) AS batch FROM t),
w AS (SELECT batch, max(max(time)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60 AS passed
  FROM b GROUP BY batch)
SELECT (time // 60) * 60 AS window_start, (time // 60) * 60 + 60 AS window_end,
       id, location, latitude, longitude, {_ROUNDED_MEANS}
FROM b JOIN w USING (batch) WHERE passed IS NULL OR (time // 60) * 60 + 60 > passed
GROUP BY ALL"""

_FLAT = f"""WITH {_T}
SELECT event_id, CAST(id + 1000 * i AS INTEGER) AS id, location, latitude, longitude, temp, pressure,
       humidity, windspeed, winddirection, time + 60 AS time, 1700000000 + event_id AS observed_at
FROM (SELECT *, unnest(range(event_id % 3 + 1)) AS i FROM t) x"""

def _four_batches() -> str:
    """The fold of four states: first place and position, newest measures that are not null."""
    bounds = ["-1", *map(str, SPLIT_SECONDS), "9223372036854775807"]
    parts = ", ".join(
        _resolved(f"s{k}", f"time >= {low} AND time < {high}") for k, (low, high) in enumerate(zip(bounds, bounds[1:]))
    )
    first = ", ".join(f"coalesce({', '.join(f's{k}.{c}' for k in range(4))}) AS {c}" for c in ("place", "location"))
    newest = ", ".join(
        f"coalesce({', '.join(f's{k}.{c}' for k in (3, 2, 1, 0))}) AS {c}"
        for c in ("windspeed", "winddirection", "pressure", "humidity", "temperature", "time")
    )
    ids = " UNION ".join(f"SELECT id FROM s{k}" for k in range(4))
    joins = " ".join(f"LEFT JOIN s{k} ON s{k}.id = ids.id" for k in range(4))
    return f"""WITH {_T}, {parts}, ids AS ({ids}),
folded AS (SELECT ids.id, {first}, {newest} FROM ids {joins})
SELECT id, place, location, {_STATE}, time FROM folded"""


def _report_rows(name: str, numbers: list[str], texts: list[str], source: str, **attributes: str) -> str:
    """The records of a report as source, field, metric, number, text; ``attributes`` are those of the table."""
    metrics = {
        "Minimum": "round(s.minimum, 6)", "Maximum": "round(s.maximum, 6)", "Range": "round(s.range, 6)",
        "Average": "round(s.average, 6)", "Variance": "s.variance", "Standard Deviation": "s.stddev",
        "Median": "round(q.median, 6)", "First Quartile": "round(q.q1, 6)", "Third Quartile": "round(q.q3, 6)",
        "IQR": "round(q.q3 - q.q1, 6)", "Mode": "round(m.mode, 6)",
    }
    listed = " UNION ALL ".join(
        f"SELECT s.field, '{metric}' AS metric, CAST({value} AS DOUBLE) AS number, "
        + ("CASE WHEN NOT has_mode THEN 'No Mode' END" if metric == "Mode" else "CAST(NULL AS VARCHAR)")
        + " AS text FROM s JOIN q ON q.field = s.field JOIN m ON m.field = s.field"
        for metric, value in metrics.items()
    )
    parts = [
        f"""SELECT '{name}' AS source, r.* FROM (WITH v AS ({_unpivoted(numbers, source)}), {_quartiles('v')}, {_modes('v')},
s AS (SELECT field, {_SUMMARY} FROM v GROUP BY field)
{listed} UNION ALL SELECT field, 'Type', NULL, 'Numeric' FROM s) r""",
        f"SELECT '{name}', NULL, 'No Of Fields', {float(len(numbers) + len(texts))}, NULL",
        *[f"SELECT '{name}', NULL, '{k}', NULL, '{v}'" for k, v in (attributes or {"filetype": "TABLE"}).items()],
    ]
    if texts:
        parts.append(f"""SELECT '{name}', r.* FROM (WITH v AS ({_unpivoted(texts, source, 'VARCHAR')}), {_modes('v')}
SELECT field, 'Mode', NULL, coalesce(mode, 'No Mode') FROM m
UNION ALL SELECT field, 'NumUniqueValues', CAST(n_unique AS DOUBLE), NULL FROM m
UNION ALL SELECT field, 'Type', NULL, 'String' FROM m) r""")
    return " UNION ALL ".join(parts)


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *LINE_MEASURES]
_LINE_TEXTS = ["l_returnflag", "l_linestatus", "l_shipdate"]
_REPORT = f"""{_report_rows('lineitem', _LINE_NUMBERS, _LINE_TEXTS, 'lineitem')}
UNION ALL {_report_rows('orders', ['o_orderkey', 'o_custkey', 'o_totalprice'],
                        ['o_orderstatus', 'o_orderdate', 'o_orderpriority'], 'orders')}
UNION ALL {_report_rows('pair', ['l_quantity', 'l_extendedprice'], [], 'lineitem')}
UNION ALL SELECT 'pair', NULL, 'Pearsons CC (l_quantity Vs l_extendedprice)',
    round(corr(CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE)), 6), NULL FROM lineitem"""

_SETTINGS = _report_rows(
    "orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"], "orders",
    filetype="CSV", FieldSeparator=";", HeaderPresent="True",
)

_DAMAGED = """WITH o AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders)
SELECT 'json' AS source, count(*) FILTER (WHERE k % 7 = 4) AS n_malformed, count(*) FILTER (WHERE k % 7 = 4 OR p IS NULL) AS n_blank,
       CAST(0 AS BIGINT) AS n_invalid, CAST(0 AS BIGINT) AS n_nan, count(p) FILTER (WHERE k % 7 <> 4) AS n FROM o
UNION ALL
SELECT 'csv', count(*) FILTER (WHERE k % 5 IN (3, 4)), count(*) FILTER (WHERE k % 5 = 3),
       count(*) FILTER (WHERE k % 5 <> 3 AND k % 11 <> 5 AND k % 13 = 6),
       count(*) FILTER (WHERE k % 5 <> 3 AND k % 11 = 5),
       count(*) FILTER (WHERE k % 5 <> 3 AND k % 11 <> 5 AND k % 13 <> 6) FROM o"""


_KEPT = "SELECT 'raw' AS kept_as, CAST(id AS VARCHAR) AS id, time AS at, temp AS temperature, humidity, pressure"


def _acquired(batches: int, columns: str = _RAW) -> str:
    """The last batch that has a station and second counts, and its last reading of them."""
    return f"""WITH flat AS ({_FLAT}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id, time ORDER BY event_id % {batches} DESC, observed_at DESC) AS rn FROM flat)
{columns} FROM ranked WHERE rn = 1"""


SQL: dict[str, str] = {
    "stream_latest_state_batches": _four_batches(),
    "stream_acquire_messages": f"""WITH flat AS ({_FLAT})
SELECT CAST(id AS VARCHAR) AS key, {_COLUMNS} FROM flat""",
    "landed_responses": f"""WITH flat AS ({_FLAT}) SELECT * EXCLUDE (event_id) REPLACE (CAST(0 AS BIGINT) AS time) FROM flat""",
    "raw_file_order": f"""WITH {_T}, one AS (SELECT DISTINCT id, time FROM t)
SELECT strftime(make_timestamp(time * 1000000), '%Y-%m-%d') AS day, count(*) AS n, CAST(0 AS BIGINT) AS n_inverted FROM one GROUP BY 1""",
    "headerless_names": """SELECT CAST(l_orderkey AS VARCHAR) AS "order", CAST(l_quantity AS DOUBLE) AS var1, CAST(l_extendedprice AS DOUBLE) AS price,
       CAST(l_discount AS DOUBLE) AS var3, CAST(l_tax AS DOUBLE) AS var4 FROM lineitem""",
    "profile_damaged": _DAMAGED,
    "stream_restart": f"""{_acquired(3, _KEPT)}
UNION ALL SELECT 'message', CAST(id AS VARCHAR), time, temp, humidity, pressure FROM flat""",
    "stream_progress": """SELECT CAST(k AS BIGINT) AS batch_id, count(event_id) AS rows, count(event_id) = 0 AS idle,
       CAST(0 AS BIGINT) AS late, true AS timed FROM range(4) b(k) LEFT JOIN events ON event_id % 3 = k GROUP BY k""",
    "profile_settings": _SETTINGS,
    "profile_infinite": _infinite_report(),
    "profile_report": _REPORT,
    "station_means": f"""WITH {_T} SELECT id, location, latitude, longitude, {_ROUNDED_MEANS}
FROM t GROUP BY id, location, latitude, longitude""",
    "station_means_sql": f"""WITH {_T} SELECT id, round(avg(temp), 6) AS temp, round(avg(humidity), 6) AS humidity,
       round(avg(winddirection), 6) AS winddirection, round(avg(windspeed), 6) AS windspeed FROM t GROUP BY id""",
    "keyed_mean": """SELECT event_type AS key, round(avg(CAST(json_extract(props, '$.k') AS INTEGER)), 6) AS mean
FROM events GROUP BY event_type""",
    "window_means": _WINDOW_MEANS,
    "stream_window_means": _WINDOW_MEANS,
    "stream_closed_windows": _CLOSED_WINDOWS,
    "stream_latest_state": f"WITH {_T}, {_resolved('cur', 'true')} SELECT id, place, location, {_STATE}, time FROM cur",
    "stream_acquire_raw": _acquired(1),
    "stream_acquire_raw_batches": _acquired(3),
    "telegram_parse": f"WITH {_T} SELECT {_COLUMNS} FROM t",
    "telegram_quarantine": f"""WITH {_T}
SELECT 'malformed' AS rejected, CAST(id AS VARCHAR) AS id, location, '' AS time FROM t
UNION ALL SELECT 'no id', '', location, CAST(time AS VARCHAR) FROM t""",
    "telegram_serialize": f"WITH {_T} SELECT CAST(id AS VARCHAR) AS key, 10 AS n_keys, {_COLUMNS} FROM t",
    "response_flatten": _FLAT,
    "response_envelope": """SELECT event_id, 200 AS cod, (event_id % 3 + 1) / 1000 AS calctime,
       CAST(event_id % 3 + 1 AS INTEGER) AS cnt, CAST(event_id % 3 + 1 AS INTEGER) AS n_stations FROM events""",
    "bbox_filter": f"""WITH {_T} SELECT event_id, {_COLUMNS} FROM t
WHERE longitude BETWEEN {BOX[0]} AND {BOX[2]} AND latitude BETWEEN {BOX[1]} AND {BOX[3]}""",
    "csv_reading_parse": f"WITH {_T} SELECT event_id, location AS city, time, temp AS value FROM t",
    "date_render": f"WITH {_T} SELECT event_id, {_date_text('time')} AS date_text FROM t",
    "upsert_classify": f"""WITH {_T}, {_HALVES}
SELECT nxt.id, CASE WHEN cur.id IS NULL THEN 'insert' ELSE 'update' END AS action
FROM nxt LEFT JOIN cur ON cur.id = nxt.id""",
    "station_upsert": f"""WITH {_T}, {_HALVES}, s AS (
  SELECT coalesce(cur.id, nxt.id) AS id, coalesce(cur.place, nxt.place) AS place,
         coalesce(cur.location, nxt.location) AS location, coalesce(nxt.windspeed, cur.windspeed) AS windspeed,
         coalesce(nxt.winddirection, cur.winddirection) AS winddirection,
         coalesce(nxt.pressure, cur.pressure) AS pressure, coalesce(nxt.humidity, cur.humidity) AS humidity,
         coalesce(nxt.temperature, cur.temperature) AS temperature, coalesce(nxt.time, cur.time) AS time
  FROM cur FULL JOIN nxt ON cur.id = nxt.id)
SELECT id, place, location, {_STATE}, time FROM s""",
    "raw_by_day": _RAW_BY_DAY,
    "raw_by_day_store": _RAW_BY_DAY,
    "field_types": _kinds(_EVENT_FIELDS, "events", "event_id"),
    "field_types_cast": _kinds(_EVENT_FIELDS, "events", "event_id", cast=True),
    "field_type_counts": f"""SELECT count(*) AS n_fields, count(*) FILTER (WHERE kind = 'Numeric') AS n_numeric,
       count(*) FILTER (WHERE kind = 'String') AS n_string
FROM ({_kinds(_ORDER_FIELDS, 'orders', 'o_orderkey')}) k""",
    "numeric_profile": f"SELECT field, {_SUMMARY} FROM ({_LINES}) v GROUP BY field",
    "numeric_quartiles": f"""WITH {_NUMBERS}, {_quartiles('v')}
SELECT field, n, round(median, 6) AS median, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr FROM q""",
    "mode_or_none": f"""WITH {_MODE_VALUES}, {_modes('v')}
SELECT field, (SELECT count(value) FROM v WHERE v.field = m.field) AS n, n_unique, has_mode, mode, n_mode FROM m""",
    "numeric_distinct": f"WITH {_MODE_VALUES}, {_modes('v')} SELECT field, n_unique, has_mode, mode FROM m",
    "string_profile": f"""WITH {_TEXTS}, {_modes('v')}
SELECT m.field, n_unique, has_mode, mode,
 FROM m""".replace("mode,\n FROM", "mode FROM"),
    "distinct_values": f"WITH {_TEXTS} SELECT DISTINCT field, value FROM v WHERE value IS NOT NULL",
    "discrete_histogram": f"""WITH v AS ({_unpivoted(['l_returnflag', 'l_linestatus'], 'lineitem', 'VARCHAR')}
UNION ALL {_unpivoted(['event_type'], 'events', 'VARCHAR')})
SELECT field, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY field, value""",
    "histogram10": _HISTOGRAM,
    "pearson": _PEARSON,
    "blank_zero": f"""WITH c AS (SELECT CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 10 THEN ' '
       ELSE CAST(value AS VARCHAR) END AS cell FROM events),
v AS (SELECT 'blank_as_zero' AS field, CASE WHEN trim(cell) = '' THEN 0 ELSE TRY_CAST(cell AS DOUBLE) END AS value FROM c
      UNION ALL SELECT 'blank_skipped' AS field, TRY_CAST(nullif(trim(cell), '') AS DOUBLE) AS value FROM c)
SELECT field, {_SUMMARY} FROM v GROUP BY field""",
    "nested_text": """SELECT event_id, '{"k":' || CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR) || '}' AS props
FROM events""",
    "nul_scan": "SELECT count(*) FILTER (WHERE contains(text, chr(0))) AS n_nul FROM documents",
    "profile_csv_file": f"""WITH v AS ({_LINES}), {_quartiles('v')}, {_modes('v')},
s AS (SELECT field, {_SUMMARY} FROM v GROUP BY field)
SELECT s.*, round(median, 6) AS median, round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       n_unique, has_mode, round(mode, 6) AS mode
FROM s JOIN q ON q.field = s.field JOIN m ON m.field = s.field""",
    "profile_json_file": f"""WITH v AS ({_unpivoted(['o_orderkey', 'o_totalprice'], 'orders')}), {_quartiles('v')}, {_modes('v')},
s AS (SELECT field, {_SUMMARY} FROM v GROUP BY field),
tv AS ({_unpivoted(['o_orderstatus', 'o_orderpriority'], 'orders', 'VARCHAR')}),
tf AS (SELECT field, value, count(*) AS n FROM tv GROUP BY field, value),
tr AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS rn,
              count(*) OVER (PARTITION BY field) AS n_unique FROM tf)
SELECT s.field, n_unique, has_mode, round(mode, 6) AS mode, minimum, maximum, average, round(median, 6) AS median,
       CAST(NULL AS VARCHAR) AS text_mode
FROM s JOIN q ON q.field = s.field JOIN m ON m.field = s.field
UNION ALL
SELECT field, n_unique, n > 1 AS has_mode, NULL, NULL, NULL, NULL, NULL, CASE WHEN n > 1 THEN value END
FROM tr WHERE rn = 1""",
}
