"""Moments, extremes, quartiles, modes, histograms and correlations of many numeric columns in three scans.

1. One pass over all columns and pairs runs the aggregates that the operators hand in: moments, the finite range,
   quantile and frequency sketches, co-moments.
2. One pass counts, exactly, what the first proposed: where a value lies among the bin edges and the pivots of its
   column, and which proposed mode it is. A value is joined with its column's one row of bounds.
3. One pass sorts the few values of each interval that still holds a wanted rank.

An interval that is still too long is narrowed by ``orderstats``, and a mode that the sketch cannot decide is
found by ``exactmode``; both scan just the columns concerned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from isobar.operators import exactmode, orderstats
from isobar.operators.correlation import COMOMENTS, R
from isobar.operators.exactmode import FREQUENT, Mode
from isobar.operators.histogram import ABOVE, BELOW, BINS, FINITE, SCHEMA as BIN_SCHEMA, edges
from isobar.operators.numeric import MOMENTS, as_doubles
from isobar.operators.orderstats import QUANTILES, Interval
from isobar.operators.partials import gathered, long_form
from isobar.functions.strength import strength

#: Pivots of a column: two on either side of each of at most six ranks.
PIVOTS = 12
RECORDS = (
    "field string, n bigint, minimum double, maximum double, range double, average double, variance double, stddev double, "
    "median double, q1 double, q3 double, iqr double, has_mode boolean, mode double"
)
PAIRS = "x string, y string, n bigint, r double"


@dataclass(frozen=True)
class NumberProfile:
    """Local tables: ``records`` and ``histograms`` by field, ``correlations`` by pair."""

    records: DataFrame
    histograms: DataFrame
    correlations: DataFrame


def profile_numbers(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]] = ()) -> NumberProfile:
    """Runs its scans when called; what comes back is one row for each column, bin and pair. Columns that
    are in ``pairs`` need not be in ``columns``."""
    spark = df.sparkSession
    names = list(dict.fromkeys([*columns, *(c for pair in pairs for c in pair)]))
    doubles = as_doubles(df, names)
    at = dict(zip(names, doubles.columns, strict=True))
    own, own_pairs = [at[c] for c in columns], [(at[x], at[y]) for x, y in pairs]
    first = {}
    if own or own_pairs:
        partials = [*MOMENTS, *FINITE, *QUANTILES, FREQUENT, *(COMOMENTS if pairs else ())]
        merged = gathered(long_form(doubles, own, own_pairs), partials)
        first = {r["id"]: r for r in merged.withColumn("r", F.expr(R if pairs else "CAST(NULL AS DOUBLE)")).collect()}
    seen = {k: first[k] for k in range(len(columns)) if k in first and first[k]["n"]}

    intervals = {k: Interval(own[k], None, None, 0, r["n"], splits=r["splits"]) for k, r in seen.items()}
    for iv in intervals.values():
        iv.ranks = orderstats.wanted_ranks(iv.size)
    pivots = {k: iv.pivots() for k, iv in intervals.items()}
    proposed = {k: exactmode.proposals(r["frequent"], r["n"]) for k, r in seen.items()}
    rows = long_form(doubles, own) if seen else None
    cells = _cells(rows, {k: (edges(r["least"], r["most"]), pivots[k], proposed[k][0]) for k, r in seen.items()}) if seen else {}

    found = _ranks(doubles, rows, intervals, pivots, cells)
    modes = _modes(doubles, own, proposed, cells, {k: r["n"] for k, r in seen.items()})
    records = []
    for k, name in enumerate(columns):
        if k not in seen:
            records.append((name, 0, *[None] * 10, False, None))
            continue
        r = seen[k]
        variance = r["spread"] / r["n"]
        records.append(
            (name, r["n"], r["low"], r["high"], r["high"] - r["low"], r["total"] / r["n"], variance, math.sqrt(variance),
             *orderstats.quartiles(found, own[k], r["n"]), *modes[k].record())
        )
    bins = [row for k, name in enumerate(columns) for row in _bins(name, seen.get(k), cells.get(k, {}))]
    related = [
        (x, y, first[k]["n"] if k in first else 0, first[k]["r"] if k in first else None)
        for k, (x, y) in enumerate(pairs, len(columns))
    ]
    correlations = spark.createDataFrame(related, PAIRS).selectExpr("*", f"{strength('r')} AS strength")
    histograms = spark.createDataFrame(bins, BIN_SCHEMA.replace("label string, ", "")).selectExpr(
        "field", "bin", "lo", "hi",
        f"CASE bin WHEN {BELOW[0]} THEN '{BELOW[1]}' WHEN {ABOVE[0]} THEN '{ABOVE[1]}' "
        "ELSE concat(CAST(lo AS STRING), '-', CAST(hi AS STRING)) END AS label", "n",
    )
    return NumberProfile(spark.createDataFrame(records, RECORDS), histograms, correlations)


Cells = dict[tuple[int, int, int], int]


def _cells(rows: DataFrame, bounds: dict[int, tuple[list, list[float], list[float]]]) -> dict[int, Cells]:
    """Per column the number of values by (bin, place among the pivots, proposed value).

    Place 2j is below the j-th pivot, 2j + 1 is the pivot itself; the proposed values count from 1, and 0 is none.
    """
    # No column of the bounds is null, and each search takes a few comparisons: with more, the loop over the rows
    # gets too long for the JVM to compile.
    edged, pivot, frequent = ([f"{name}{k}" for k in range(n)] for name, n in (("e", BINS - 1), ("p", PIVOTS), ("m", exactmode.PROPOSED)))
    fields = [T.StructField("id", T.IntegerType(), False)]
    fields += [T.StructField(name, T.DoubleType(), False) for name in (*edged, *pivot, *frequent)]
    order = {k: sorted(range(len(values)), key=values.__getitem__) for k, (_, _, values) in bounds.items()}
    table = [
        (k, *_padded([e for e in edge[1:BINS] if e is not None], len(edged)), *_padded(pivots, len(pivot)),
         *_padded([values[j] for j in order[k]], len(frequent)))
        for k, (edge, pivots, values) in bounds.items()
    ]
    bounded = rows.where("x IS NOT NULL").join(F.broadcast(rows.sparkSession.createDataFrame(table, T.StructType(fields))), "id")
    counted = bounded.selectExpr(
        "id",
        f"CASE WHEN x = double('Infinity') THEN {ABOVE[0]} WHEN x = double('-Infinity') THEN {BELOW[0]} "
        f"ELSE {_search(edged, str)} END AS bin",
        f"{_search(pivot, lambda k: str(2 * k), lambda k: str(2 * k + 1))} AS place",
        f"{_search(frequent, lambda _: '0', lambda k: str(k + 1))} AS mode",
    ).groupBy("id", "bin", "place", "mode").agg(F.count(F.lit(1)).alias("n"))
    out: dict[int, Cells] = {k: {} for k in bounds}
    for r in counted.collect():
        mode = order[r["id"]][r["mode"] - 1] + 1 if r["mode"] else 0
        out[r["id"]][r["bin"], r["place"], mode] = r["n"]
    return out


def _padded(bounds: Sequence[float], width: int) -> list[float]:
    """Ascending bounds, and behind them what no number is above or equal to."""
    return [*bounds, *[float("nan")] * (width - len(bounds))]


def _search(bounds: Sequence[str], between: Callable[[int], str], at: Callable[[int], str] | None = None) -> str:
    """SQL for where ``x`` lies among ascending bounds, found by halves: ``between`` is given the number of bounds
    below it and ``at``, if there is one, the place of the bound that it equals."""

    def part(low: int, high: int) -> str:
        if low == high:
            return between(low)
        k = (low + high) // 2
        smaller = part(low, k)
        rest = f"if(x = {bounds[k]}, {at(k)}, {smaller})" if at else smaller
        return f"if(x > {bounds[k]}, {part(k + 1, high)}, {rest})"

    return part(0, len(bounds))


def _summed(cells: Cells, part: int) -> dict[int, int]:
    out: dict[int, int] = {}
    for key, n in cells.items():
        out[key[part]] = out.get(key[part], 0) + n
    return out


def _bins(name: str, row, cells: Cells) -> list[tuple]:
    at = edges(row["least"], row["most"]) if row else edges(None, None)
    n = _summed(cells, 0)
    out = [(name, k, at[k], at[k + 1], n.get(k, 0)) for k in range(BINS)]
    return out + [(name, k, None, None, n[k]) for k, _ in (BELOW, ABOVE) if k in n]


def _ranks(
    doubles: DataFrame, rows: DataFrame | None, intervals: dict[int, Interval], pivots: dict[int, list[float]],
    cells: dict[int, Cells],
) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks by (column, rank)."""
    found: dict[tuple[str, int], float] = {}
    around = []
    for k in intervals:
        places = _summed(cells[k], 1)
        up_to = [sum(n for p, n in places.items() if p <= place) for place in range(2 * len(pivots[k]))]
        around.append(list(zip(up_to[::2], up_to[1::2], strict=True)))
    left = orderstats.settle(list(intervals.values()), [pivots[k] for k in intervals], around, found)
    number_of = {iv.column: k for k, iv in intervals.items()}
    few = [iv for iv in left if iv.size <= orderstats.SORTED_VALUES]
    if few:
        found |= _read_off(rows, [(number_of[iv.column], iv) for iv in few])
    many: dict[str, list[Interval]] = {}
    for iv in left:
        if iv.size > orderstats.SORTED_VALUES:
            many.setdefault(iv.column, []).append(iv)
    for column, own in many.items():
        found |= orderstats.select_ranks(doubles.select(column), own)
    return found


def _read_off(rows: DataFrame, intervals: list[tuple[int, Interval]]) -> dict[tuple[str, int], float]:
    """Sort the few values of each interval, each in a group of its own, and take the wanted ones."""
    wanted = [
        (k, n, iv.lo, iv.hi, [rank - iv.below + 1 for rank in sorted(iv.ranks)]) for n, (k, iv) in enumerate(intervals)
    ]
    table = rows.sparkSession.createDataFrame(wanted, "id int, interval int, lo double, hi double, places array<int>")
    inside = rows.join(F.broadcast(table), "id").where("(lo IS NULL OR x > lo) AND (hi IS NULL OR x < hi)")
    picked = inside.groupBy("interval").agg(
        F.expr("sort_array(collect_list(x))").alias("v"), F.first("places").alias("places")
    ).selectExpr("interval", "transform(places, p -> element_at(v, p)) AS picked")
    out = {}
    for r in picked.collect():
        iv = intervals[r["interval"]][1]
        out |= {(iv.column, rank): v for rank, v in zip(sorted(iv.ranks), r["picked"], strict=True)}
    return out


def _modes(
    doubles: DataFrame, columns: list[str], proposed: dict[int, tuple[list[float], int]], cells: dict[int, Cells], n: dict[int, int]
) -> dict[int, Mode]:
    out: dict[int, Mode | None] = {}
    for k, (values, others) in proposed.items():
        by_value = _summed(cells[k], 2)
        out[k] = exactmode.decided({v: by_value.get(j, 0) for j, v in enumerate(values, 1)}, others, n[k])
    open_ = [k for k, mode in out.items() if mode is None]
    if open_:
        # Numbered anew: only these columns are read.
        rows = long_form(doubles, [columns[k] for k in open_])
        found = exactmode.by_slots(rows, {j: n[k] for j, k in enumerate(open_)})
        out |= {k: found[j] for j, k in enumerate(open_)}
    return out
