"""Exact median and quartiles without sorting or shuffling the rows.

Each wanted rank is narrowed down by scans that send only small aggregates over the
network:

1. a quantile sketch of every column (merged as a tree) proposes pivot values;
2. one pass counts, exactly, the values below and up to each pivot; a rank then either
   is a pivot or lies in the open interval between two of them;
3. an interval that still holds many values is sketched and split again; one that holds
   few is sorted, and the wanted values are read off.

Sketches only propose where to cut: every decision rests on exact counts, so the result
is exact for any data. A value that fills an interval becomes a pivot and is settled by
its count, so ties end the search sooner. An interval loses about two orders of
magnitude per round; 10^13 rows need five.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from isobar.functions.sql import number
from isobar.operators.numeric import as_doubles, chunks, numeric_columns
from isobar.operators.partials import Partial

# An interval with at most this many values is sorted inside one aggregate buffer.
SORTED_VALUES = 20_000

# Scans that run at the same time.
CHUNKS_AT_ONCE = 4

SPLITS = 256
SKETCH_K = 1024
# Sketches are merged in this many groups before the final merge.
MERGE_GROUPS = 64
# Columns per scan; bounds the number of aggregates and the buffers of the final sort.
COLUMNS_PER_SCAN = 4

RANKS = ", ".join(number(i / SPLITS) for i in range(SPLITS + 1))
#: Proposed pivots of ``s``, for a pass that several operators share.
QUANTILES = (
    Partial("n_s", "count(s)", "sum(n_s)"),
    Partial(
        "splits", f"kll_sketch_agg_double(s, {SKETCH_K})",
        f"if(sum(n_s) > 0, kll_sketch_get_quantile_double(kll_merge_agg_double(splits), array({RANKS})), NULL)",
    ),
)

SCHEMA = "field string, n bigint, median double, q1 double, q3 double, iqr double"


def median_ranks(start: int, n: int) -> tuple[int, int] | None:
    """The two 0-based ranks whose mean is the median of ``n`` values from ``start``."""
    return (start + (n - 1) // 2, start + n // 2) if n > 0 else None


def quartile_ranks(n: int) -> dict[str, tuple[int, int] | None]:
    """Ranks for the median, for the median of the lower half, and for the median of
    what follows position n//2 (which for even n leaves out one upper value)."""
    half = n // 2
    return {
        "median": median_ranks(0, n),
        "q1": median_ranks(0, half),
        "q3": median_ranks(half + 1, n - half - 1),
    }


@dataclass
class Interval:
    """Values of a column strictly between two bounds, ``below`` values precede them."""

    column: str
    lo: float | None
    hi: float | None
    below: int
    size: int
    ranks: set[int] = field(default_factory=set)
    splits: list[float] = field(default_factory=list)

    def inside(self) -> str:
        tests = [f"{self.column} IS NOT NULL"]
        if self.lo is not None:
            tests.append(f"{self.column} > {number(self.lo)}")
        if self.hi is not None:
            tests.append(f"{self.column} < {number(self.hi)}")
        return f"({' AND '.join(tests)})"

    def pivots(self) -> list[float]:
        """Split values on both sides of the wanted ranks, beyond the sketch's error."""
        near = set()
        for rank in self.ranks:
            at = (rank - self.below) * SPLITS // self.size
            near |= {self.splits[max(at - 1, 0)], self.splits[min(at + 2, SPLITS)]}
        return sorted(near)


def order_statistics(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(field, n, median, q1, q3, iqr)`` per numeric column.

    Runs its scans when called; the result is one local row per column. Quartiles are
    null when their part of the values is empty.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    parts = list(chunks(columns, COLUMNS_PER_SCAN))
    # Groups of columns don't wait for each other.
    with ThreadPoolExecutor(min(len(parts), CHUNKS_AT_ONCE) or 1) as pool:
        found = pool.map(lambda part: _order_statistics(as_doubles(df, part), part), parts)
        rows = [row for part in found for row in part]
    return df.sparkSession.createDataFrame(rows, SCHEMA)


def _order_statistics(df: DataFrame, names: list[str]) -> list[tuple]:
    whole = [Interval(c, None, None, 0, 0) for c in df.columns]
    _sketch(df, whole)
    for iv in whole:
        iv.ranks = wanted_ranks(iv.size)
    found = select_ranks(df, [iv for iv in whole if iv.ranks])
    return [(name, iv.size, *quartiles(found, iv.column, iv.size)) for name, iv in zip(names, whole)]


def wanted_ranks(n: int) -> set[int]:
    return {r for pair in quartile_ranks(n).values() if pair for r in pair}


def quartiles(found: dict[tuple[str, int], float], column: str, n: int) -> tuple[float | None, ...]:
    """Median, quartiles and their distance from the values at the wanted ranks."""
    median, q1, q3 = (
        (found[column, pair[0]] + found[column, pair[1]]) / 2.0 if pair else None for pair in quartile_ranks(n).values()
    )
    return median, q1, q3, None if q1 is None or q3 is None else q3 - q1


def select_ranks(df: DataFrame, intervals: list[Interval]) -> dict[tuple[str, int], float]:
    """Value at every wanted rank. Whole-column intervals carry their splits."""
    found: dict[tuple[str, int], float] = {}
    while intervals:
        small = [iv for iv in intervals if iv.size <= SORTED_VALUES]
        large = [iv for iv in intervals if iv.size > SORTED_VALUES]
        if small:
            found.update(_read_off(df, small))
        unsplit = [iv for iv in large if not iv.splits]
        if unsplit:
            _sketch(df, unsplit)
        intervals = _split(df, large, found) if large else []
    return found


def _rows_of(df: DataFrame, intervals: list[Interval]) -> DataFrame:
    """Rows with a value in any of the intervals; reaches the scan as a filter."""
    if any(iv.lo is None and iv.hi is None for iv in intervals):
        return df
    return df.filter(" OR ".join(iv.inside() for iv in intervals))


def _sketch(df: DataFrame, intervals: list[Interval]) -> None:
    """Fill in size and splits of the intervals."""
    at = f"array({RANKS})"
    partial, total, result = [], [], []
    for i, iv in enumerate(intervals):
        value = f"if({iv.inside()}, {iv.column}, NULL)"
        partial += [f"kll_sketch_agg_double({value}, {SKETCH_K}) AS s{i}", f"count({value}) AS n{i}"]
        total += [f"kll_merge_agg_double(s{i}) AS s{i}", f"sum(n{i}) AS n{i}"]
        result += [f"coalesce(n{i}, 0L)", f"if(n{i} > 0, kll_sketch_get_quantile_double(s{i}, {at}), NULL)"]
    row = (
        _rows_of(df, intervals)
        .groupBy((F.spark_partition_id() % MERGE_GROUPS).alias("merge_group"))
        .agg(*map(F.expr, partial))
        .selectExpr(*total)
        .selectExpr(*result)
        .head()
    )
    for i, iv in enumerate(intervals):
        iv.size, iv.splits = row[2 * i], row[2 * i + 1] or []


def _split(df: DataFrame, intervals: list[Interval], found: dict) -> list[Interval]:
    """Count around the pivots; settle ranks that hit one, narrow the others."""
    pivots = [iv.pivots() for iv in intervals]
    counts = [
        f"array({', '.join(_counts_around(iv, p) for p in values)})" for iv, values in zip(intervals, pivots)
    ]
    counted = _rows_of(df, intervals).selectExpr(*counts).head()
    return settle(intervals, pivots, counted, found)


def settle(
    intervals: list[Interval], pivots: list[list[float]], counted: Sequence[Sequence[tuple[int, int]]], found: dict
) -> list[Interval]:
    """What is left of the intervals once the values below and up to each pivot are counted; ranks that
    hit a pivot go into ``found``."""
    narrowed: dict[tuple, Interval] = {}
    for iv, values, around in zip(intervals, pivots, counted):
        for rank in iv.ranks:
            lo, hi, below, end = iv.lo, iv.hi, iv.below, iv.below + iv.size
            hit = False
            for p, (smaller, up_to) in zip(values, around):
                first, past = iv.below + smaller, iv.below + up_to
                if rank < first:
                    hi, end = p, first
                    break
                if rank < past:
                    found[iv.column, rank], hit = p, True
                    break
                lo, below = p, past
            if not hit:
                part = Interval(iv.column, lo, hi, below, end - below)
                narrowed.setdefault((iv.column, lo, hi), part).ranks.add(rank)
    return list(narrowed.values())


def _counts_around(iv: Interval, pivot: float) -> str:
    """How many values of the interval are smaller than the pivot, and how many not larger."""
    floor = "" if iv.lo is None else f"{iv.column} > {number(iv.lo)} AND "
    smaller, up_to = (
        f"count(if({floor}{iv.column} {sign} {number(pivot)}, 1, NULL))" for sign in ("<", "<=")
    )
    return f"struct({smaller} AS smaller, {up_to} AS up_to)"


def _read_off(df: DataFrame, intervals: list[Interval]) -> dict[tuple[str, int], float]:
    """Sort the few values of each interval and take the wanted ones."""
    gathered, picked, keys = [], [], []
    for i, iv in enumerate(intervals):
        gathered.append(f"sort_array(collect_list({iv.column}) FILTER (WHERE {iv.inside()})) AS v{i}")
        for rank in sorted(iv.ranks):
            picked.append(f"element_at(v{i}, {rank - iv.below + 1})")
            keys.append((iv.column, rank))
    row = _rows_of(df, intervals).selectExpr(*gathered).selectExpr(*picked).head()
    return dict(zip(keys, row))
