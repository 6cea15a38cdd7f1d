"""Ten equal-width bins per numeric field."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

from isobar.functions.sql import number, text
from isobar.operators.numeric import as_doubles, chunks, numeric_columns, stacked
from isobar.operators.partials import Partial

BINS = 10
INFINITE = "double('Infinity')"
#: Bins of infinite values, and their labels.
BELOW, ABOVE = (-1, "-Infinity"), (BINS, "Infinity")
SCHEMA = "field string, bin int, lo double, hi double, label string, n bigint"

#: The finite range of ``x``, for a pass that several operators share.
FINITE = (
    Partial("least", f"min(if(abs(x) < {INFINITE}, x, NULL))", "min(least)"),
    Partial("most", f"max(if(abs(x) < {INFINITE}, x, NULL))", "max(most)"),
)


def histogram10(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(field, bin, lo, hi, label, n)`` for bins over the range of the field's finite values.

    Bin 0 holds both its ends, the others only their upper end; the last ends at the
    maximum. When all values are equal they fall into bin 0. Infinite values are counted
    apart, without ends, as bins -1 and 10, which are only there if such values are. Two passes: the range of
    every column, then for all columns together the number of values above each edge.
    Neither shuffles rows.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    return stacked([_histogram(as_doubles(df, part), part) for part in chunks(columns)])


def edges(low: float | None, high: float | None) -> list[float | None]:
    if low is None or high is None:
        return [None] * (BINS + 1)
    width = (high - low) / BINS
    if math.isinf(width):
        return [low * (1 - k / BINS) + high * (k / BINS) for k in range(BINS + 1)]
    return [low + k * width for k in range(BINS + 1)]


def _histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    finite = df.selectExpr(
        *[f"if(abs({c}) < {INFINITE}, {c}, NULL) AS {c}" for c in df.columns],
        *[f"if(abs({c}) < {INFINITE}, NULL, {c}) AS i{c}" for c in df.columns],
    )
    ranges = finite.selectExpr(*[f"struct(min({c}), max({c})) AS {c}" for c in df.columns]).head()
    above, records = [], []
    for i, name in enumerate(columns):
        at = edges(*ranges[i])
        over = [f"count(c{i})"]
        over += [f"count(if(c{i} > {number(at[k])}, 1, NULL))" for k in range(1, BINS)]
        above += [
            f"array({', '.join(over)}, 0L) AS over{i}",
            f"array(count(if(ic{i} < 0, 1, NULL)), count(if(ic{i} > 0, 1, NULL))) AS infinite{i}",
        ]
        records += [
            f"struct({text(name)} AS field, {k} AS bin, {number(at[k])} AS lo, {number(at[k + 1])} AS hi, "
            f"concat(CAST({number(at[k])} AS STRING), '-', CAST({number(at[k + 1])} AS STRING)) AS label, "
            f"over{i}[{k}] - over{i}[{k + 1}] AS n)"
            for k in range(BINS)
        ]
        records += [
            f"struct({text(name)} AS field, {k} AS bin, {number(None)} AS lo, {number(None)} AS hi, {text(label)} AS label, "
            f"infinite{i}[{j}] AS n)"
            for j, (k, label) in enumerate((BELOW, ABOVE))
        ]
    rows = finite.selectExpr(*above).selectExpr(f"inline(array({', '.join(records)}))")
    return rows.where(f"bin BETWEEN 0 AND {BINS - 1} OR n > 0")
