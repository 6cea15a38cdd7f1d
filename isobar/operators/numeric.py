"""Moments and extremes of numeric columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, types as T

from isobar.functions.sql import ident, text
from isobar.operators.partials import Partial

# Columns handled by one aggregate. Wider tables take several scans, each reading only
# its own columns: past some sixty aggregates the generated loop gets too long for the
# JVM to compile, and one scan of 32 columns is then ten times slower than four of 8.
COLUMNS_PER_PASS = 8


#: Moments and extremes of ``x``, for a pass that several operators share.
MOMENTS = (
    Partial("low", "min(x)", "min(low)"),
    Partial("high", "max(x)", "max(high)"),
    Partial("spread", "var_pop(x) * count(x)", "sum(spread + n * pow(total / n - mean_x, 2))"),
)


def chunks(columns: Sequence, size: int = COLUMNS_PER_PASS) -> Iterator[list]:
    for i in range(0, len(columns), size):
        yield list(columns[i : i + size])


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def double_of(df: DataFrame, column: str) -> str:
    """SQL for the column as a double, NaN as null."""
    value = f"CAST({ident(column)} AS DOUBLE)"
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return f"nanvl({value}, NULL)"
    return value


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles, under the names ``c0``, ``c1``, ..."""
    return df.selectExpr(*[f"{double_of(df, c)} AS c{i}" for i, c in enumerate(columns)])


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per field: n, minimum, maximum, range, average, population variance and
    standard deviation. One pass for all columns and no shuffle of rows."""
    columns = numeric_columns(df) if columns is None else list(columns)
    return stacked([_summary(as_doubles(df, part), part) for part in chunks(columns)])


def _summary(df: DataFrame, columns: list[str]) -> DataFrame:
    records = ", ".join(
        f"struct({text(c)} AS field, count(c{i}) AS n, min(c{i}) AS minimum, max(c{i}) AS maximum, "
        f"max(c{i}) - min(c{i}) AS range, avg(c{i}) AS average, "
        f"var_pop(c{i}) AS variance, stddev_pop(c{i}) AS stddev)"
        for i, c in enumerate(columns)
    )
    return df.selectExpr(f"array({records}) AS records").selectExpr("inline(records)")
