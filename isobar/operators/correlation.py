"""Pearson correlation of chosen column pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from isobar.functions.sql import text
from isobar.functions.strength import pearson_r, strength
from isobar.operators.numeric import as_doubles, chunks, numeric_columns, stacked
from isobar.operators.partials import Partial


#: What r takes besides the moments of ``x``, for a pass that several operators share.
COMOMENTS = (
    Partial("low_y", "min(y)", "min(low_y)"),
    Partial("high_y", "max(y)", "max(high_y)"),
    Partial("spread_y", "var_pop(y) * count(y)", "sum(spread_y + n * pow(total_y / n - mean_y, 2))"),
    Partial("product", "covar_pop(x, y) * count(x)", "sum(product + n * (total / n - mean_x) * (total_y / n - mean_y))"),
)
#: r of a merged row; null when either side is constant.
R = "if(low = high OR low_y = high_y, NULL, try_divide(product, sqrt(spread) * sqrt(spread_y)))"


def default_pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    """Exactly two numeric columns make a pair by themselves; otherwise none does."""
    return [(columns[0], columns[1])] if len(columns) == 2 else []


def pearson(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """``(x, y, n, r, strength)`` per pair, all pairs of a chunk in one pass."""
    pairs = default_pairs(numeric_columns(df)) if pairs is None else list(pairs)
    if not pairs:
        return df.sparkSession.createDataFrame([], "x string, y string, n bigint, r double, strength string")
    return stacked([_pearson(df, part) for part in chunks(pairs)])


def _pearson(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = {c: f"c{i}" for i, c in enumerate(columns)}
    records = ", ".join(
        f"struct({text(x)} AS x, {text(y)} AS y, "
        f"count_if({at[x]} IS NOT NULL AND {at[y]} IS NOT NULL) AS n, {pearson_r(at[x], at[y])} AS r)"
        for x, y in pairs
    )
    rows = as_doubles(df, columns).selectExpr(f"array({records}) AS records").selectExpr("inline(records)")
    return rows.selectExpr("x", "y", "n", "r", f"{strength('r')} AS strength")
