"""Value frequencies, modes and distinct values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from isobar.functions.nested import as_text
from isobar.functions.sql import ident
from isobar.operators.numeric import double_of


def text_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, value, n)`` over the texts of the columns."""
    return _frequencies(df.selectExpr(*[f"{as_text(df, c)} AS {ident(c)}" for c in columns]))


def number_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, value, n)`` over numeric columns, values as doubles."""
    return _frequencies(df.selectExpr(*[f"{double_of(df, c)} AS {ident(c)}" for c in columns]))


def _frequencies(df: DataFrame) -> DataFrame:
    # Counted inside each task first, so a value held by most rows costs one row per task.
    long = df.unpivot([], [ident(c) for c in df.columns], "field", "value")
    return long.filter("value IS NOT NULL").groupBy("field", "value").agg(F.expr("count(*) AS n"))


def modes(frequencies: DataFrame, with_count: bool = False) -> DataFrame:
    """Per field: number of distinct values and the mode.

    The smallest of equally frequent values is taken. ``has_mode`` is false, and the
    mode null, when no value occurs twice. ``with_count`` adds how often the most frequent value occurs.
    """
    summary = frequencies.groupBy("field").agg(
        F.expr("count(*) AS n_unique"), F.expr("min(struct(-n AS rank, value)) AS top")
    )
    return summary.selectExpr(
        "field", "n_unique", "top.rank < -1 AS has_mode", "if(top.rank < -1, top.value, NULL) AS mode",
        *(["-top.rank AS n_mode"] if with_count else []),
    )


def distinct_values(frequencies: DataFrame) -> DataFrame:
    return frequencies.select("field", "value")

