"""Aggregates of many columns and pairs in one pass.

Rows are turned into one row for each column and pair: ``id``, its value(s) ``x`` and ``y``, and ``s``, which is the
value for columns and null for pairs. Grouped by ``id``, a pass has the same few aggregates however
many columns there are, so its loop stays short enough for the JVM to compile, and one scan serves all of them.

Operators hand in their aggregates as ``Partial``. They are computed in ``MERGE_GROUPS`` groups of partitions
first, so that sketches of many tasks never meet in one place, and then merged.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


MERGE_GROUPS = 64


@dataclass(frozen=True)
class Partial:
    """An aggregate over rows, and how its partial results are merged.

    ``of_rows`` sees ``x``, ``y`` and ``s``. ``merged`` sees the partial results of all operators by name, and
    ``mean_x`` and ``mean_y``, the means over everything.
    """

    name: str
    of_rows: str
    merged: str


#: What the means take; every pass has these.
BASE = (
    Partial("n", "count(x)", "sum(n)"),
    Partial("total", "sum(x)", "sum(total)"),
    Partial("total_y", "sum(y)", "sum(total_y)"),
)


def long_form(doubles: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(id, x, y, s) of columns of doubles: columns are numbered from 0 on, pairs go on behind them. A pair's values
    are null where either is; negative zero is zero."""
    none = "CAST(NULL AS DOUBLE)"
    rows = [f"{i}, {c} + 0D, {none}, {c} + 0D" for i, c in enumerate(columns)]
    rows += [
        f"{i}, if({y} IS NULL, NULL, {x}), if({x} IS NULL, NULL, {y}), {none}" for i, (x, y) in enumerate(pairs, len(columns))
    ]
    return doubles.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (id, x, y, s)")


def gathered(rows: DataFrame, partials: Sequence[Partial]) -> DataFrame:
    """One row for each ``id`` with the merged aggregates by name."""
    partials = list({p.name: p for p in (*BASE, *partials)}.values())
    first = rows.groupBy("id", (F.spark_partition_id() % MERGE_GROUPS).alias("merge_group")).agg(
        *[F.expr(p.of_rows).alias(p.name) for p in partials]
    )
    of_all = "try_divide(sum({0}) OVER (PARTITION BY id), sum(n) OVER (PARTITION BY id))"
    means = first.selectExpr("*", f"{of_all.format('total')} AS mean_x", f"{of_all.format('total_y')} AS mean_y")
    return means.groupBy("id").agg(*[F.expr(p.merged).alias(p.name) for p in partials])
