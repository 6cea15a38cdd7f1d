"""Keyed rows: the last one of each key, and their layout by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def newest(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row per key: the one that is last by ``order``, a number. A row without it comes before all others.

    Every buffer is fixed-width where the other columns are, so the dedupe stays a hash aggregate; all
    columns share the ordering and so come from one row.
    """
    at = F.coalesce(F.col(order).cast("bigint"), F.lit(-(2**63)))
    values = [c for c in rows.columns if c not in (*key, order)]
    return rows.groupBy(*key).agg(*[F.max_by(v, at).alias(v) for v in values])


def by_day(rows: DataFrame, *order: str) -> DataFrame:
    """Laid out for writing by day: ordered inside each file.

    A rebalance, not a plain repartition, so that AQE splits a day that holds much
    more than the others over several writers.
    """
    return rows.hint("rebalance", "day").sortWithinPartitions("day", *order)
