"""Columns of any type as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from isobar.functions.sql import ident


def as_text(df: DataFrame, name: str) -> str:
    """SQL for the column as text: structs, arrays and maps as JSON, all else by cast."""
    kind, value = df.schema[name].dataType, ident(name)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return f"to_json({value})"
    if isinstance(kind, T.BinaryType):
        return f"hex({value})"
    return value if isinstance(kind, T.StringType) else f"CAST({value} AS STRING)"
