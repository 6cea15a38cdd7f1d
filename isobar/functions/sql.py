"""Names and values as SQL text.

Aggregates over many columns are written as SQL text: one expression is then one call
into the JVM, however many operators it has.
"""

from __future__ import annotations

import math


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pattern(regex: str) -> str:
    """A regular expression as a raw literal; it must hold no single quote."""
    return f"r'{regex}'"


def number(value: float | None) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if math.isinf(value):
        return f"double('{'-' if value < 0 else ''}Infinity')"
    return f"{float(value)!r}D"
