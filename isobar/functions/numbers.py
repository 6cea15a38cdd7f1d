"""Text-to-number tests and casts, as SQL over a text expression."""

from __future__ import annotations

from isobar.functions.sql import pattern

# Fixed value: what counts as a numeric first cell. It admits texts that do not cast
# (``1..2``, ``12-5``) and refuses some that do (``1e5``, ``5.``).
NUMERIC_TEXT = r"^[-+]?\d*\.*\d+E*[-+]?\d*$"

# What a cast to floating point accepts. The pattern keeps out the type suffixes and
# hexadecimal forms that the JVM's own parser would let through.
FLOAT_TEXT = r"^(?i)\s*[-+]?(\d+\.?\d*(e[-+]?\d+)?|\.\d+(e[-+]?\d+)?|inf|infinity|nan)\s*$"


def to_double(x: str) -> str:
    """Text to double; null where the text is no number."""
    return f"if(rlike({x}, {pattern(FLOAT_TEXT)}), try_cast(trim({x}) AS DOUBLE), NULL)"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR trim({x}) = '')"


def is_invalid(x: str) -> str:
    """Neither blank nor a number."""
    return f"(NOT {is_blank(x)} AND ({to_double(x)}) IS NULL)"


def number_or_zero(x: str) -> str:
    """Blank cells become 0; other texts cast, or null where they do not."""
    return f"if({is_blank(x)}, 0D, {to_double(x)})"


def kind_of(x: str, infer: str = "regex") -> str:
    """``Numeric`` or ``String`` for one sample text, by pattern or by cast."""
    tests = {
        "regex": f"coalesce(rlike({x}, {pattern(NUMERIC_TEXT)}), false)",
        "cast": f"({to_double(x)}) IS NOT NULL",
    }
    if infer not in tests:
        raise ValueError(f"infer must be 'regex' or 'cast', not {infer!r}")
    return f"if({tests[infer]}, 'Numeric', 'String')"
