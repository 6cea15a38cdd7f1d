"""Pearson's r as an aggregate, and its verbal strength, as SQL."""

from __future__ import annotations

from isobar.functions.sql import text

# Lower bounds of |r|, rounded to two places, and their names.
STRENGTHS = [
    (0.70, "Very strong"),
    (0.40, "Strong"),
    (0.30, "Moderate"),
    (0.20, "Weak"),
]
NEGLIGIBLE = "No or negligible relationship"


def pearson_r(x: str, y: str) -> str:
    """r over the rows where both are present; null when either side is constant."""
    both = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
    constant = " OR ".join(f"min({v}) {both} = max({v}) {both}" for v in (x, y))
    product = f"stddev_pop({x}) {both} * stddev_pop({y}) {both}"
    return f"if({constant}, NULL, try_divide(covar_pop({x}, {y}) {both}, {product}))"


def strength(r: str) -> str:
    size = f"abs(round({r}, 2))"
    sign = f"if({r} > 0, ' positive', ' negative')"
    cases = " ".join(
        f"WHEN {size} >= {bound} THEN concat({text(name)}, {sign}, ' relationship')" for bound, name in STRENGTHS
    )
    return f"CASE WHEN {r} IS NULL THEN NULL {cases} ELSE {text(NEGLIGIBLE)} END"
