"""Interval predicates and band labels with stated edges and a stated answer for NULL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratalake.functions.draws import col

#: Age bands, closed on the left: 0-17, 18-34, 35-49, 50-64, 65+.
AGE_BANDS = [("0-17", "<", 18), ("18-34", "<", 35), ("35-49", "<", 50), ("50-64", "<", 65), ("65+", None, None)]


def in_band(value: Column | str, low, high) -> Column:
    """Half-open test ``low <= value < high`` (``between`` would include the upper edge)."""
    return (col(value) >= low) & (col(value) < high)


def band(
    value: Column | str,
    steps: Sequence[tuple[str, str | None, float | None]],
    null_label: str | None = None,
) -> Column:
    """Label of the first step ``(label, "<" or "<=", edge)`` that holds; the last step is the rest."""
    value = col(value)
    out = F.when(value.isNull(), F.lit(null_label))
    for label, op, edge in steps[:-1]:
        out = out.when(value < edge if op == "<" else value <= edge, label)
    return out.otherwise(steps[-1][0])


def age_band(age: Column | str) -> Column:
    return band(age, AGE_BANDS)
