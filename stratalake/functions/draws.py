"""Deterministic pseudo-random columns: ``pmod(key * multiplier, modulus)`` and what is read off it.

Keys are widened to BIGINT first, because INT * constant overflows (and raises) for large keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def draw(key: Column | str, multiplier: int, modulus: int | Column) -> Column:
    """A value in ``[0, modulus)`` that depends on the key alone."""
    return F.pmod(col(key).cast("bigint") * F.lit(multiplier), F.lit(modulus))


def pick_weighted(drawn: Column | str, shares: Sequence[tuple[str, int]]) -> Column:
    """Label whose cumulative share covers the drawn value; shares add up to the draw's modulus."""
    drawn, upper, picked = col(drawn), 0, None
    for label, share in shares[:-1]:
        upper += share
        hit = drawn < upper
        picked = F.when(hit, label) if picked is None else picked.when(hit, label)
    last = F.lit(shares[-1][0])
    return last if picked is None else picked.otherwise(last)


def biased_class(
    measure: Column | str,
    drawn: Column | str,
    table: Sequence[tuple[str | None, float | None, Sequence[tuple[str, int]]]],
    null_class: str | None = None,
) -> Column:
    """Class label whose shares depend on the band of a measure.

    ``table`` lists ``(operator, edge, shares)`` with operator ``"<"`` or ``"<="``; the last entry
    has ``(None, None, shares)``. A NULL measure gives ``null_class`` rather than the last band.
    """
    measure = col(measure)
    out = F.when(measure.isNull(), F.lit(null_class))
    for op, edge, shares in table[:-1]:
        out = out.when(measure < edge if op == "<" else measure <= edge, pick_weighted(drawn, shares))
    return out.otherwise(pick_weighted(drawn, table[-1][2]))


def null_every(key: Column | str, multiplier: int, modulus: int, value: Column) -> Column:
    """The value, or NULL on the keys whose draw is 0."""
    return F.when(draw(key, multiplier, modulus) != 0, value)


def tiered(drawn: Column | str, tiers: Sequence[tuple[int, Column]]) -> Column:
    """Value of the first tier whose exclusive upper draw bound exceeds the draw; the last tier is the rest."""
    drawn, out = col(drawn), None
    for upper, value in tiers[:-1]:
        out = F.when(drawn < upper, value) if out is None else out.when(drawn < upper, value)
    return tiers[-1][1] if out is None else out.otherwise(tiers[-1][1])


def pick(values: Sequence[str], index: Column) -> Column:
    """Element of a literal pool at a 0-based index, NULL at a NULL index; needs no join."""
    element = F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))
    return F.when(index.isNotNull(), element)  # element_at over a literal array gives the last one for NULL


def two_part_wait(key: Column | str, first: tuple[int, int], second: tuple[int, int], zero_when: Column) -> Column:
    """Sum of two draws, 0 where ``zero_when`` holds."""
    return F.when(zero_when, F.lit(0).cast("bigint")).otherwise(draw(key, *first) + draw(key, *second))
