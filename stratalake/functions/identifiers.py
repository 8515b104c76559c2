"""Formatted identifiers assembled from digit groups, and accent-free e-mail addresses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratalake.functions.draws import col, draw
from stratalake.plans.fixed import ACCENTS, WIDE_ACCENTS  # noqa: F401



def digits(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def formatted_id(key: Column | str, template: str, groups: Sequence[tuple[int, int, int]]) -> Column:
    """Fill the ``{}`` slots of a template with zero-padded draws ``(multiplier, modulus, width)``."""
    pieces = template.split("{}")
    if len(pieces) != len(groups) + 1:
        raise ValueError(f"{template!r} needs {len(pieces) - 1} digit groups, got {len(groups)}")
    parts = [F.lit(pieces[0])]
    for (multiplier, modulus, width), literal in zip(groups, pieces[1:]):
        parts += [digits(draw(key, multiplier, modulus), width), F.lit(literal)]
    return F.concat(*parts)


def fold_ascii(text: Column | str, table: tuple[str, str] = ACCENTS) -> Column:
    return F.translate(col(text), *table)


def email_address(key: Column | str, first: Column | str, last: Column | str, domain: str) -> Column:
    """``first.lastKEY@domain`` in lower case without the mapped accents."""
    return F.lower(F.concat(fold_ascii(first), F.lit("."), fold_ascii(last),
                            col(key).cast("string"), F.lit("@" + domain)))
