"""Dates relative to an explicit ``as_of`` day, so that a re-run gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratalake.functions.draws import col, draw, tiered


def day(value: str) -> Column:
    return F.lit(value).cast("date")


def days_before(as_of: str, days: Column) -> Column:
    return F.date_sub(day(as_of), days.cast("int"))


def days_after(start: str, days: Column) -> Column:
    return F.date_add(day(start), days.cast("int"))


def age_years(birth: Column | str, as_of: str) -> Column:
    """Whole years as days / 365.25 rounded down, so exactly 365 days is still age 0."""
    return F.floor(F.datediff(day(as_of), col(birth)) / F.lit(365.25)).cast("int")


def skewed_birth_date(
    key: Column | str,
    as_of: str,
    bucket: tuple[int, int],
    spread_multiplier: int,
    tiers: Sequence[tuple[int, int, int]],
) -> Column:
    """Birth date drawn from age buckets ``(upper draw, lowest age in days, width in days)``."""
    ages = [(upper, draw(key, spread_multiplier, width) + lowest) for upper, lowest, width in tiers]
    return days_before(as_of, tiered(draw(key, *bucket), ages))
