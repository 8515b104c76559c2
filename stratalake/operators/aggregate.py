"""Gold-layer aggregations over any fact: grouped measures, ratios, cross-tabs, leaders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.operators.joins import attach
from stratalake.operators.sequence import top_k_per_group


def mean(value: Column | str, digits: int = 4) -> Column:
    return F.round(F.avg(F.col(value) if isinstance(value, str) else value), digits)


def ratio(condition: Column, digits: int = 6) -> Column:
    """Share of the rows that meet the condition; NULL for no rows. NULL conditions count as not met."""
    return F.round(F.try_divide(F.count_if(condition), F.count(F.lit(1))), digits)


def kpi(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named measures per key combination."""
    return df.groupBy(*keys).agg(*[measure.alias(name) for name, measure in measures.items()])


def kpi_by_dimension(
    fact: DataFrame,
    key: str,
    measures: Mapping[str, Column],
    dim: DataFrame,
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Measures per dimension row, with the dimension's attributes.

    For attributes that depend on the key: the fact is reduced to one row per key before the dimension is
    joined, so what is joined has the size of the dimension and a popular key is one row.
    """
    return attach(kpi(fact, [key], measures), dim, key, "inner", broadcast_bytes=broadcast_bytes, derived=True)


def share_of_total(df: DataFrame, columns: Sequence[str], value: str, digits: int = 8, scale: int | None = None) -> DataFrame:
    """Each row's value as a share of the whole sum and of the largest value, by scalar subqueries.

    ``scale``: add up as decimals with so many places, so the sum does not depend on its order; by default in the column's type.
    """
    exact = F.col(value) if scale is None else F.col(value).cast(f"decimal(38,{scale})")
    total = df.agg(F.sum(exact).cast("double")).scalar()
    largest = df.agg(F.max(value)).scalar()
    return df.select(
        *columns,
        F.round(F.try_divide(F.col(value), total), digits).alias("share_of_total"),
        F.round(F.try_divide(F.col(value), largest), digits).alias("share_of_max"),
    )


def crosstab_share(df: DataFrame, row: Column, column: str, values: Sequence[str], digits: int = 6) -> DataFrame:
    """Counts of each listed value per row label, and each value's share of all rows with that label."""
    rows = F.count(F.lit(1))
    counts = {v: F.count_if(F.col(column) == v) for v in values}
    return df.groupBy(row.alias("band")).agg(
        rows.alias("n"),
        *[c.alias(f"n_{v}") for v, c in counts.items()],
        *[F.round(F.try_divide(c, rows), digits).alias(f"share_{v}") for v, c in counts.items()],
    )


def correlation(df: DataFrame, keys: Sequence[str], x: str, y: str, digits: int = 6) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.corr(x, y), digits).alias("corr"), F.count(F.lit(1)).alias("n"))


def leader_per_group(df: DataFrame, group: str, candidate: str) -> DataFrame:
    """The candidate with most rows in each group; ties go to the smaller name."""
    counted = df.groupBy(group, candidate).agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counted, group, [F.desc("n"), F.asc(candidate)], 1, "rank").drop("rank")


def rate_gap(df: DataFrame, flag: Column, condition: Column, digits: int = 6) -> DataFrame:
    """One row: share meeting the condition with the flag, without it, and the difference."""
    def share(rows: Column) -> Column:
        return F.try_divide(F.count_if(rows & condition), F.count_if(rows))

    return df.agg(
        F.count_if(flag).alias("n_flagged"),
        F.count_if(~flag).alias("n_other"),
        F.round(share(flag), digits).alias("rate_flagged"),
        F.round(share(~flag), digits).alias("rate_other"),
        F.round(share(flag) - share(~flag), digits).alias("gap"),
    )


def load_per_capacity(
    load: DataFrame, capacity: DataFrame, key: str, amount: str, capacity_column: str, *, digits: int = 6,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Load per unit of capacity per key; NULL where the capacity is missing or 0."""
    both = attach(load, capacity, key, "left", broadcast_bytes=broadcast_bytes)
    per_unit = F.round(F.try_divide(F.col(amount).cast("double"), F.col(capacity_column)), digits)
    return both.select("*", per_unit.alias(f"{amount}_per_{capacity_column}"))
