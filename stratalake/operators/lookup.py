"""Lookups by computed position: pools, weighted draws, intervals, options per group, guarded alternatives."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.functions.draws import draw, pick
from stratalake.operators.joins import attach, measured_bytes
from stratalake.operators.sequence import bucket_rows, cumulative_bounds, index_in_group, pool_index
from stratalake.sources.shared import checkpointed

#: Interval widths of one level differ by at most this factor.
_LEVEL_BASE = 4
#: Up to so many intervals of narrower levels share the cells of a wider one.
_FEW = 32


def pool_lookup(
    df: DataFrame,
    key: str,
    multiplier: int,
    pool: Sequence[str] | DataFrame,
    column: str,
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Add the pool value at position ``key * multiplier mod pool size``; NULL for a NULL key.

    A literal pool is an array in the projection. A pool held in a DataFrame is numbered and joined.
    """
    if not isinstance(pool, DataFrame):
        values = sorted(pool)
        return df.withColumn(column, pick(values, draw(key, multiplier, len(values))))
    indexed = pool_index(pool, column, "__at")
    at = df.withColumn("__at", F.pmod(F.col(key).cast("bigint") * multiplier, indexed.agg(F.count(F.lit(1))).scalar()))
    return attach(at, indexed, "__at", "left", broadcast_bytes=broadcast_bytes).drop("__at")


def _levels(spans: dict[int, int]) -> dict[int, int]:
    """Level of intervals -> level whose cells they use: a level with few intervals joins the next one up.

    That adds at most ``_FEW`` intervals to a cell and spares each point a look.
    """
    used, carried, present = {}, [], sorted(spans)
    total = 0
    for level in present:
        total += spans[level]
        carried.append(level)
        if total > _FEW or level == present[-1]:
            used.update(dict.fromkeys(carried, level))
            carried, total = [], 0
    return used


def _number(df: DataFrame, column: str) -> Column:
    """A number for a column's values that keeps their order; NULL for NULL and for an infinity."""
    c, kind = F.col(f"`{column}`"), df.schema[column].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c) / 1e6
    if isinstance(kind, T.TimestampNTZType):  # by its fields, as a time zone may skip or repeat hours
        return (F.unix_date(c.cast("date")).cast("double") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{column!r} is {kind.simpleString()}: neither a number nor a time")
    number = c.cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def range_join(
    points: DataFrame,
    value: str,
    intervals: DataFrame,
    low: str,
    high: str,
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Inner join of points with the half-open intervals ``[low, high)`` that hold them: numbers, dates or timestamps.

    A NULL (or infinite) bound leaves that end open. A NULL point is in no interval, nor is any point in an interval whose
    low end is not below its high end.

    Intervals are sorted into levels by their span, and each level has cells at least as wide as its widest
    interval, so an interval touches two cells whatever its span. Points look into one cell per level. What
    remains is an equi-join on (level, cell) and the exact test. For the cells, open ends lie just beyond the outermost
    bound there is, and so do points beyond it.
    """
    lowest, highest = F.col(f"`{low}`"), F.col(f"`{high}`")
    usable = intervals.where(lowest.isNull() | highest.isNull() | (lowest < highest))
    bounds = usable.select(_number(usable, low).alias("lo"), _number(usable, high).alias("hi"))
    least, most = bounds.agg(F.least(F.min("lo"), F.min("hi")), F.greatest(F.max("lo"), F.max("hi"))).first()  # one row
    least, most = (least or 0.0) - 1, (most or 0.0) + 1
    begin, end = F.coalesce(_number(usable, low), F.lit(least)), F.coalesce(_number(usable, high), F.lit(most))
    finest = F.greatest(F.abs(begin), F.abs(end)) * 2.0 ** -50  # spans below a double's precision
    own = F.floor(F.log(float(_LEVEL_BASE), F.greatest(end - begin, finest))).cast("int")
    spans = {r.level: r.n for r in  # one row per power of the base between the narrowest and the widest span
             usable.groupBy(own.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not spans:  # no usable interval: no match, same columns
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in intervals.schema.fields]
        return points.select("*", *absent).where(F.lit(False))
    used = _levels(spans)
    levels = sorted(set(used.values()))

    def cell(at: Column, level: Column) -> Column:
        return F.floor(at / F.pow(F.lit(float(_LEVEL_BASE)), level + 1))

    level = reduce(lambda ladder, x: ladder.when(own <= x, F.lit(x)), levels, F.when(F.lit(False), F.lit(0)))
    cells = usable.withColumn("__level", level).withColumn(
        "__cell", F.explode(F.sequence(cell(begin, F.col("__level")), cell(end, F.col("__level")))))
    point = F.col(f"`{value}`")
    known = points.where(point.isNotNull())
    if len(levels) == 1:
        looking = known.withColumn("__level", F.lit(levels[0]))
    else:
        looking = known.withColumn("__level", F.explode(F.array(*[F.lit(x) for x in levels])))
    place = F.coalesce(_number(points, value), F.when(point.cast("string") == "-Infinity", least).otherwise(most))
    at = F.greatest(F.lit(least), F.least(F.lit(most), place))
    looking = looking.withColumn("__cell", cell(at, F.col("__level")))
    found = attach(looking, cells, ["__level", "__cell"], "inner", broadcast_bytes=broadcast_bytes)
    inside = (lowest.isNull() | (point >= lowest)) & (highest.isNull() | (point < highest))
    return found.where(inside).drop("__level", "__cell")


def weighted_draw(
    df: DataFrame,
    key: str,
    multiplier: int,
    weights: DataFrame,
    item: str,
    weight: str,
    *,
    broadcast_bytes: int | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add the item drawn for each key with probability proportional to its weight.

    ``item`` must be unique in ``weights``; items of weight 0 are never drawn.
    """
    chosen = weights.select(item, F.col(weight).cast("bigint").alias("__weight")).where(F.col("__weight") > 0)
    bounds = cumulative_bounds(chosen, item, "__weight", "__lower", "__upper", rows_per_bucket=rows_per_bucket)
    n_items, total = chosen.agg(F.count(F.lit(1)), F.sum("__weight")).first()
    if not total:
        raise ValueError("weighted_draw needs at least one positive weight")
    if n_items > bucket_rows(df, rows_per_bucket):
        bounds = checkpointed(bounds)  # read three times below
    drawn = df.withColumn("__drawn", draw(key, multiplier, total))
    found = range_join(drawn, "__drawn", bounds.drop("__weight"), "__lower", "__upper", broadcast_bytes=broadcast_bytes)
    return found.drop("__drawn", "__lower", "__upper")


def pick_in_group(
    df: DataFrame,
    group: str,
    key: str,
    multiplier: int,
    options: DataFrame,
    order: str,
    *,
    broadcast_bytes: int | None = None,
    rows_per_bucket: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Add one option row of the same group, at position ``key * multiplier mod group size`` along ``order``.

    Options are numbered rather than gathered into one array per group, so a group may hold any number of
    them, and the join key (group, position) spreads a popular group over its options. Rows whose group has
    no option keep NULLs. ``derived``: see ``attach``.
    """
    numbered = index_in_group(options, group, order, "__at", "__size", rows_per_bucket=rows_per_bucket)
    sizes = options.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    # Numbering adds one BIGINT to a row, so the options themselves tell the size without running it.
    small, large = measured_bytes(sizes, options.withColumn("__at", F.lit(0).cast("bigint")))
    sized = attach(df, sizes, group, "left", broadcast_bytes=broadcast_bytes, size=small, derived=derived)
    placed = sized.withColumn("__at", draw(key, multiplier, F.col("__size"))).drop("__size")
    picked = attach(
        placed, numbered.drop("__size"), [group, "__at"], "left", broadcast_bytes=broadcast_bytes, size=large, derived=True)
    return picked.drop("__at")


def conditional_lookup(
    df: DataFrame,
    kind: str,
    key: str,
    multiplier: int,
    pool: DataFrame,
    *,
    position: str = "idx",
    broadcast_bytes: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Add the pool row of the same kind at position ``key * multiplier mod size of that kind``.

    ``pool`` holds the kind column, a 0-based dense position per kind, and the values. One keyed join takes
    the place of one guarded join per kind and a COALESCE over their results. ``derived``: see ``attach``.
    """
    sizes = pool.groupBy(kind).agg(F.count(F.lit(1)).alias("__size"))
    values = pool.withColumn("__at", F.col(position).cast("bigint")).drop(position)
    small, large = measured_bytes(sizes, values)
    sized = attach(df, sizes, kind, "left", broadcast_bytes=broadcast_bytes, size=small, derived=derived)
    placed = sized.withColumn("__at", draw(key, multiplier, F.col("__size"))).drop("__size")
    return attach(placed, values, [kind, "__at"], "left", broadcast_bytes=broadcast_bytes, size=large, derived=True).drop("__at")
