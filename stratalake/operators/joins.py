"""Equi-joins that stay balanced when one key holds a large share of the rows.

A side is broadcast only after its size has been measured. Above the limit the join is a shuffle
join, and keys that a one-pass sketch finds to be hot are spread over many reducers: their left rows
get a number derived from the row itself, their right rows are copied once per number. The number
only decides where a row goes, never whether it matches, and it is a hash rather than ``rand()``, so
a recomputed task sends the same rows to the same place. Rows that are equal in every column share a
number; a reducer that is overfull with such copies is split by Spark's adaptive skew handling.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

#: Largest measured size of a broadcast side in bytes, unless the session sets BROADCAST_SETTING.
BROADCAST_BYTES = 64 << 20
BROADCAST_SETTING = "spark.stratalake.broadcastBytes"
#: Counters a sketch keeps for each key that can exceed the share it looks for, and the most that Spark allows.
_COUNTERS_PER_KEY, _MOST_COUNTERS = 20, 1_000_000

#: Files this many times the broadcast limit need no measuring.
_SURELY_LARGE = 64

_SPREAD = "__spread"

#: Joins that can be spread; those of them that bring in no columns.
_FILTERS = ("left_semi", "left_anti")
_SPREADABLE = ("inner", "left", *_FILTERS)


def _row_bytes(field: T.StructField) -> Column:
    """Bytes of a column's values in one row; strings and arrays are measured, the rest is fixed."""
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return 16 + F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(field.dataType, T.ArrayType):
        if isinstance(field.dataType.elementType, T.NumericType):
            return 16 + 8 * F.greatest(F.size(name), F.lit(0))
        return 16 + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
    if isinstance(field.dataType, (T.StructType, T.MapType)):
        return 16 + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
    return F.lit(8)


def _file_bytes(df: DataFrame) -> int | None:
    """Spark's estimate, from file sizes, for a frame that is nothing but columns of stored files; None for any other."""
    whole = plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    return int(str(whole.stats().sizeInBytes())) if plan.nodeName() in ("LogicalRelation", "Relation") else None


def measured_bytes(*frames: DataFrame, limit: int | None = None) -> list[int]:
    """Size of each frame's rows, measured for all of them in one aggregation job.

    With a ``limit``, files so far beyond it that no encoding makes up for the difference are taken at their estimate
    and not read.
    """
    told = [None if limit is None else _file_bytes(df) for df in frames]
    told = [b if b is not None and b > _SURELY_LARGE * limit else None for b in told]
    unknown = [df for df, b in zip(frames, told) if b is None]
    found = iter(_summed_bytes(unknown) if unknown else [])
    return [next(found) if b is None else b for b in told]


def _summed_bytes(frames: Sequence[DataFrame]) -> list[int]:
    sizes = [
        df.agg(F.sum((16 + reduce(lambda a, b: a + b, map(_row_bytes, df.schema.fields))).cast("bigint")).alias("b"))
        .select(F.lit(i).alias("i"), F.coalesce("b", F.lit(0)).alias("b"))
        for i, df in enumerate(frames)
    ]
    found = {r.i: r.b for r in reduce(DataFrame.unionAll, sizes).collect()}  # one row per frame
    return [found[i] for i in range(len(frames))]


def broadcast_limit(df: DataFrame, given: int | None = None) -> int:
    """Broadcast limit in bytes: as given, else the session's setting, else the default."""
    return int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES))) if given is None else given


def _key_list(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _key_mark(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the key columns that is equal for equal keys of either side, whatever their integer width."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    parts = []
    for k in keys:
        mine, theirs = df.schema[k].dataType, other.schema[k].dataType
        if isinstance(mine, integral) and isinstance(theirs, integral):
            parts.append(F.col(k).cast("bigint"))
        elif mine == theirs:
            parts.append(F.col(k))
        elif isinstance(mine, T.NumericType) and isinstance(theirs, T.NumericType):
            parts.append(F.col(k).cast("double"))
        else:
            raise TypeError(f"join key {k!r} is {mine.simpleString()} on one side, {theirs.simpleString()} on the other")
    return F.xxhash64(*parts)


def _row_mark(df: DataFrame) -> Column:
    """Hash over all columns that can be hashed."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)])


def _share_limit(df: DataFrame) -> float:
    """Share of the rows that makes a key too large for one reducer: that of two reducers, as far as a sketch can tell."""
    return max(2.0 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _COUNTERS_PER_KEY / _MOST_COUNTERS)


def hot_keys(df: DataFrame, mark: Column, share: float) -> dict[int, float]:
    """Key hashes that hold more than ``share`` of the rows, with that share.

    A frequent-items sketch per task, merged into one: no shuffle of rows, and an answer bounded by the share, as no more
    than ``1 / share`` keys can exceed it. Its counts are estimates, which is enough here because they only steer where
    rows go.
    """
    most = max(1, math.ceil(1 / share))
    counters = min(_MOST_COUNTERS, _COUNTERS_PER_KEY * most)
    row = (
        df.select(mark.alias("mark"))
        .agg(F.count(F.lit(1)).alias("n"),
             F.expr(f"approx_top_k(mark, {most}, {counters})").alias("top"))
        .first()
    )
    return {t["item"]: t["count"] / row["n"] for t in row["top"] or [] if t["count"] > share * row["n"]}


def _copies(mark: Column, hot: dict[int, float], share: float) -> Column:
    """Reducers that a key's rows are spread over: 1, or for a hot key the power of two that brings it below the share."""
    by_copies: dict[int, list[int]] = {}
    for key, found in hot.items():
        by_copies.setdefault(2 ** max(1, math.ceil(math.log2(found / share))), []).append(key)
    ladder = reduce(lambda when, n: when.when(mark.isin(by_copies[n]), F.lit(n)), sorted(by_copies), F)
    return ladder.otherwise(F.lit(1))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    share: float | None = None,
    probe: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join on equally named columns in which the left side's hot keys are spread out.

    ``how`` is one of inner, left, left_semi, left_anti. ``probe`` is a frame with the left side's keys that
    is cheaper to look through for hot keys than the left side itself.
    """
    if how not in _SPREADABLE:
        raise ValueError(f"cannot spread a {how!r} join")
    keys = _key_list(on)
    share = _share_limit(left) if share is None else share
    left_mark, right_mark = _key_mark(left, right, keys), _key_mark(right, left, keys)
    hot = hot_keys(left if probe is None else probe, left_mark, share)
    if not hot:
        return left.join(right, keys, how)
    spread_left = left.withColumn(
        _SPREAD, F.pmod(_row_mark(left), _copies(left_mark, hot, share).cast("bigint")).cast("int"))
    spread_right = right.withColumn(_SPREAD, F.explode(F.sequence(F.lit(0), _copies(right_mark, hot, share) - 1)))
    return spread_left.join(spread_right, keys + [_SPREAD], how).drop(_SPREAD)


def attach_all(
    left: DataFrame,
    lookups: Sequence[tuple[DataFrame, str | Sequence[str], str]],
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join the left side with several ``(frame, key columns, how)`` lookups.

    All lookups are measured in one job. Large ones are spread joins, small ones are broadcast. A large lookup may be
    keyed on a column that another one brings in: it is joined with that other frame, so that the left rows do not move
    for it; where this would not give the same rows, its hot keys are looked for in that frame. Left rows move while they
    are narrow: what only drops rows comes first, then large lookups, those of few columns first, and small ones last. No
    join runs before the result is asked for. Keys that come from several frames are left to Spark's adaptive skew split.
    """
    limit = broadcast_limit(left, broadcast_bytes)
    sizes = measured_bytes(*[frame for frame, _, _ in lookups], limit=limit)
    remaining = [(size > limit, frame, _key_list(on), how) for (frame, on, how), size in zip(lookups, sizes)]
    steps, names = [], left.columns
    while remaining:
        ready = [i for i, (_, _, keys, _) in enumerate(remaining) if set(keys) <= set(names)]
        if not ready:
            raise ValueError(f"no lookup brings in the keys of {[keys for _, _, keys, _ in remaining]}")
        step = remaining.pop(min(ready, key=lambda i: remaining[i][0]))
        _, frame, keys, how = step
        names = keys + [c for c in names + ([] if how in _FILTERS else frame.columns) if c not in keys]
        steps.append(step)
    # any order gives the same rows if all keep to the left side's; a name that comes twice tells columns by their place
    free = len(set(names)) == len(names) and all(how in _SPREADABLE for _, _, _, how in steps)
    steps = _joined_lookups(left, steps) if free else steps
    out, joined = left, [left]
    while steps:
        ready = [i for i, (_, _, keys, _) in enumerate(steps) if set(keys) <= set(out.columns)]
        large, frame, keys, how = steps.pop(min(ready, key=lambda i: _moved(*steps[i])) if free else 0)
        if large:
            source = next((f for f in joined if set(keys) <= set(f.columns)), None)
            out = out.join(frame, keys, how) if source is None else spread_join(out, frame, keys, how, probe=source)
        else:
            out = out.join(F.broadcast(frame), keys, how)
        joined.append(frame)
    return out.select(names) if free else out


def _joined_lookups(left: DataFrame, steps: Sequence[tuple]) -> list[tuple]:
    """The steps, with large lookups joined to the large ones that bring in their keys, where that gives the same rows."""
    frames, merged = [frame for _, frame, _, _ in steps], set()
    for i in reversed(range(len(steps))):  # what others bring in comes before what needs it
        large, _, keys, how = steps[i]
        if not large or set(keys) <= set(left.columns):
            continue
        for j, (source_large, source, _, source_how) in enumerate(steps[:i]):
            if source_large and set(keys) <= set(source.columns) and (source_how == "inner" or source_how == how == "left"):
                frames[j] = spread_join(frames[j], frames[i], keys, how, probe=source)
                merged.add(i)
                break
    return [(large, frames[i], keys, how) for i, (large, _, keys, how) in enumerate(steps) if i not in merged]


def _moved(large: bool, frame: DataFrame, keys: Sequence[str], how: str) -> tuple[int, int]:
    """Place of a lookup among those at hand, so that what moves for the large ones is small."""
    brought = 0 if how in _FILTERS else len(frame.columns) - len(keys)
    return (1 if large else 2 if brought else 0), brought


def attach(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    *,
    broadcast_bytes: int | None = None,
    size: int | None = None,
    derived: bool = False,
) -> DataFrame:
    """Join with one lookup: by broadcast if it measures small, else as a spread join.

    ``size`` is the lookup's measured size, if it has been measured already. ``derived`` says that the left side is itself
    the result of joins or aggregations: it is not run to look for hot keys, which are left to Spark's adaptive skew split.
    """
    limit = broadcast_limit(left, broadcast_bytes)
    size = measured_bytes(right, limit=limit)[0] if size is None else size
    if size <= limit:
        return left.join(F.broadcast(right), _key_list(on), how)
    return left.join(right, _key_list(on), how) if derived else spread_join(left, right, on, how)
