"""Exact running counts and sums over an order, without sorting everything in one task.

The order key is cut into buckets of roughly equal size by Spark's range exchange (its edges come from a
sample and only balance the work). Each bucket is numbered by its own window, and starts where the totals
of the buckets before it end. The order key must be unique within its group, or the numbering is not determined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.sources.shared import checkpointed

#: Rows that one window partition is meant to sort, unless the session sets BUCKET_SETTING.
ROWS_PER_BUCKET = 1_000_000
BUCKET_SETTING = "spark.stratalake.rowsPerBucket"

_BUCKET = "__bucket"


def bucket_rows(df: DataFrame, given: int | None = None) -> int:
    """Rows per bucket: as given, else the session's setting, else the default."""
    return int(df.sparkSession.conf.get(BUCKET_SETTING, str(ROWS_PER_BUCKET))) if given is None else given


def with_order_bucket(df: DataFrame, key: str, rows: int, rows_per_bucket: int) -> DataFrame:
    """The stored rows with a bucket number that never decreases along the key; NULL keys come first, as in a sort.

    A bucket is a partition of Spark's range exchange, so there are as many as the rows ask for, whatever the key's type.
    The rows are stored because the exchange samples its edges: read twice, it might cut elsewhere the second time.
    """
    buckets = max(2, -(-rows // rows_per_bucket))
    return checkpointed(df.repartitionByRange(buckets, key).withColumn(_BUCKET, F.spark_partition_id()))


def running(
    df: DataFrame,
    order: str,
    value: Column | None = None,
    *,
    within: Sequence[str] = (),
    upto: str = "upto",
    total: str | None = None,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Add the running sum of ``value`` (the running count if None) including the row itself.

    ``within`` restarts it per group; ``total`` names a column for the group's whole sum. A group of any
    size is spread over the buckets of the order key. Beyond one bucket the frame is read for its count,
    for the exchange's sample and for the exchange, and stored once by bucket.
    """
    within = list(within)
    value = F.lit(1).cast("bigint") if value is None else value
    valued = df.withColumn("__value", value)
    rows, rows_per_bucket = df.count(), bucket_rows(df, rows_per_bucket)
    if rows <= rows_per_bucket:
        group = Window.partitionBy(*within)
        up_to_row = group.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        sums = [F.sum("__value").over(up_to_row).alias(upto)]
        return valued.select(*df.columns, *sums, *([F.sum("__value").over(group).alias(total)] if total else []))
    # A struct is equal to itself even where its fields are NULL, so rows of a NULL group keep their group.
    group = ["__group"] if within else []
    grouped = valued.withColumn("__group", F.struct(*within)) if within else valued
    marked = with_order_bucket(grouped, order, rows, rows_per_bucket)
    parts = marked.groupBy(*group, _BUCKET).agg(F.sum("__value").alias("__part"))
    # At most one row per group and bucket: a window holds a group's buckets, one for each million of all rows.
    by_bucket = Window.partitionBy(*group).orderBy(_BUCKET)
    starts = parts.select(
        *group, _BUCKET,
        F.coalesce(F.sum("__part").over(by_bucket.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"),
        F.sum("__part").over(Window.partitionBy(*group)).alias("__all"),
    )
    if within:
        # Each (group, bucket) is bucket-sized, so a plain join shares its shuffle with the window below.
        placed = marked.join(starts, group + [_BUCKET])
    else:
        placed = marked.join(F.broadcast(starts), _BUCKET)  # one row of numbers for each rows_per_bucket rows
    inside = Window.partitionBy(*group, _BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.sum("__value").over(inside) + F.col("__before")).alias(upto)]
    if total:
        sums.append(F.col("__all").alias(total))
    return placed.select(*df.columns, *sums)


def global_seq(
    df: DataFrame, key: str, out: str = "seq", *, start: int = 1, rows_per_bucket: int | None = None
) -> DataFrame:
    """Dense BIGINT numbers along a unique key: ``row_number() OVER (ORDER BY key)`` at any size."""
    numbered = running(df, key, upto="__upto", rows_per_bucket=rows_per_bucket)
    return numbered.select(*df.columns, (F.col("__upto") + (start - 1)).alias(out))


def index_in_group(
    df: DataFrame,
    group: str | Sequence[str],
    key: str,
    out: str = "idx",
    size: str = "qtd",
    *,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """0-based position of each row within its group along a key, and the size of the group."""
    groups = [group] if isinstance(group, str) else list(group)
    numbered = running(df, key, within=groups, upto="__upto", total=size, rows_per_bucket=rows_per_bucket)
    return numbered.select(*df.columns, (F.col("__upto") - 1).alias(out), size)


def cumulative_bounds(
    df: DataFrame,
    order: str,
    weight: str,
    lower: str = "lower",
    upper: str = "upper",
    *,
    rows_per_bucket: int | None = None,
) -> DataFrame:
    """Half-open interval ``[lower, upper)`` of each weight in the running total along a unique order."""
    summed = running(df, order, F.col(weight).cast("bigint"), upto=upper, rows_per_bucket=rows_per_bucket)
    return summed.select(*df.columns, (F.col(upper) - F.col(weight)).alias(lower), upper)


def pool_index(values: DataFrame, column: str, out: str = "idx", *, rows_per_bucket: int | None = None) -> DataFrame:
    """Distinct non-NULL values of a column with a dense 0-based index in sort order."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return global_seq(distinct, column, out, start=0, rows_per_bucket=rows_per_bucket)


def first_n(df: DataFrame, key: str, n: int, *, in_memory: int = 1_000_000) -> DataFrame:
    """The first ``n`` rows along a unique key, in its order.

    A top-n per task and a merge of n rows from each task, where that is at most ``in_memory`` rows. Beyond that the merge
    would be one large task, so the rows are numbered in parallel, filtered and sorted by ranges.
    """
    if n * max(1, df.rdd.getNumPartitions()) <= in_memory:
        return df.orderBy(key).limit(n)
    return global_seq(df, key, "__seq").where(F.col("__seq") <= n).drop("__seq").orderBy(key)


def top_k_per_group(
    counted: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """First ``k`` rows of each group; each task keeps k rows per group before anything is moved."""
    groups = [group] if isinstance(group, str) else list(group)
    ranked = counted.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("bigint"))
    return ranked.where(F.col(rank) <= k)
