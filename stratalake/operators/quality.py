"""Row rules of the silver layer and audits of keys, dependencies and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.operators.joins import attach


def silver_clean(df: DataFrame, foreign_key: str, status: str, cancelled: str) -> DataFrame:
    """Rows that have their foreign key and a status other than cancelled."""
    return df.where(F.col(foreign_key).isNotNull() & (F.col(status) != cancelled))


def rejected_counts(df: DataFrame, foreign_key: str, status: str, cancelled: str) -> DataFrame:
    """One row: all rows, and those without key, without status, cancelled and kept; each row counts once, in this order."""
    key, state = F.col(foreign_key), F.col(status)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(key.isNull()).alias("null_key"),
        F.count_if(key.isNotNull() & state.isNull()).alias("null_status"),
        F.count_if(key.isNotNull() & (state == cancelled)).alias("cancelled"),
        F.count_if(key.isNotNull() & (state != cancelled)).alias("kept"),
    )


def status_audit(df: DataFrame, foreign_key: str, status: str, names: Mapping[str, str], measure: str) -> DataFrame:
    """One row: row count, NULL keys, a count per status (``names``: column -> status) and the mean measure."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(foreign_key).isNull()).alias("null_fk"),
        *[F.count_if(F.col(status) == value).alias(name) for name, value in names.items()],
        F.round(F.avg(F.col(measure).cast("double")), 1).alias("mean_measure"),
    )


def orphan_audit(
    fact: DataFrame, foreign_key: str, dim: DataFrame, key: str, *, broadcast_bytes: int | None = None
) -> DataFrame:
    """One row: rows, NULL keys, rows and distinct keys whose parent is missing. A NULL key is no orphan.

    The fact is reduced to one row per key first, so a popular key costs no more than a rare one.
    """
    per_key = fact.groupBy(F.col(foreign_key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    parents = dim.select(F.col(key).alias("__key")).where(F.col("__key").isNotNull()).distinct()
    parents = parents.withColumn("__known", F.lit(True))
    judged = attach(per_key, parents, "__key", "left", broadcast_bytes=broadcast_bytes, derived=True)
    missing = F.col("__key").isNotNull() & F.col("__known").isNull()
    return judged.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("__key").isNull(), F.col("__n"))), F.lit(0)).alias("null_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("__n"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(missing).alias("orphan_keys"),
    )


def qualifying(
    child: DataFrame, parent: DataFrame, on: str, condition: Column, *, broadcast_bytes: int | None = None
) -> DataFrame:
    """Child rows that have a parent which meets the condition."""
    return attach(child, parent.where(condition).select(on), on, "left_semi", broadcast_bytes=broadcast_bytes)


def audit_unique(df: DataFrame, columns: Sequence[str], out: str = "n") -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def audit_fd(df: DataFrame, lhs: Sequence[str], rhs: Sequence[str], out: str = "n_values") -> DataFrame:
    """Left-hand keys that come with more than one right-hand value. NULL counts as a value."""
    pairs = df.groupBy(*lhs, F.struct(*rhs).alias("__rhs")).agg(F.lit(1).alias("__one"))
    return pairs.groupBy(*lhs).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def audit_distribution(df: DataFrame, column: str, declared: DataFrame, share: str = "share") -> DataFrame:
    """Observed share of each value next to its declared share; values on one side only are kept.

    ``declared`` holds the same column and the declared share.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    told = declared.select(column, F.col(share).cast("double").alias("declared"))
    both = counts.join(told, counts[column].eqNullSafe(told[column]), "full").select(
        F.coalesce(counts[column], told[column]).alias(column),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("declared", F.lit(0.0)).alias("declared"))
    observed = F.try_divide(F.col("n"), total)
    return both.select(
        column, "n", F.round(observed, 6).alias("observed"), "declared",
        F.round(observed - F.col("declared"), 6).alias("deviation"))


def _told_apart(field: T.StructField) -> Column:
    """Text that is equal for equal values of a column and differs for others."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("v"))))
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    return F.hex(c) if isinstance(field.dataType, T.BinaryType) else c.cast("string")


def profile(df: DataFrame, *, exact: bool = False) -> DataFrame:
    """One row per column: type, non-NULL and NULL counts, distinct values, smallest and largest as text.

    Distinct values are estimated by a sketch within the same pass as the other figures; ``exact=True`` counts them by one
    (column, value) grouping, which shuffles every cell. Nested values are told apart by their JSON, 0.0 equals -0.0.
    """
    fields = df.schema.fields
    figures = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        ordered = F.lit(None).cast("string") if isinstance(f.dataType, T.MapType) else c  # maps have no order
        figures += [F.count(c).alias(f"{f.name}__non_null"), F.count_if(c.isNull()).alias(f"{f.name}__nulls"),
                    F.min(ordered).cast("string").alias(f"{f.name}__min"),
                    F.max(ordered).cast("string").alias(f"{f.name}__max")]
        if not exact:
            figures.append(F.approx_count_distinct(c).alias(f"{f.name}__distinct"))
    wide = df.agg(*figures)
    entry = [
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"`{f.name}__non_null`").alias("non_null"), F.col(f"`{f.name}__nulls`").alias("nulls"),
            F.col(f"`{f.name}__min`").alias("min"), F.col(f"`{f.name}__max`").alias("max"),
            *([] if exact else [F.col(f"`{f.name}__distinct`").alias("distinct")]),
        )
        for f in fields
    ]
    rows = wide.select(F.inline(F.array(*entry)))
    if not exact:
        return rows
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), _told_apart(f).alias("value")) for f in fields
    ]))).where(F.col("value").isNotNull())
    distinct = values.groupBy("column", "value").agg(F.lit(1).alias("one")).groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"))
    return rows.join(F.broadcast(distinct), "column", "left").withColumn(  # one row per column of the frame
        "distinct", F.coalesce("distinct", F.lit(0)))
