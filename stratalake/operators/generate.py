"""Row drivers and literal relations for generated data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def id_range(spark: SparkSession, low: int, high: int, name: str = "id", parts: int | None = None) -> DataFrame:
    """Consecutive BIGINT ids ``low..high``, generated in parallel."""
    return spark.range(low, high + 1, 1, parts).select(F.col("id").alias(name))


def pool(spark: SparkSession, values: Sequence[str], column: str = "value", position: str = "idx") -> DataFrame:
    """A literal pool as rows, with the 0-based position of each value in sort order."""
    literals = F.sort_array(F.array(*[F.lit(v) for v in values]))
    return spark.range(1).select(F.posexplode(literals).alias(position, column))


def inline(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """Literal relation with named columns; types follow the Python values."""
    return spark.createDataFrame(list(rows), list(columns))


def load_static(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Literal dimension under a declared schema; a NULL in a required column is refused by Spark."""
    return spark.createDataFrame(list(rows), schema)
