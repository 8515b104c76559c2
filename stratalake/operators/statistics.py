"""Tests of an association: correlation of ranks, and the chi-square statistic of a cross-tabulation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.operators.joins import attach
from stratalake.operators.sequence import running
from stratalake.sources.shared import checkpointed


def average_ranks(df: DataFrame, column: str, *, rows_per_bucket: int | None = None) -> DataFrame:
    """Rows (value, n, rank): each value that occurs, how often, and the mean of the places that its rows take in the order.

    Values are counted first, so ties cost one row and the order runs over different values, in buckets of the key.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = running(checkpointed(counted), "value", F.col("n"), upto="upto", rows_per_bucket=rows_per_bucket)
    return placed.select("value", "n", (F.col("upto") - (F.col("n") - 1) / 2).alias("rank"))


def rank_correlation(df: DataFrame, x: str, y: str, digits: int = 6, *, rows_per_bucket: int | None = None) -> DataFrame:
    """One row (n, rank_corr): Spearman's coefficient over rows where both are known, ties at their average rank.

    Rows are counted by pair of values before ranks are joined to them, and the coefficient comes from sums over pairs.
    """
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = checkpointed(known.groupBy(F.col(x).alias("__x"), F.col(y).alias("__y")).agg(F.count("*").alias("__n")))
    ranked = pairs
    for own, column, name in (("__x", x, "__rx"), ("__y", y, "__ry")):
        ranks = average_ranks(known, column, rows_per_bucket=rows_per_bucket)
        ranked = attach(ranked, ranks.select(F.col("value").alias(own), F.col("rank").alias(name)), own, derived=own == "__y")
    n, a, b = F.col("__n").cast("double"), F.col("__rx"), F.col("__ry")
    sums = ranked.agg(F.sum("__n").alias("n"), F.sum(n * a).alias("sa"), F.sum(n * b).alias("sb"), F.sum(n * a * a).alias("aa"),
                      F.sum(n * b * b).alias("bb"), F.sum(n * a * b).alias("ab"))
    spread = F.sqrt(F.expr("(aa - sa * sa / n) * (bb - sb * sb / n)"))
    return sums.select(F.coalesce("n", F.lit(0)).alias("n"), F.round(F.try_divide(F.expr("ab - sa * sb / n"), spread), digits).alias("rank_corr"))


def chi_square(df: DataFrame, row: str, column: str, digits: int = 6) -> DataFrame:
    """One row (n, chi_square, freedom, cramers_v) of the cross-tabulation of two columns; rows where one is NULL do not count.

    ``cramers_v`` is the strength of the association from 0 to 1; NULL where a column has a single value.
    """
    known = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    cells = checkpointed(known.groupBy(F.col(row).alias("r"), F.col(column).alias("c")).agg(F.count("*").alias("o")))
    by_row = cells.groupBy("r").agg(F.sum("o").alias("nr"))
    by_column = cells.groupBy("c").agg(F.sum("o").alias("nc"))
    # sum of (o - e)^2 / e over all cells, empty ones too, is n * (sum of o^2 / (nr * nc) - 1)
    placed = attach(attach(cells, by_row, "r"), by_column, "c", derived=True)
    sums = placed.agg(F.sum("o").alias("n"), F.sum(F.col("o").cast("double") * F.col("o") / F.col("nr") / F.col("nc")).alias("s"))
    rows, columns = by_row.agg(F.count("*").alias("n")).scalar(), by_column.agg(F.count("*").alias("n")).scalar()
    told = sums.select("n", "s", rows.alias("rows"), columns.alias("columns"))
    least = F.least("rows", "columns") - 1
    return told.select(
        F.coalesce("n", F.lit(0)).alias("n"), F.round(F.expr("n * (s - 1)"), digits).alias("chi_square"),
        F.expr("if(n is null, 0, (rows - 1) * (columns - 1))").alias("freedom"),
        F.round(F.sqrt(F.try_divide(F.greatest(F.col("s") - 1, F.lit(0.0)), least)), digits).alias("cramers_v"))
