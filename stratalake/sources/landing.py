"""Landing directories of headered CSV part files."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.sources.contract import Contract

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
#: Lines behind the header as they stand: a separator that text does not hold, and no quotes.
_WHOLE_LINES = {"header": "true", "sep": "\x01", "quote": "", "escape": "", "mode": "PERMISSIVE"}


def sink_landing(
    df: DataFrame, path: str, *, order_by: str | None = None, partition_by: str | None = None, append: bool = False
) -> str:
    """Replace the directory by the frame's rows, or add files to it; ``order_by`` orders rows across files."""
    ordered = df.orderBy(order_by) if order_by else df
    writer = ordered.write.mode("append" if append else "overwrite").options(**CSV_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.csv(path)
    return path


def scan_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    corrupt: str | None = None,
    mode: str = "PERMISSIVE",
    multiline: bool = False,
) -> DataFrame:
    """Rows of all part files under an explicit schema; types are never guessed.

    A file whose header names other columns, or the same in another order, stops the read: ``scan_by_name`` takes those.

    ``corrupt`` names a text column of the schema for lines that do not fit. An empty field reads as NULL,
    so an empty string does not survive. ``multiline`` is needed for line breaks inside fields and makes a
    file one task, so it stays off unless asked for.
    """
    reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", mode).option("multiLine", multiline)
    reader = reader.option("enforceSchema", "false")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.csv(path)


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Rows (file, header): the first line of each file that has one.

    A session of its own reads every file in tasks of its own, and a task stops after its first rows, so no more than the
    beginning of each block is read.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = apart.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"), F.col("_metadata.file_block_start").alias("start"))

    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    return lines.mapInArrow(first, lines.schema).where("start = 0").select("file", "header")


def scan_by_name(spark: SparkSession, path: str | Sequence[str], contract: Contract, corrupt: str) -> DataFrame:
    """The contract's columns as text, found by the names in each file's header, and ``corrupt`` for lines that do not fit.

    Files are read in groups of equal headers. Lines after the header of files whose header lacks a column of the
    contract, has another one or names one twice are returned whole in ``corrupt``, so they end in quarantine. Only the
    first line of each file is read to tell the groups; the files' paths come to the driver, which lists them anyway.
    """
    groups: dict[str, list[str]] = {}
    for file, header in file_headers(spark, path).collect():
        groups.setdefault(header, []).append(file)
    names, out = contract.names, None
    for header in sorted(groups):
        files = sorted(groups[header])
        columns = next(csv.reader([header.lstrip("\ufeff")]), [])
        if sorted(columns) == sorted(names):
            schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, corrupt]])
            rows = spark.read.schema(schema).options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", corrupt).csv(files)
        else:
            rows = spark.read.schema(f"`{corrupt}` string").options(**_WHOLE_LINES).csv(files)
            rows = rows.withColumns({c: F.lit(None).cast("string") for c in names})
        rows = rows.select(*names, corrupt)
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else spark.createDataFrame([], contract.raw_schema(corrupt))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file under a directory: path, bytes, time of change. Empty files are listed; no content is read.

    Files and folders whose names begin with ``_`` or ``.`` are not data and not listed.
    """
    options = {"recursiveFileLookup": "true"}
    told = spark.read.format("binaryFile").options(**options).load(path).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified"))
    every = spark.read.format("binaryFile").options(**options).load(path).inputFiles()  # the driver's own listing, empty files included
    listed = spark.createDataFrame([(f,) for f in every], "listed string")
    plain = F.regexp_replace("listed", "^([a-z0-9]+):/+", "$1:/")
    same = F.regexp_replace("file_path", "^([a-z0-9]+):/+", "$1:/") == plain
    joined = listed.join(told, same, "left")
    return joined.select(F.coalesce("file_path", "listed").alias("file_path"), F.coalesce("file_size", F.lit(0)).alias("file_size"), "modified")


def landing_inventory(spark: SparkSession, path: str, scanned: DataFrame) -> DataFrame:
    """``list_files`` with the number of rows that a scan of the same directory finds in each, 0 where it finds none."""
    counted = file_inventory(scanned).select("file_path", "n_rows")
    return list_files(spark, path).join(counted, "file_path", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))


def file_inventory(df: DataFrame) -> DataFrame:
    """One row per file behind a scanned frame: path, bytes, rows."""
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
