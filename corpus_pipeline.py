"""A corpus from raw documents to packed sequences, in stages that each read what the one before kept.

Every stage takes (spark, docs, folder of the tables) and returns a frame; all but the last return the columns of
``docs``. Columns beyond doc_id, text and n_chars travel along unread, whatever their names. Empty tables pass through as
empty tables; null texts count as empty; rows without a doc_id are never anyone's duplicate or copy and stay until they
are packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, packing, quality, simhash, substrings
from stratalake.llm.common import plain_names, small_batches, stored
from stratalake.operators.joins import attach

#: SQL cannot express the ranking, the fingerprints or the packing: the tests hold each stage against brute force.
ORACLE_SQL = None


def _plain(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with names that no operator uses, and those of doc_id and text."""
    small_batches(docs.sparkSession)
    names = [c.lower() for c in docs.columns]
    return plain_names(docs), f"c{names.index('doc_id')}", f"c{names.index('text')}"


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id is among ``ids`` (one column)."""
    plain, id, _ = _plain(docs)
    gone = ids.toDF(id)
    gone = stored(gone.where(F.col(id).isNotNull()).distinct(), "gone")
    return attach(plain, gone, id, "left_anti").select(*plain.columns).toDF(*docs.columns)


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the ranking learned from ``labels`` does not reject."""
    plain, _, text = _plain(docs)
    ranking = quality.fit(docs.select("doc_id", "text"), spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet").select("doc_id", "quality"))
    return quality.scored(plain, ranking, text).where("predicted = 1").drop("score", "predicted").toDF(*docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each component of documents whose fingerprints differ in few bits the one with the smallest id."""
    small_batches(spark)
    found = simhash.near_duplicates(docs.select("doc_id", "text"))
    return _without(docs, found.where("doc_id != component_id").select("doc_id"))


def no_repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without words of passages that also start earlier; texts that lose none are left as they are."""
    plain, id, text = _plain(docs)
    found = substrings.dedup(plain, id, text)
    cut = F.col("n_removed") > 0
    new = {text: F.when(cut, F.col("kept")).otherwise(F.col(text))}
    for own, name in zip(plain.columns, docs.columns, strict=True):
        if name.lower() == "n_chars":
            new[own] = F.when(cut, F.length("kept").cast(plain.schema[own].dataType)).otherwise(F.col(own))
    return found.withColumns(new).select(*plain.columns).toDF(*docs.columns)


def no_test_items(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    small_batches(spark)
    items = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contaminated(docs.select("doc_id", "text"), items)
    return _without(docs, found.select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The place of every piece of every document's tokens, with a checksum of its ids."""
    small_batches(spark)
    pieces = packing.token_pieces(docs.select("doc_id", "text"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [
    ("quality", good_quality), ("near_duplicates", no_near_copies), ("repeated_passages", no_repeated_passages),
    ("decontamination", no_test_items), ("packing", packed)]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on ``documents``, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), f"corpus-{name}")
    return docs
