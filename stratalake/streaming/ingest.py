"""Incremental ingest of a landing directory: each run takes only files it has not seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.sources.contract import REASONS, Contract, judged
from stratalake.sources.gold import IncrementalGold
from stratalake.sources.landing import scan_by_name

_CORRUPT = "_corrupt"


#: Columns of a listing of files.
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


class IncrementalIngest:
    """Landing directory -> bronze files, with the contract checked on the way.

    The stream lists files without reading them; its checkpoint remembers which were taken. Each micro-batch reads its
    files by their headers: columns may stand in any order, and the lines of a file whose header does not name the
    contract's columns go to quarantine while the stream goes on. A micro-batch replaces the folder of its own batch
    number, so one that is repeated after a failure leaves the same rows. Accepted and refused rows are written in one
    pass, told apart by the ``verdict`` folder level.
    """

    def __init__(
        self, spark: SparkSession, landing: str, target: str, checkpoint: str, contract: Contract, *,
        files_per_batch: int = 1_000,
    ):
        self.spark, self.landing, self.target = spark, landing, target.rstrip("/")
        self.checkpoint, self.contract, self.files_per_batch = checkpoint, contract, files_per_batch

    def run(self) -> None:
        """Take all files that have arrived since the last run, then stop."""
        arriving = (
            self.spark.readStream.format("binaryFile").schema(_FILES)
            .option("maxFilesPerTrigger", self.files_per_batch)
            .load(self.landing)
            .select(F.col("_metadata.file_path").alias("file"))
        )
        query = (
            arriving.writeStream.foreachBatch(self._write_batch)
            .option("checkpointLocation", self.checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def _write_batch(self, batch: DataFrame, batch_id: int) -> None:
        files = sorted(r["file"] for r in batch.collect())  # at most files_per_batch paths
        rows = scan_by_name(self.spark, files, self.contract, _CORRUPT) if files else self.spark.createDataFrame([], self.contract.raw_schema(_CORRUPT))
        raw = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*self.contract.names)))
        checked = judged(rows.withColumn("_raw", raw), self.contract, keep=["_raw"], corrupt=_CORRUPT)
        good = F.size(REASONS) == 0
        kept = checked.withColumn("_raw", F.when(~good, F.col("_raw"))).withColumn(
            "verdict", F.when(good, "good").otherwise("quarantine"))
        kept.write.mode("overwrite").partitionBy("verdict").parquet(f"{self.target}/batch_id={batch_id}")

    def _read(self, verdict: str) -> DataFrame:
        columns = ", ".join(f"`{f.name}` {f.type}" for f in self.contract.fields)
        schema = f"{columns}, _raw string, {REASONS} array<string>, batch_id bigint, verdict string"
        try:
            stored = self.spark.read.schema(schema).option("basePath", self.target).parquet(self.target)
        except AnalysisException as e:  # no run has met a file yet
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], schema)
        return stored.where(F.col("verdict") == verdict)

    def batch_ids(self) -> list[int]:
        """The batches that hold accepted rows."""
        told = self._read("good").select("batch_id").distinct().collect()  # a row per batch; the number is a folder name
        return sorted(r["batch_id"] for r in told)

    def good(self) -> DataFrame:
        return self._read("good").select(*self.contract.names, "batch_id")

    def quarantine(self) -> DataFrame:
        """Refused rows with the reasons: the landed fields as JSON, or the line itself if it has other fields."""
        return self._read("quarantine").select("_raw", REASONS, "batch_id")


def follow(ingest: IncrementalIngest, figures: IncrementalGold, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Bring a gold table up to the batches that an ingest has taken: only rows of new batches are read.

    ``prepare`` makes the rows that figures are computed from, say by joining dimensions. Repeated after a failure it
    leaves the same figures, as a batch's states replace themselves.
    """
    new = [b for b in ingest.batch_ids() if str(b) not in figures.batches()]
    rows = ingest.good()
    return figures.refresh({str(b): prepare(rows.where(F.col("batch_id") == b)) for b in new})
