"""Bronze, silver and gold databases with tables under one shared root."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.sources.contract import Contract, enforce_strict

LAYERS = {
    "bronze": "Raw data as it came from its source",
    "silver": "Clean, checked and aligned data",
    "gold": "Aggregated figures ready for reports",
}


#: Between a table's name and the number of one of its versions.
_VERSION = "__v"
_CURRENT = "stratalake.version"


class Lake:
    """Layered tables. The catalog level of a three-part name is a prefix of the database names.

    A table is a view of its newest version. Every rebuild writes a version of its own and then points the view at it in
    one step of the catalog, so a rebuild that fails half-way leaves the table as it was, and a reader that has begun
    keeps reading one version. Older versions stay until ``vacuum`` removes them.
    """

    def __init__(self, spark: SparkSession, root: str, name: str = "lake"):
        self.spark, self.root, self.name = spark, root.rstrip("/"), name

    def setup(self) -> Lake:
        """Create the layers; safe to repeat."""
        for layer, comment in LAYERS.items():
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} COMMENT '{comment}' "
                f"LOCATION '{self.root}/{layer}'")
        return self

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer!r}")
        return f"{self.name}_{layer}"

    def table_name(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def landing(self, name: str) -> str:
        """Directory for raw files of one dataset."""
        return f"{self.root}/landing_zone/{name}"

    def table(self, layer: str, name: str) -> DataFrame:
        return self.spark.table(self.table_name(layer, name))

    def use(self, layer: str) -> DataFrame:
        """Make a layer the session's default, so its tables need no prefix; returns catalog and schema in use."""
        self.spark.catalog.setCurrentDatabase(self.database(layer))
        return self.spark.sql("SELECT current_catalog() AS catalog, current_schema() AS schema")

    def tables(self, layer: str) -> DataFrame:
        """The tables of a layer, without their versions."""
        return self.spark.sql(f"SHOW TABLES IN {self.database(layer)}").where(~F.col("tableName").contains(_VERSION))

    def versions(self, layer: str, name: str) -> list[str]:
        """The stored versions of a table, oldest first."""
        found = self.spark.sql(f"SHOW TABLES IN {self.database(layer)} LIKE '{name.lower()}{_VERSION}*'").collect()  # a row per version
        return sorted(r["tableName"] for r in found if re.fullmatch(re.escape(name.lower()) + _VERSION + "[0-9]+_[0-9a-f]+", r["tableName"]))

    def current(self, layer: str, name: str) -> str:
        """The version that a table shows."""
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.table_name(layer, name)} ('{_CURRENT}')").first()["value"]

    def restore(self, layer: str, name: str, version: str, comment: str = "") -> DataFrame:
        """Point a table at one of its versions."""
        if version not in self.versions(layer, name):
            raise ValueError(f"{name!r} has no version {version!r}")
        told = comment.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.table_name(layer, name)} COMMENT '{told}' TBLPROPERTIES ('{_CURRENT}' = '{version}') "
                       f"AS SELECT * FROM {self.table_name(layer, version)}")
        return self.table(layer, name)

    def vacuum(self, layer: str, name: str, keep: int = 1) -> list[str]:
        """Remove all versions but the current one and the ``keep`` newest others; returns their names.

        Frames that still read a removed version fail, so keep as many as the longest reader may be behind.
        """
        shown = self.current(layer, name)
        others = [v for v in self.versions(layer, name) if v != shown]
        gone = others[:len(others) - keep] if keep else others
        for version in gone:
            self.spark.sql(f"DROP TABLE {self.table_name(layer, version)}")
        return gone

    def describe(self, layer: str, name: str) -> DataFrame:
        """Columns, comments and storage details of a table."""
        return self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.table_name(layer, name)}")

    def sink_table(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        contract: Contract | None = None,
        *,
        comment: str = "",
        partition_by: Sequence[str] = (),
        bucket_by: tuple[int, str] | None = None,
    ) -> DataFrame:
        """Create or replace a table and return it. A contract fixes columns and types and refuses bad rows.

        The table shows its old rows until all new ones are written; columns may change from version to version.
        ``bucket_by`` stores the rows by a join key, so joins and groupings on it need no shuffle.
        """
        if contract:
            df = enforce_strict(df, contract)
            df = df.select(*[
                F.col(f.name).alias(f.name, metadata={"comment": f.comment}) if f.comment else F.col(f.name)
                for f in contract.fields
            ])
        version = f"{name}{_VERSION}{time.time_ns():020d}_{uuid.uuid4().hex[:6]}".lower()
        writer = df.write.mode("errorifexists").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
        writer.saveAsTable(self.table_name(layer, version))
        return self.restore(layer, name, version, comment)

    def promote(self, df: DataFrame, layer: str, name: str, **options) -> DataFrame:
        """Rebuild a table of a layer in full; the table read back has no lineage before it."""
        return self.sink_table(df, layer, name, **options)

    def drop(self) -> None:
        """Remove the databases, the tables and their versions; landed files stay."""
        for layer in LAYERS:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")
