"""The flagship flow: bronze orders with gaps, silver without them, silver 360 view, gold figures per site."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stratalake.operators.quality import silver_clean
from stratalake.plans.kpis import site_figures, site_view
from stratalake.plans.quality import orders_with_gaps
from stratalake.plans.registry import Tables
from stratalake.sources.lake import Lake
from stratalake.sources.shared import new_folder


def gold_by_site(spark: SparkSession, folder: str) -> DataFrame:
    """Each layer is written as a table, and the next one starts from that table."""
    t = Tables(spark, folder)
    lake = Lake(spark, new_folder(spark, "flagship"), f"flagship_{uuid.uuid4().hex[:8]}").setup()
    bronze = lake.promote(orders_with_gaps(t), "bronze", "orders")
    silver = lake.promote(silver_clean(bronze, "fk", "o_orderstatus", "P"), "silver", "orders")
    view = lake.promote(site_view(t, silver.withColumnRenamed("fk", "o_custkey")), "silver", "orders_360")
    return lake.promote(site_figures(t, view), "gold", "kpi_by_site")
