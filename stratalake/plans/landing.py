"""Registered queries: landing directories, tables, repeated runs and incremental ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stratalake.plans import sql_parts as S
from stratalake.plans.registry import Tables, query
from stratalake.sources.contract import Contract, enforce
from stratalake.sources.lake import Lake
from stratalake.sources.landing import file_inventory, landing_inventory, scan_by_name, scan_landing, sink_landing
from stratalake.sources.shared import new_folder
from stratalake.streaming.ingest import IncrementalIngest

ORDERS = Contract.of("o_orderkey bigint!", "o_custkey bigint!", "o_orderstatus string!", "o_totalprice double!",
                     "order_date date!", "o_orderpriority string!")
CUSTOMERS = Contract.of("c_custkey bigint!", "c_name string!", "c_nationkey int!", "c_acctbal double!",
                        "c_mktsegment string!", comments={"c_custkey": "Primary key"})
EVENTS = Contract.of("event_id bigint!", "user_id bigint!", "event_type string!", "value double!")


def _orders(t: Tables):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           F.col("o_orderdate").cast("date").alias("order_date"), "o_orderpriority")


def _price_sum():
    return F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")


@query("csv_roundtrip", f"""
    SELECT o_orderpriority, count(*) AS n, {S.money('o_totalprice')} AS sum_price,
      min(CAST(o_orderdate AS DATE)) AS first_date, max(CAST(o_orderdate AS DATE)) AS last_date
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def csv_roundtrip(t: Tables):
    path = sink_landing(_orders(t), new_folder(t.spark, "csv"), order_by="o_orderkey")
    landed = scan_landing(t.spark, path, ORDERS.schema())
    return landed.where(F.col("o_orderstatus") == "F").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), _price_sum().alias("sum_price"),
        F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))


@query("csv_header_order", """
    WITH e AS (SELECT *, event_id % 4 AS delivery FROM events)
    SELECT event_type, count(*) FILTER (delivery < 3) AS n_good, CAST(sum(user_id) FILTER (delivery < 3) AS BIGINT) AS sum_users,
      (SELECT count(*) FROM e WHERE delivery = 3) AS n_quarantined
    FROM e GROUP BY event_type HAVING count(*) FILTER (delivery < 3) > 0""")
def csv_header_order(t: Tables):
    """Three deliveries with the contract's columns in different orders, and one that lacks a column."""
    path = new_folder(t.spark, "headers")
    orders = [["event_id", "user_id", "event_type", "value"], ["value", "event_type", "user_id", "event_id"],
              ["event_type", "event_id", "value", "user_id"], ["event_id", "event_type", "value"]]
    for k, columns in enumerate(orders):
        sink_landing(t.events.where(F.col("event_id") % 4 == k).select(*columns), f"{path}/delivery={k}")
    good, broken = enforce(scan_by_name(t.spark, path, EVENTS, "_line"), EVENTS, "_line")
    counted = good.groupBy("event_type").agg(F.count("*").alias("n_good"), F.sum("user_id").alias("sum_users"))
    return counted.withColumn("n_quarantined", broken.agg(F.count("*").alias("n")).scalar())


@query("file_inventory", """
    SELECT o_orderstatus AS folder, count(*) AS n_rows, true AS has_bytes FROM orders GROUP BY 1""")
def inventory(t: Tables):
    path = sink_landing(_orders(t), new_folder(t.spark, "inventory"), partition_by="o_orderstatus")
    files = file_inventory(scan_landing(t.spark, path, ORDERS.schema()))
    folder = F.regexp_extract("file_path", "o_orderstatus=([^/]+)", 1)
    return files.groupBy(folder.alias("folder")).agg(
        F.sum("n_rows").alias("n_rows"), (F.min("file_size") > 0).alias("has_bytes"))


@query("landing_inventory", """
    SELECT delivery, n_files, n_rows, has_bytes FROM (
      SELECT 'orders ' || o_orderstatus AS delivery, CAST(1 AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_rows, true AS has_bytes
        FROM orders GROUP BY o_orderstatus UNION ALL
      SELECT 'header only', 1, 0, true UNION ALL SELECT 'empty', 1, 0, false)""")
def inventory_of_all(t: Tables):
    """A file per status, one with nothing but a header, and one without a byte."""
    path = new_folder(t.spark, "inventory")
    statuses = [r[0] for r in t.orders.select("o_orderstatus").distinct().collect()]
    for status in statuses:
        sink_landing(_orders(t).where(F.col("o_orderstatus") == status).coalesce(1), f"{path}/orders {status}")
    head = t.spark.createDataFrame([(",".join(ORDERS.names),)], "value string")
    head.coalesce(1).write.text(f"{path}/header only")
    t.spark.createDataFrame([], "value string").coalesce(1).write.text(f"{path}/empty")
    schema = ORDERS.schema()
    scanned = t.spark.read.schema(schema).option("header", "true").option("recursiveFileLookup", "true").csv(path)
    files = landing_inventory(t.spark, path, scanned)
    folder = F.regexp_extract(F.url_decode("file_path"), "/([^/]+)/[^/]+$", 1)
    return files.groupBy(folder.alias("delivery")).agg(
        F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"), (F.min("file_size") > 0).alias("has_bytes"))


@query("sink_table_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_table_roundtrip(t: Tables):
    lake = Lake(t.spark, new_folder(t.spark, "tables"), f"roundtrip_{uuid.uuid4().hex[:8]}").setup()
    return lake.sink_table(t.customer, "bronze", "customers", CUSTOMERS, comment="Customer register")


@query("rerun_idempotent", f"""
    SELECT run, n, n_keys, sum_price FROM (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS n_keys,
      {S.money('o_totalprice')} AS sum_price FROM orders) CROSS JOIN (VALUES (1), (2)) AS r(run)""")
def rerun_idempotent(t: Tables):
    path = new_folder(t.spark, "rerun")

    def state(run: int):
        sink_landing(_orders(t), path)
        return scan_landing(t.spark, path, ORDERS.schema()).agg(
            F.lit(run).alias("run"), F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("n_keys"),
            _price_sum().alias("sum_price"))

    first = state(1)
    after_first = t.spark.createDataFrame(first.collect(), first.schema)  # one row, fixed before the second run
    return after_first.unionAll(state(2))


@query("incremental_ingest", "SELECT event_id, user_id, event_type, value FROM events")
def incremental_ingest(t: Tables):
    base = new_folder(t.spark, "ingest")
    landing = f"{base}/landing"
    ingest = IncrementalIngest(t.spark, landing, f"{base}/bronze", f"{base}/checkpoint", EVENTS)
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    third = (last - first) / 3
    delivery = F.when(F.col("ts") < F.lit(first + third), 0).when(F.col("ts") < F.lit(first + 2 * third), 1).otherwise(2)
    for number in range(3):  # deliveries by time that together hold every event
        sink_landing(t.events.where(delivery == number).select(*EVENTS.names), landing, append=True)
        ingest.run()
    return ingest.good().drop("batch_id")


@query("ingest_drift", """
    WITH e AS (SELECT *, event_id % 4 AS delivery FROM events)
    SELECT 'good' AS verdict, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users, CAST(count(DISTINCT delivery) AS BIGINT) AS n_deliveries
      FROM e WHERE delivery < 3 UNION ALL
    SELECT 'quarantine', count(*), NULL, CAST(count(DISTINCT delivery) AS BIGINT) FROM e WHERE delivery = 3""")
def ingest_drift(t: Tables):
    """Four deliveries to one stream: the second with its columns in another order, the last without one of them."""
    base = new_folder(t.spark, "drift")
    ingest = IncrementalIngest(t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", EVENTS)
    orders = [EVENTS.names, EVENTS.names[::-1], EVENTS.names, EVENTS.names[:-1]]
    for k, columns in enumerate(orders):
        sink_landing(t.events.where(F.col("event_id") % 4 == k).select(*columns), f"{base}/landing", append=True)
        ingest.run()
    users = F.sum("user_id").alias("users")
    good = ingest.good().agg(F.lit("good").alias("verdict"), F.count("*").alias("n"), users, F.count_distinct("batch_id").alias("n_deliveries"))
    broken = ingest.quarantine().agg(F.lit("quarantine").alias("verdict"), F.count("*").alias("n"), F.lit(None).cast("bigint").alias("users"),
                                     F.count_distinct("batch_id").alias("n_deliveries"))
    return good.unionByName(broken)
