"""Registered queries: tables that are replaced while they are read, and gold figures refreshed batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stratalake.plans.landing import EVENTS
from stratalake.plans.registry import Tables, query
from stratalake.sources import gold as G
from stratalake.sources.lake import Lake
from stratalake.sources.landing import sink_landing
from stratalake.sources.shared import new_folder
from stratalake.streaming.ingest import IncrementalIngest, follow


def _lake(t: Tables, name: str) -> Lake:
    return Lake(t.spark, new_folder(t.spark, name), f"{name}_{uuid.uuid4().hex[:8]}").setup()


@query("table_replaced_whole", """
    WITH half AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0)
    SELECT 'first' AS seen, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys FROM half UNION ALL
    SELECT 'after a failure', count(*), CAST(sum(o_custkey) AS BIGINT) FROM half UNION ALL
    SELECT 'by a reader that began before', count(*), CAST(sum(o_custkey) AS BIGINT) FROM half UNION ALL
    SELECT 'replaced', count(*), CAST(sum(o_custkey) AS BIGINT) FROM orders UNION ALL
    SELECT 'restored', count(*), CAST(sum(o_custkey) AS BIGINT) FROM half""")
def table_replaced_whole(t: Tables):
    """One table through a rebuild that fails half-way, one that succeeds and changes its columns, and a step back."""
    lake = _lake(t, "replaced")

    def state(df, seen: str):
        return df.agg(F.lit(seen).alias("seen"), F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))

    first = lake.sink_table(t.orders.where("o_orderkey % 2 = 0").select("o_orderkey", "o_custkey"), "silver", "orders")
    before = lake.current("silver", "orders")
    seen = [state(first, "first")]
    broken = F.when(F.col("o_orderkey") % 2 == 1, F.raise_error(F.lit("a delivery broke off")).cast("bigint")).otherwise(F.col("o_custkey"))
    try:
        lake.sink_table(t.orders.select("o_orderkey", broken.alias("o_custkey")), "silver", "orders")
    except Exception as e:
        if "a delivery broke off" not in str(e):
            raise
    seen.append(state(lake.table("silver", "orders"), "after a failure"))
    reader = lake.table("silver", "orders")
    seen.append(state(lake.sink_table(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), "silver", "orders"), "replaced"))
    seen.append(state(reader, "by a reader that began before"))
    seen.append(state(lake.restore("silver", "orders", before), "restored"))
    out = seen[0]
    for s in seen[1:]:
        out = out.unionAll(s)
    return out


@query("gold_incremental", """
    SELECT l_suppkey, count(*) AS n_lines, CAST(count(*) FILTER (l_returnflag = 'R') AS BIGINT) AS n_returned,
      round(avg(l_quantity), 4) AS mean_quantity, sum(l_quantity) AS quantity, min(l_quantity) AS least, max(l_quantity) AS most,
      count(DISTINCT l_orderkey) AS n_orders, true AS parts_within
    FROM lineitem GROUP BY 1""")
def gold_incremental(t: Tables):
    """Three deliveries of lines, the second one delivered in part first; figures come from stored states alone."""
    lake = _lake(t, "refreshed")
    figures = G.IncrementalGold(lake, "lines_by_supplier", ["l_suppkey"], {
        "n_lines": G.rows(), "n_returned": G.rows(F.col("l_returnflag") == "R"), "mean_quantity": G.mean("l_quantity"),
        "quantity": G.total("l_quantity"), "least": G.least("l_quantity"), "most": G.most("l_quantity"),
        "n_orders": G.distinct("l_orderkey"), "parts": G.distinct("l_partkey"), "parts_sketched": G.sketched("l_partkey")})
    lines = t.lineitem.select("l_suppkey", "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    drop = [lines.where(F.col("l_orderkey") % 3 == k) for k in range(3)]
    figures.refresh({"0": drop[0], "1": drop[1].where("l_partkey % 2 = 0")})
    figures.refresh({"1": drop[1]})
    out = figures.refresh({"2": drop[2]})
    near = F.abs(F.col("parts_sketched") - F.col("parts")) <= 1 + 0.08 * F.col("parts")  # five standard errors
    return out.withColumn("parts_within", near).drop("parts", "parts_sketched")


@query("gold_compacted", """
    SELECT o_orderpriority, o_orderstatus, count(*) AS n, count(DISTINCT o_custkey) AS n_people,
      CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1, 2""")
def gold_compacted(t: Tables):
    """Deliveries by month of the order; those of the first half of a year are merged into one, then the rest arrive."""
    figures = G.IncrementalGold(_lake(t, "compacted"), "orders_by_status", ["o_orderpriority", "o_orderstatus"], {
        "n": G.rows(), "n_people": G.distinct("o_custkey"), "latest": G.most(F.col("o_orderdate").cast("date"))})
    month = F.month("o_orderdate")
    figures.refresh({str(m): t.orders.where(month == m) for m in (1, 2, 3)})
    figures.compact("first quarter", ["1", "2", "3"])
    return figures.refresh({"rest": t.orders.where(month > 3)})


@query("gold_from_deliveries", """
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, round(avg(value), 4) AS mean_value, min(event_id) AS first_event
    FROM events WHERE value >= 0 AND event_id % 4 < 3 GROUP BY 1""")
def gold_from_deliveries(t: Tables):
    """Four deliveries land one by one; after each the gold table takes the rows of the new batch alone. The last lacks a column."""
    base = new_folder(t.spark, "follow")
    ingest = IncrementalIngest(t.spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint", EVENTS)
    figures = G.IncrementalGold(_lake(t, "followed"), "events_by_type", ["event_type"], {
        "n": G.rows(), "n_users": G.distinct("user_id"), "mean_value": G.mean(F.col("value").cast("decimal(18,6)")), "first_event": G.least("event_id")})
    out = None
    for k in range(4):
        columns = EVENTS.names if k < 3 else EVENTS.names[:-1]
        sink_landing(t.events.where(F.col("event_id") % 4 == k).select(*columns), f"{base}/landing", append=True)
        ingest.run()
        out = follow(ingest, figures, lambda df: df.where("value >= 0"))
    return out
