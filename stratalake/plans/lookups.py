"""Registered queries: pools, draws, intervals, positions and running totals."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from stratalake.functions.draws import draw
from stratalake.operators import lookup as L
from stratalake.operators import sequence as Q
from stratalake.operators.generate import inline, load_static, pool
from stratalake.operators.joins import attach
from stratalake.plans import sql_parts as S
from stratalake.plans.registry import Tables, query

_PRIORITIES = [("1-URGENT", "urgent", 1), ("2-HIGH", "high", 2), ("3-MEDIUM", "medium", 3),
               ("4-NOT SPECIFIED", "unspecified", 4), ("5-LOW", "low", 5)]
_PRIORITY_SCHEMA = T.StructType([
    T.StructField("o_orderpriority", T.StringType(), False),
    T.StructField("label", T.StringType(), False, {"comment": "Name in reports"}),
    T.StructField("level", T.IntegerType(), False),
])


def _values(rows) -> str:
    literal = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + ")"


@query("static_dim", f"""
    SELECT label, level, count(*) AS n, {S.money('o_totalprice')} AS sum_price
    FROM orders JOIN {_values(_PRIORITIES)} AS p(code, label, level) ON code = o_orderpriority GROUP BY 1, 2""")
def static_dim(t: Tables):
    dim = load_static(t.spark, _PRIORITIES, _PRIORITY_SCHEMA)
    return attach(t.orders.select("o_orderpriority", "o_totalprice"), dim, "o_orderpriority").groupBy("label", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sum_price"))


@query("pool_index", """
    SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS idx FROM (SELECT DISTINCT p_brand FROM part)""")
def pool_index(t: Tables):
    return Q.pool_index(t.part, "p_brand")


@query("pool_lookup", """
    WITH pool AS (SELECT n_name, row_number() OVER (ORDER BY n_name) - 1 AS idx FROM nation)
    SELECT c_custkey, n_name FROM customer LEFT JOIN pool ON idx = (c_custkey * 31) % (SELECT count(*) FROM pool)""")
def pool_lookup(t: Tables):
    return L.pool_lookup(t.customer.select("c_custkey"), "c_custkey", 31, t.nation, "n_name")


_KINDS = ("App", "Kiosk", "SMS", "Site", "WhatsApp")


@query("pool_draw", f"""
    WITH pool AS (SELECT unnest({S.strings(_KINDS)}) AS channel, generate_subscripts({S.strings(_KINDS)}, 1) - 1 AS idx)
    SELECT channel, count(*) AS n, min(o_orderkey) AS first_key FROM orders JOIN pool ON idx = (o_orderkey * 13) % {len(_KINDS)} GROUP BY 1""")
def pool_draw(t: Tables):
    """Each order's channel from a literal pool, by its place in the pool."""
    listed = pool(t.spark, _KINDS[::-1], "channel", "idx")
    drawn = t.orders.select("o_orderkey", draw("o_orderkey", 13, len(_KINDS)).cast("int").alias("idx"))
    return attach(drawn, listed, "idx").groupBy("channel").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@query("weighted_draw", """
    WITH bounds AS (SELECT s_suppkey, sum(1 + s_suppkey % 7) OVER (ORDER BY s_suppkey) AS hi,
        sum(1 + s_suppkey % 7) OVER (ORDER BY s_suppkey) - (1 + s_suppkey % 7) AS lo FROM supplier)
    SELECT o_orderkey, s_suppkey FROM orders JOIN bounds
      ON (o_orderkey * 17) % (SELECT max(hi) FROM bounds) >= lo AND (o_orderkey * 17) % (SELECT max(hi) FROM bounds) < hi""")
def weighted_draw(t: Tables):
    weights = t.supplier.select("s_suppkey", (draw("s_suppkey", 1, 7) + 1).alias("weight"))
    return L.weighted_draw(t.orders.select("o_orderkey"), "o_orderkey", 17, weights, "s_suppkey", "weight")


_PRICE_BANDS = [(0.0, 5000.0, "budget"), (5000.0, 20000.0, "standard"), (20000.0, 20500.0, "promo"),
                (30000.0, 60000.0, "premium"), (60000.0, 100000.0, "luxury")]


@query("range_join_bands", f"""
    SELECT label, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, count(*) AS n, {S.money('l_extendedprice')} AS sum_price
    FROM lineitem JOIN {_values(_PRICE_BANDS)} AS b(lo, hi, label) ON l_extendedprice >= lo AND l_extendedprice < hi
    GROUP BY 1, 2, 3""")
def range_join_bands(t: Tables):
    bands = inline(t.spark, ["lo", "hi", "label"], _PRICE_BANDS)
    found = L.range_join(t.lineitem.select("l_extendedprice"), "l_extendedprice", bands, "lo", "hi")
    return found.groupBy("label", "lo", "hi").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("sum_price"))


_ERAS = [(None, "1993-07-01", "early"), ("1993-07-01", "1995-01-01", "middle"), ("1994-06-01", "1995-06-01", "overlap"),
         ("1995-03-15", "1995-03-16", "one day"), ("1997-02-01", None, "late")]


@query("range_join_dates", f"""
    SELECT label, count(*) AS n, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day
    FROM orders JOIN {_values(_ERAS)} AS b(lo, hi, label)
      ON (lo IS NULL OR CAST(o_orderdate AS DATE) >= CAST(lo AS DATE)) AND (hi IS NULL OR CAST(o_orderdate AS DATE) < CAST(hi AS DATE))
    GROUP BY 1""")
def range_join_dates(t: Tables):
    eras = inline(t.spark, ["lo", "hi", "label"], _ERAS).select(F.col("lo").cast("date"), F.col("hi").cast("date"), "label")
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("day"))
    return L.range_join(days, "day", eras, "lo", "hi").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("pick_in_group", """
    WITH options AS (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS idx,
        count(*) OVER (PARTITION BY p_type) AS qtd FROM part)
    SELECT o.p_type, o.p_partkey AS picked_part, count(*) AS n
    FROM lineitem JOIN part p ON p.p_partkey = l_partkey
      LEFT JOIN options o ON o.p_type = p.p_type AND o.idx = (l_orderkey * 67) % o.qtd GROUP BY 1, 2""")
def pick_in_group(t: Tables):
    typed = attach(
        t.lineitem.select("l_orderkey", F.col("l_partkey").alias("p_partkey")), t.part.select("p_partkey", "p_type"), "p_partkey")
    options = t.part.select("p_type", F.col("p_partkey").alias("picked_part"))
    picked = L.pick_in_group(typed.drop("p_partkey"), "p_type", "l_orderkey", 67, options, "picked_part", derived=True)
    return picked.groupBy("p_type", "picked_part").agg(F.count(F.lit(1)).alias("n"))


_NOTES = [("F", 0, "done early"), ("F", 1, "done on time"), ("F", 2, "done late"), ("P", 0, "called off"),
          ("P", 1, "no show"), ("O", 0, "waiting"), ("O", 1, "running"), ("O", 2, "paused"), ("O", 3, "resumed")]


@query("conditional_lookup", f"""
    WITH pool AS (SELECT * FROM {_values(_NOTES)} AS v(kind, idx, note))
    SELECT o_orderkey, o_orderstatus, coalesce(f.note, p.note, o.note) AS note FROM orders
      LEFT JOIN pool f ON o_orderstatus = 'F' AND f.kind = 'F' AND f.idx = (o_orderkey * 13) % 3
      LEFT JOIN pool p ON o_orderstatus = 'P' AND p.kind = 'P' AND p.idx = (o_orderkey * 13) % 2
      LEFT JOIN pool o ON o_orderstatus = 'O' AND o.kind = 'O' AND o.idx = (o_orderkey * 13) % 4""")
def conditional_lookup(t: Tables):
    pool = inline(t.spark, ["o_orderstatus", "idx", "note"], _NOTES)
    return L.conditional_lookup(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey", 13, pool)


@query("index_in_group", """
    SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) - 1 AS idx,
      count(*) OVER (PARTITION BY p_type) AS qtd FROM part""")
def index_in_group(t: Tables):
    return Q.index_in_group(t.part.select("p_partkey", "p_type"), "p_type", "p_partkey")


@query("cumulative_bounds", """
    SELECT s_suppkey, weight, CAST(sum(weight) OVER (ORDER BY s_suppkey) - weight AS BIGINT) AS lower,
      CAST(sum(weight) OVER (ORDER BY s_suppkey) AS BIGINT) AS upper
    FROM (SELECT s_suppkey, 1 + s_suppkey % 7 AS weight FROM supplier)""")
def cumulative_bounds(t: Tables):
    weights = t.supplier.select("s_suppkey", (draw("s_suppkey", 1, 7) + 1).alias("weight"))
    return Q.cumulative_bounds(weights, "s_suppkey", "weight")


@query("global_seq", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS seq FROM orders WHERE o_orderstatus = 'F'""")
def global_seq(t: Tables):
    return Q.global_seq(t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey"), "o_orderkey")
