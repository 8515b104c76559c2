"""Registered queries: row rules, bands, audits and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions.bands import band, in_band
from stratalake.functions.dates import age_years
from stratalake.functions.draws import draw, null_every
from stratalake.operators import aggregate as agg
from stratalake.operators import quality as Q
from stratalake.operators.generate import inline
from stratalake.operators.sequence import first_n
from stratalake.plans import columns as C
from stratalake.plans import sql_parts as S
from stratalake.plans.fixed import WAIT_BANDS
from stratalake.plans.registry import Tables, query
from stratalake.plans.sql_parts import AS_OF
from stratalake.sources.contract import REASONS, Contract, judged


def orders_with_gaps(t: Tables):
    """Orders whose customer key is NULL one time in ten."""
    return t.orders.select(
        "o_orderkey", null_every("o_orderkey", 7, 10, F.col("o_custkey")).alias("fk"), "o_orderstatus", "o_totalprice")


GAPS_SQL = """SELECT o_orderkey, CASE WHEN (o_orderkey * 7) % 10 = 0 THEN NULL ELSE o_custkey END AS fk,
    o_orderstatus, o_totalprice FROM orders"""


@query("preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def preview(t: Tables):
    return first_n(t.customer, "c_custkey", 20)


@query("null_status_audit", f"""
    SELECT count(*) AS total, count(*) FILTER (fk IS NULL) AS null_fk,
      count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'P') AS cancelled,
      count(*) FILTER (o_orderstatus = 'O') AS in_progress, round(avg(o_totalprice), 1) AS mean_measure
    FROM ({GAPS_SQL})""")
def null_status_audit(t: Tables):
    names = {"finished": "F", "cancelled": "P", "in_progress": "O"}
    return Q.status_audit(orders_with_gaps(t), "fk", "o_orderstatus", names, "o_totalprice")


@query("silver_clean", f"""
    SELECT o_orderkey, fk, o_orderstatus, o_orderstatus = 'O' AS is_open FROM ({GAPS_SQL})
    WHERE fk IS NOT NULL AND o_orderstatus <> 'P'""")
def silver_clean(t: Tables):
    kept = Q.silver_clean(orders_with_gaps(t), "fk", "o_orderstatus", "P")
    return kept.select("o_orderkey", "fk", "o_orderstatus", (F.col("o_orderstatus") == "O").alias("is_open"))


@query("silver_rejects", f"""
    WITH judged AS (SELECT CASE WHEN fk IS NULL THEN 'key' WHEN o_orderkey % 9 = 0 THEN 'status' ELSE o_orderstatus END AS why
      FROM ({GAPS_SQL}))
    SELECT count(*) AS total, count(*) FILTER (why = 'key') AS null_key, count(*) FILTER (why = 'status') AS null_status,
      count(*) FILTER (why = 'P') AS cancelled, count(*) FILTER (why IN ('O', 'F')) AS kept FROM judged""")
def silver_rejects(t: Tables):
    gaps = orders_with_gaps(t).withColumn("status", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")))
    return Q.rejected_counts(gaps, "fk", "status", "P")


@query("band_filter", """
    SELECT l_returnflag, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity < 20 GROUP BY 1""")
def band_filter(t: Tables):
    return t.lineitem.where(in_band("l_quantity", 10, 20)).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


_BAND_SQL = "CASE WHEN {0} IS NULL THEN 'unknown' WHEN {0} < 20 THEN '< 20' WHEN {0} <= 30 THEN '20-30' ELSE '> 30' END"


@query("band_edges", f"""
    SELECT {_BAND_SQL.format('q')} AS band, count(*) AS n, min(q) AS low, max(q) AS high
    FROM (SELECT CASE WHEN (l_orderkey * 7) % 10 = 0 THEN NULL ELSE l_quantity END AS q FROM lineitem) GROUP BY 1""")
def band_edges(t: Tables):
    rows = t.lineitem.select(null_every("l_orderkey", 7, 10, F.col("l_quantity")).alias("q"))
    return rows.groupBy(band("q", WAIT_BANDS, "unknown").alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.min("q").alias("low"), F.max("q").alias("high"))


@query("segment_filter", f"""
    SELECT * FROM (SELECT c_custkey, c_mktsegment, {S.age('c_custkey')} AS age FROM customer)
    WHERE c_mktsegment = 'BUILDING' AND age > 60""")
def segment_filter(t: Tables):
    aged = t.customer.select(
        "c_custkey", "c_mktsegment", age_years(C.birth_date("c_custkey", AS_OF), AS_OF).alias("age"))
    return aged.where((F.col("c_mktsegment") == "BUILDING") & (F.col("age") > 60))


@query("first_n_finished", """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 500""")
def first_n_finished(t: Tables):
    finished = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    return first_n(finished, "o_orderkey", 500)


@query("cast_quarantine", """
    WITH raw AS (SELECT event_type, CASE WHEN (event_id * 3) % 20 = 0 THEN 'x' ELSE '' END
        || json_extract_string(props, '$.k') AS k FROM events)
    SELECT event_type, count(*) AS n, count(TRY_CAST(k AS INTEGER)) AS n_good,
      count(*) FILTER (k IS NOT NULL AND TRY_CAST(k AS INTEGER) IS NULL) AS n_bad,
      CAST(sum(TRY_CAST(k AS INTEGER)) AS BIGINT) AS sum_k FROM raw GROUP BY 1""")
def cast_quarantine(t: Tables):
    spoiled = F.when(draw("event_id", 3, 20) == 0, "x").otherwise("")
    raw = t.events.select("event_type", F.concat(spoiled, F.get_json_object("props", "$.k")).alias("k"))
    rows = raw.withColumn("number", F.col("k").try_cast("int"))
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("number").alias("n_good"),
        F.count_if(F.col("k").isNotNull() & F.col("number").isNull()).alias("n_bad"),
        F.sum("number").alias("sum_k"))


@query("contract_quarantine", """
    WITH raw AS (SELECT CASE WHEN (o_orderkey * 7) % 10 = 0 THEN 1 ELSE 0 END AS gap,
        CASE WHEN (o_orderkey * 3) % 20 = 0 THEN 1 ELSE 0 END AS broken, o_totalprice FROM orders)
    SELECT CASE WHEN gap = 1 AND broken = 1 THEN 'o_custkey is null; o_totalprice is not double'
        WHEN gap = 1 THEN 'o_custkey is null' WHEN broken = 1 THEN 'o_totalprice is not double' ELSE 'ok' END AS verdict,
      count(*) AS n, CAST(sum(CASE WHEN broken = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS sum_price
    FROM raw GROUP BY 1""")
def contract_quarantine(t: Tables):
    contract = Contract.of("o_orderkey bigint!", "o_custkey bigint!", "o_totalprice double!")
    price = F.col("o_totalprice").cast("string")
    raw = t.orders.select(
        F.col("o_orderkey").cast("string"),
        null_every("o_orderkey", 7, 10, F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(draw("o_orderkey", 3, 20) == 0, F.concat(F.lit("?"), price)).otherwise(price).alias("o_totalprice"))
    rows = judged(raw, contract)
    verdict = F.when(F.size(REASONS) == 0, "ok").otherwise(F.array_join(REASONS, "; "))
    return rows.groupBy(verdict.alias("verdict")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("sum_price"))


@query("fk_orphans", """
    WITH o AS (SELECT CASE WHEN (o_orderkey * 7) % 10 = 0 THEN NULL
        WHEN o_orderkey % 50 = 1 THEN o_custkey + 10000000 ELSE o_custkey END AS fk FROM orders)
    SELECT count(*) AS n_rows, count(*) FILTER (fk IS NULL) AS null_rows,
      count(*) FILTER (fk IS NOT NULL AND c_custkey IS NULL) AS orphan_rows,
      count(DISTINCT fk) FILTER (c_custkey IS NULL) AS orphan_keys
    FROM o LEFT JOIN customer ON c_custkey = fk""")
def fk_orphans(t: Tables):
    moved = F.when(draw("o_orderkey", 1, 50) == 1, F.col("o_custkey") + 10_000_000).otherwise(F.col("o_custkey"))
    facts = t.orders.select(null_every("o_orderkey", 7, 10, moved).alias("fk"))
    return Q.orphan_audit(facts, "fk", t.customer, "c_custkey")


@query("semi_finished", """
    SELECT l_returnflag, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def semi_finished(t: Tables):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_quantity")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    kept = Q.qualifying(lines, orders, "o_orderkey", F.col("o_orderstatus") == "F")
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("quantity"))


@query("fd_violations", """
    SELECT 'part -> supplier' AS rule, l_partkey AS key, count(DISTINCT l_suppkey) AS n_values
    FROM lineitem GROUP BY 2 HAVING count(DISTINCT l_suppkey) > 1
    UNION ALL SELECT 'supplier -> nation', s_suppkey, count(DISTINCT s_nationkey)
    FROM supplier GROUP BY 2 HAVING count(DISTINCT s_nationkey) > 1""")
def fd_violations(t: Tables):
    parts = Q.audit_fd(t.lineitem, ["l_partkey"], ["l_suppkey"])
    suppliers = Q.audit_fd(t.supplier, ["s_suppkey"], ["s_nationkey"])
    return parts.select(F.lit("part -> supplier").alias("rule"), F.col("l_partkey").alias("key"), "n_values").unionAll(
        suppliers.select(F.lit("supplier -> nation"), "s_suppkey", "n_values"))


@query("dup_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dup_keys(t: Tables):
    return Q.audit_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("audit_distribution", """
    SELECT coalesce(c_mktsegment, d.s) AS c_mktsegment, coalesce(n, 0) AS n,
      round(coalesce(n, 0) / (SELECT count(*) FROM customer), 6) AS observed, coalesce(d.share, 0.0) AS declared,
      round(coalesce(n, 0) / (SELECT count(*) FROM customer) - coalesce(d.share, 0.0), 6) AS deviation
    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)
    FULL JOIN (VALUES ('AUTOMOBILE', 0.2::DOUBLE), ('BUILDING', 0.2), ('FURNITURE', 0.2), ('HOUSEHOLD', 0.1), ('MACHINERY', 0.2),
      ('SPACECRAFT', 0.1)) AS d(s, share) ON d.s = c_mktsegment""")
def audit_distribution(t: Tables):
    declared = inline(t.spark, ["c_mktsegment", "share"], [
        ("AUTOMOBILE", 0.2), ("BUILDING", 0.2), ("FURNITURE", 0.2), ("HOUSEHOLD", 0.1), ("MACHINERY", 0.2),
        ("SPACECRAFT", 0.1)])
    return Q.audit_distribution(t.customer, "c_mktsegment", declared)


_PROFILED = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}


@query("profile_columns", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{kind}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS nulls,
      CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max, count(DISTINCT {c}) AS "distinct" FROM customer"""
    for c, kind in _PROFILED.items()))
def profile_columns(t: Tables):
    return Q.profile(t.customer, exact=True)


@query("crosstab_share", f"""
    SELECT band, n, n_A, n_N, n_R, round(n_A / n, 6) AS share_A, round(n_N / n, 6) AS share_N, round(n_R / n, 6) AS share_R
    FROM (SELECT {_BAND_SQL.format('l_quantity')} AS band, count(*) AS n,
        count(*) FILTER (l_returnflag = 'A') AS n_A, count(*) FILTER (l_returnflag = 'N') AS n_N,
        count(*) FILTER (l_returnflag = 'R') AS n_R FROM lineitem GROUP BY 1)""")
def crosstab_share(t: Tables):
    return agg.crosstab_share(t.lineitem, band("l_quantity", WAIT_BANDS), "l_returnflag", ["A", "N", "R"])
