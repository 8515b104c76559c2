"""Registered queries: the 360 view and the gold figures on the test tables.

Stand-ins: supplier with its nation and region is the site, customer the patient, part type the specialty,
order status F/P/O finished/cancelled/open, return flag R the remote visit, line quantity the wait.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratalake.functions.bands import age_band, band
from stratalake.functions.dates import age_years
from stratalake.operators import aggregate as agg
from stratalake.operators.joins import attach, attach_all
from stratalake.operators.sequence import top_k_per_group
from stratalake.operators.text import lexicon_score
from stratalake.plans import columns as C
from stratalake.plans import sql_parts as S
from stratalake.plans.fixed import DELAY_BANDS
from stratalake.plans.registry import Tables, query
from stratalake.plans.sql_parts import AS_OF
from stratalake.plans.texts import LEXICON


def places(t: Tables) -> DataFrame:
    """Nations with the name of their region."""
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return attach(t.nation, regions, "n_regionkey").select("n_nationkey", "n_name", "r_name")


def sites(t: Tables) -> DataFrame:
    """Suppliers with the names of their nation and region."""
    return attach_all(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), [
        (t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey", "inner"),
        (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "inner"),
    ]).select("s_suppkey", "s_name", "n_name", "r_name")


def people(t: Tables) -> DataFrame:
    """Customers with sex, age and age band, keyed as orders refer to them."""
    age = age_years(C.birth_date("c_custkey", AS_OF), AS_OF)
    return t.customer.select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey",
        C.sex("c_custkey").alias("sex"), age.alias("age")).withColumn("age_band", age_band("age"))


def lines(t: Tables, *columns: str) -> DataFrame:
    """Order lines with keys named as in their dimensions."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey"),
        F.col("l_suppkey").alias("s_suppkey"), *columns)


def site_view(t: Tables, orders: DataFrame) -> DataFrame:
    """Order lines of the given orders."""
    return attach(lines(t, "l_quantity").drop("p_partkey"),
                  orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey")


def site_figures(t: Tables, view: DataFrame) -> DataFrame:
    return agg.kpi_by_dimension(view, "s_suppkey", {
        "n_visits": F.count(F.lit(1)),
        "mean_wait": agg.mean("l_quantity"),
        "n_cancelled": F.count_if(F.col("o_orderstatus") == "P"),
        "n_people": F.countDistinct("o_custkey"),
    }, sites(t).select("s_suppkey", "s_name", "n_name"))


@query("kpi_by_site", """
    SELECT s_suppkey, s_name, n_name, count(*) AS n_visits, round(avg(l_quantity), 4) AS mean_wait,
      count(*) FILTER (o_orderstatus = 'P') AS n_cancelled, count(DISTINCT o_custkey) AS n_people
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2, 3""")
def kpi_by_site(t: Tables):
    return site_figures(t, site_view(t, t.orders))


@query("star_360", """
    SELECT o_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, o_custkey, o_orderstatus,
      CAST(o_orderdate AS DATE) AS order_date, c_name, c_mktsegment, s_suppkey, s_name, n_name AS site_nation,
      r_name AS site_region, p_partkey, p_type, p_brand
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
      JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
      JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey""")
def star_360(t: Tables):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("order_date"))
    customers = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    facts = lines(t, "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    named_sites = sites(t).withColumnsRenamed({"n_name": "site_nation", "r_name": "site_region"})
    return attach_all(facts, [
        (named_sites, "s_suppkey", "inner"),
        (t.part.select("p_partkey", "p_type", "p_brand"), "p_partkey", "inner"),
        (orders, "o_orderkey", "inner"),
        (customers, "o_custkey", "left"),
    ])


@query("review_360", """
    SELECT doc_id, source, lang, n_chars, quality, toxic FROM documents JOIN labels USING (doc_id)""")
def review_360(t: Tables):
    return attach(t.documents.select("doc_id", "source", "lang", "n_chars"), t.labels, "doc_id")


@query("kpi_by_channel", """
    SELECT lang, source, count(*) AS n_reviews, round(avg(n_chars), 4) AS mean_chars,
      round(count(*) FILTER (toxic = 1) / count(*), 6) AS toxic_rate, round(avg(quality), 4) AS mean_quality
    FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def kpi_by_channel(t: Tables):
    return agg.kpi(review_360(t), ["lang", "source"], {
        "n_reviews": F.count(F.lit(1)), "mean_chars": agg.mean("n_chars"),
        "toxic_rate": agg.ratio(F.col("toxic") == 1), "mean_quality": agg.mean("quality")})


@query("kpi_region_code", f"""
    SELECT r_name, n_name, p_type, p_brand, count(*) AS n_visits, count(DISTINCT o_custkey) AS n_people,
      round(avg({S.age('o_custkey')}), 4) AS mean_age, round(avg(l_quantity), 4) AS mean_wait
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey JOIN part ON p_partkey = l_partkey
    GROUP BY 1, 2, 3, 4""")
def kpi_region_code(t: Tables):
    view = attach_all(lines(t, "l_quantity"), [
        (sites(t).drop("s_name"), "s_suppkey", "inner"),
        (t.part.select("p_partkey", "p_type", "p_brand"), "p_partkey", "inner"),
        (t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "inner"),
        (people(t).select("o_custkey", "age"), "o_custkey", "left"),
    ])
    return agg.kpi(view, ["r_name", "n_name", "p_type", "p_brand"], {
        "n_visits": F.count(F.lit(1)), "n_people": F.countDistinct("o_custkey"),
        "mean_age": agg.mean("age"), "mean_wait": agg.mean("l_quantity")})


@query("kpi_productivity", """
    SELECT s_suppkey, s_name, p_type, count(*) AS n_visits, count(*) FILTER (l_returnflag = 'A') AS n_in_person,
      count(*) FILTER (l_returnflag = 'R') AS n_remote, round(avg(l_quantity), 4) AS mean_wait
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""")
def kpi_productivity(t: Tables):
    typed = attach(lines(t, "l_quantity", "l_returnflag").drop("o_orderkey"), t.part.select("p_partkey", "p_type"), "p_partkey")
    per_site = agg.kpi(typed, ["s_suppkey", "p_type"], {
        "n_visits": F.count(F.lit(1)), "n_in_person": F.count_if(F.col("l_returnflag") == "A"),
        "n_remote": F.count_if(F.col("l_returnflag") == "R"), "mean_wait": agg.mean("l_quantity")})
    return attach(per_site, t.supplier.select("s_suppkey", "s_name"), "s_suppkey", derived=True)


@query("kpi_demography", f"""
    WITH c AS (SELECT *, {S.sex('c_custkey')} AS sex, {S.age('c_custkey')} AS age FROM customer)
    SELECT c_mktsegment, sex, {S.age_band('age')} AS age_band, r_name, count(DISTINCT o_custkey) AS n_people,
      count(*) AS n_visits, count(*) FILTER (o_orderstatus = 'P') AS n_cancelled, round(avg(o_totalprice), 2) AS mean_price,
      round(count(*) FILTER (o_orderpriority = '1-URGENT') / count(*), 6) AS remote_rate
    FROM orders JOIN c ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2, 3, 4""")
def kpi_demography(t: Tables):
    located = attach(people(t), places(t).withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
    visits = t.orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return agg.kpi(attach(visits, located, "o_custkey"), ["c_mktsegment", "sex", "age_band", "r_name"], {
        "n_people": F.countDistinct("o_custkey"), "n_visits": F.count(F.lit(1)),
        "n_cancelled": F.count_if(F.col("o_orderstatus") == "P"), "mean_price": agg.mean("o_totalprice", 2),
        "remote_rate": agg.ratio(F.col("o_orderpriority") == "1-URGENT")})


@query("kpi_age_plan_site", f"""
    WITH c AS (SELECT c_custkey, c_mktsegment, {S.age('c_custkey')} AS age FROM customer)
    SELECT {S.age_band('age')} AS age_band, c_mktsegment, l_suppkey AS s_suppkey, count(*) AS n_visits,
      count(DISTINCT o_custkey) AS n_people
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN c ON c_custkey = o_custkey GROUP BY 1, 2, 3""")
def kpi_age_plan_site(t: Tables):
    view = attach_all(lines(t).drop("p_partkey"), [
        (t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "inner"),
        (people(t).select("o_custkey", "age_band", "c_mktsegment"), "o_custkey", "inner"),
    ])
    return agg.kpi(view, ["age_band", "c_mktsegment", "s_suppkey"], {
        "n_visits": F.count(F.lit(1)), "n_people": F.countDistinct("o_custkey")})


@query("tele_ratio", """
    SELECT p_type, count(*) AS n_visits, round(count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS remote_rate
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def tele_ratio(t: Tables):
    # One row per part before the join, as a hot part's rows cannot be told apart by their flag alone.
    per_part = agg.kpi(lines(t, "l_returnflag"), ["p_partkey"], {
        "lines": F.count(F.lit(1)), "remote": F.count_if(F.col("l_returnflag") == "R")})
    typed = attach(per_part, t.part.select("p_partkey", "p_type"), "p_partkey", derived=True)
    return agg.kpi(typed, ["p_type"], {
        "n_visits": F.sum("lines"), "remote_rate": F.round(F.try_divide(F.sum("remote"), F.sum("lines")), 6)})


@query("top_k_per_group", """
    SELECT p_type, p_brand, n, rank FROM (SELECT p_type, p_brand, count(*) AS n,
        row_number() OVER (PARTITION BY p_type ORDER BY count(*) DESC, p_brand) AS rank
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) WHERE rank <= 3""")
def top_brands(t: Tables):
    # One row per part before the join: what is joined has the size of the part table.
    per_part = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("lines"))
    counted = attach(per_part, t.part.select("p_partkey", "p_type", "p_brand"), "p_partkey", derived=True).groupBy(
        "p_type", "p_brand").agg(F.sum("lines").alias("n"))
    return top_k_per_group(counted, "p_type", [F.desc("n"), F.asc("p_brand")], 3)


@query("corr_metric", """
    SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS corr, count(*) AS n FROM lineitem GROUP BY 1""")
def corr_metric(t: Tables):
    return agg.correlation(t.lineitem, ["l_returnflag"], "l_quantity", "l_extendedprice")


@query("gold_clinic", f"""
    SELECT source, count(*) AS n_reviews, round(avg(n_chars), 4) AS mean_chars, round(avg(score), 4) AS mean_score
    FROM documents JOIN ({S.document_scores(LEXICON)}) USING (doc_id) GROUP BY 1""")
def gold_clinic(t: Tables):
    scored = t.documents.select("source", "n_chars", lexicon_score("text", LEXICON).alias("score"))
    return agg.kpi(scored, ["source"], {
        "n_reviews": F.count(F.lit(1)), "mean_chars": agg.mean("n_chars"), "mean_score": agg.mean("score")})


@query("load_per_capacity", """
    SELECT n_nationkey, n_orders, n_suppliers, round(n_orders / n_suppliers, 6) AS n_orders_per_n_suppliers
    FROM (SELECT c_nationkey AS n_nationkey, count(*) AS n_orders FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
    LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS n_suppliers FROM supplier GROUP BY 1) USING (n_nationkey)""")
def load_per_capacity(t: Tables):
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    load = attach(per_customer, t.customer.select("c_custkey", "c_nationkey"), "c_custkey", derived=True).groupBy(
        F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("n").alias("n_orders"))
    capacity = t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return agg.load_per_capacity(load, capacity, "n_nationkey", "n_orders", "n_suppliers")


@query("top_channel", """
    SELECT lang, source, n FROM (SELECT lang, source, count(*) AS n,
        row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS r FROM documents GROUP BY 1, 2) WHERE r = 1""")
def top_channel(t: Tables):
    return agg.leader_per_group(t.documents, "lang", "source")


@query("rate_gap", """
    WITH l AS (SELECT toxic, (doc_id * 71) % 100 < 15 AS flag FROM labels),
    r AS (SELECT count(*) FILTER (flag) AS n_flagged, count(*) FILTER (NOT flag) AS n_other,
      count(*) FILTER (flag AND toxic = 1) AS t_flagged, count(*) FILTER (NOT flag AND toxic = 1) AS t_other FROM l)
    SELECT n_flagged, n_other, round(t_flagged / n_flagged, 6) AS rate_flagged, round(t_other / n_other, 6) AS rate_other,
      round(t_flagged / n_flagged - t_other / n_other, 6) AS gap FROM r""")
def rate_gap(t: Tables):
    return agg.rate_gap(t.labels, C.anonymous("doc_id"), F.col("toxic") == 1)


@query("rate_by_delay", f"""
    WITH l AS (SELECT quality, {S.delay('doc_id')} AS delay FROM labels)
    SELECT CASE WHEN delay < 120 THEN '2h' WHEN delay < 1440 THEN '24h' WHEN delay < 7200 THEN '5d' ELSE '7d' END AS bucket,
      count(*) AS n, round(avg(quality), 4) AS mean_quality FROM l GROUP BY 1""")
def rate_by_delay(t: Tables):
    delayed = t.labels.select("quality", band(C.review_delay("doc_id"), DELAY_BANDS).alias("bucket"))
    return agg.kpi(delayed, ["bucket"], {"n": F.count(F.lit(1)), "mean_quality": agg.mean("quality")})


@query("share_of_total", """
    SELECT s_suppkey, s_acctbal,
      round(s_acctbal / (SELECT CAST(sum(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE) FROM supplier), 8) AS share_of_total,
      round(s_acctbal / (SELECT max(s_acctbal) FROM supplier), 8) AS share_of_max FROM supplier""")
def share_of_total(t: Tables):
    return agg.share_of_total(t.supplier, ["s_suppkey", "s_acctbal"], "s_acctbal", scale=2)


@query("dataset_counts", """
    SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM labels) AS n_labels,
      (SELECT count(*) FROM orders) AS n_orders, (SELECT count(*) FROM lineitem) AS n_lines""")
def dataset_counts(t: Tables):
    frames = {"n_documents": t.documents, "n_labels": t.labels, "n_orders": t.orders, "n_lines": t.lineitem}
    return t.spark.range(1).select(*[df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in frames.items()])
