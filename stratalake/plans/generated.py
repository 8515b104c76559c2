"""Registered queries: deterministic columns and datasets generated from the keys of the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions.bands import age_band
from stratalake.functions.dates import age_years, day, days_after, days_before
from stratalake.functions.draws import draw, null_every, pick
from stratalake.functions.identifiers import WIDE_ACCENTS, digits, email_address, fold_ascii
from stratalake.operators.generate import id_range
from stratalake.plans import columns as C
from stratalake.plans import fixed as V
from stratalake.plans import sql_parts as S
from stratalake.plans.health import FIRST_NAMES, LAST_NAMES
from stratalake.plans.registry import Tables, query
from stratalake.plans.sql_parts import AS_OF


@query("gen_ids", """
    WITH span AS (SELECT min(o_orderkey) lo, max(o_orderkey) hi FROM orders),
    ids AS (SELECT unnest(range(lo, hi + 1)) AS id FROM span)
    SELECT id // 1000 AS block, count(*) AS n_ids, count(o_orderkey) AS n_used
    FROM ids LEFT JOIN orders ON o_orderkey = id GROUP BY 1""")
def gen_ids(t: Tables):
    keys = t.orders.select(F.col("o_orderkey").alias("id"))
    low, high = keys.agg(F.min("id"), F.max("id")).first()
    block = F.expr("id div 1000").alias("block")
    both = (
        id_range(t.spark, low, high).select(block, F.lit(1).alias("id"), F.lit(0).alias("used"))
        .unionAll(keys.select(block, F.lit(0).alias("id"), F.lit(1).alias("used")))
    )
    return both.groupBy("block").agg(F.sum("id").alias("n_ids"), F.sum("used").alias("n_used"))


@query("gen_person_attrs", f"""
    SELECT c_custkey, {S.sex('c_custkey')} AS sex,
      CASE WHEN (c_custkey * 19) % 100 < 35 THEN 'Solteiro(a)' WHEN (c_custkey * 19) % 100 < 85 THEN 'Casado(a)'
        WHEN (c_custkey * 19) % 100 < 95 THEN 'Divorciado(a)' ELSE 'Viúvo(a)' END AS marital_status,
      {S.element(FIRST_NAMES, 'c_custkey', 31)} || ' ' || {S.element(LAST_NAMES, 'c_custkey', 17)} AS full_name
    FROM customer""")
def gen_person_attrs(t: Tables):
    key = F.col("c_custkey")
    first = pick(sorted(FIRST_NAMES), draw(key, 31, len(FIRST_NAMES)))
    last = pick(sorted(LAST_NAMES), draw(key, 17, len(LAST_NAMES)))
    return t.customer.select(
        key, C.sex(key).alias("sex"), C.marital_status(key).alias("marital_status"),
        F.concat(first, F.lit(" "), last).alias("full_name"))


@query("weighted_category", f"""
    SELECT c_custkey, {S.plan('c_custkey')} AS plan, (c_custkey * 71) % 100 < 15 AS anonymous FROM customer""")
def weighted_category(t: Tables):
    key = F.col("c_custkey")
    return t.customer.select(key, C.health_plan(key).alias("plan"), C.anonymous(key).alias("anonymous"))


@query("null_injection", """
    SELECT o_orderkey, CASE WHEN (o_orderkey * 7) % 10 = 0 THEN NULL ELSE o_custkey END AS fk FROM orders""")
def null_injection(t: Tables):
    return t.orders.select("o_orderkey", null_every("o_orderkey", 7, 10, F.col("o_custkey")).alias("fk"))


@query("nested_case_bias", f"""
    SELECT o_orderkey, {S.wait('o_orderkey')} AS wait, {S.review_class(S.wait('o_orderkey'), 'o_orderkey')} AS class
    FROM orders""")
def nested_case_bias(t: Tables):
    waits = t.orders.select("o_orderkey", C.wait_minutes("o_orderkey").alias("wait"))
    return waits.select("o_orderkey", "wait", C.review_class("wait", "o_orderkey").alias("class"))


@query("gen_identifiers", f"""
    SELECT c_custkey, {S.tax_id('c_custkey')} AS tax_id, {S.health_card('c_custkey')} AS health_card,
      {S.registry_id('c_custkey')} AS registry_id, {S.phone('c_custkey')} AS phone, {S.licence('c_custkey')} AS licence
    FROM customer""")
def gen_identifiers(t: Tables):
    key = F.col("c_custkey")
    return t.customer.select(
        key, C.tax_id(key).alias("tax_id"), C.health_card(key).alias("health_card"),
        C.registry_id(key).alias("registry_id"), C.phone(key).alias("phone"), C.licence(key).alias("licence"))


_FOLD = "translate({}, '%s', '%s')" % V.ACCENTS
_EMAIL = (f"lower({_FOLD.format(S.element(FIRST_NAMES, 'c_custkey', 31))} || '.' || "
          f"{_FOLD.format(S.element(LAST_NAMES, 'c_custkey', 17))} || CAST(c_custkey AS VARCHAR) || '@email.com.br')")


def customer_email():
    key = F.col("c_custkey")
    first = pick(sorted(FIRST_NAMES), draw(key, 31, len(FIRST_NAMES)))
    last = pick(sorted(LAST_NAMES), draw(key, 17, len(LAST_NAMES)))
    return email_address(key, first, last, "email.com.br")


@query("gen_email", f"SELECT c_custkey, {_EMAIL} AS email FROM customer")
def gen_email(t: Tables):
    return t.customer.select("c_custkey", customer_email().alias("email"))


@query("gen_birthdate", f"SELECT c_custkey, {S.birth('c_custkey')} AS birth_date FROM customer")
def gen_birthdate(t: Tables):
    return t.customer.select("c_custkey", C.birth_date("c_custkey", AS_OF).alias("birth_date"))


@query("age_years", f"SELECT c_custkey, {S.age('c_custkey')} AS age FROM customer")
def age_in_years(t: Tables):
    return t.customer.select("c_custkey", age_years(C.birth_date("c_custkey", AS_OF), AS_OF).alias("age"))


@query("age_band", f"""
    SELECT age_band, count(*) AS n, min(age) AS youngest, max(age) AS oldest
    FROM (SELECT age, {S.age_band('age')} AS age_band FROM (SELECT {S.age('c_custkey')} AS age FROM customer))
    GROUP BY age_band""")
def age_bands(t: Tables):
    ages = t.customer.select(age_years(C.birth_date("c_custkey", AS_OF), AS_OF).alias("age"))
    return ages.groupBy(age_band("age").alias("age_band")).agg(
        F.count(F.lit(1)).alias("n"), F.min("age").alias("youngest"), F.max("age").alias("oldest"))


@query("gen_wait", f"SELECT o_orderkey, {S.status('o_orderkey')} AS status, {S.wait('o_orderkey')} AS wait FROM orders")
def gen_wait(t: Tables):
    return t.orders.select("o_orderkey", C.status("o_orderkey").alias("status"), C.wait_minutes("o_orderkey").alias("wait"))


@query("gen_procedure", f"""
    SELECT o_orderkey, {S.mode('o_orderkey')} AS mode, {S.procedure('o_orderkey')} AS procedure FROM orders""")
def gen_procedure(t: Tables):
    return t.orders.select("o_orderkey", C.mode("o_orderkey").alias("mode"), C.procedure("o_orderkey").alias("procedure"))


@query("gen_delay", f"SELECT o_orderkey, {S.delay('o_orderkey')} AS delay FROM orders")
def gen_delay(t: Tables):
    return t.orders.select("o_orderkey", C.review_delay("o_orderkey").alias("delay"))


@query("gen_event_date", f"""
    SELECT o_orderkey, DATE '{AS_OF}' - CAST((o_orderkey * 19) % 90 AS INTEGER) AS event_date FROM orders""")
def gen_event_date(t: Tables):
    return t.orders.select("o_orderkey", C.review_date("o_orderkey", AS_OF).alias("event_date"))


@query("scalar_tour", f"""
    WITH o AS (SELECT *, {S.element(FIRST_NAMES, 'o_orderkey', 31)} AS name FROM orders)
    SELECT o_orderkey, part_no, (o_orderkey * 17) % 97 AS f_pmod,
      CASE WHEN (5 - o_orderkey) % 97 < 0 THEN (5 - o_orderkey) % 97 + 97 ELSE (5 - o_orderkey) % 97 END AS f_pmod_negative,
      o_orderkey * 3 + 7 - 2 AS f_arithmetic, round(o_totalprice / 7, 4) AS f_divide,
      CAST(floor(o_totalprice / 365.25) AS INTEGER) AS f_floor, round(o_totalprice, 1) AS f_round,
      o_orderstatus || '/' || o_orderpriority AS f_concat, lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS f_lpad,
      lower(o_orderpriority) AS f_lower, {_FOLD.format('name')} AS f_translate,
      translate(name || 'àèñü', '{V.WIDE_ACCENTS[0]}', '{V.WIDE_ACCENTS[1]}') AS f_translate_wide,
      DATE '1940-01-01' + CAST(o_orderkey % 27000 AS INTEGER) AS f_date_add,
      DATE '{AS_OF}' - CAST(o_orderkey % 90 AS INTEGER) AS f_date_sub,
      date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS f_datediff,
      ['a', 'b', 'c'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS f_element_at,
      coalesce(CASE WHEN (o_orderkey * 7) % 10 <> 0 THEN o_custkey END, -1) AS f_coalesce,
      CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'open' END AS f_case,
      CAST(o_custkey AS VARCHAR) AS f_cast_string, CAST(o_custkey AS DOUBLE) AS f_cast_double,
      CAST(NULL AS INTEGER) AS f_typed_null
    FROM (SELECT *, unnest(range(1, o_orderkey % 3 + 2)) AS part_no FROM o)""")
def scalar_tour(t: Tables):
    key = F.col("o_orderkey")
    name = pick(sorted(FIRST_NAMES), draw(key, 31, len(FIRST_NAMES)))
    parts = t.orders.withColumn("part_no", F.explode(F.sequence(F.lit(1).cast("bigint"), F.pmod(key, F.lit(3)) + 1)))
    return parts.select(
        key, "part_no",
        draw(key, 17, 97).alias("f_pmod"),
        F.pmod(5 - key, F.lit(97)).alias("f_pmod_negative"),
        (key * 3 + 7 - 2).alias("f_arithmetic"),
        F.round(F.col("o_totalprice") / 7, 4).alias("f_divide"),
        F.floor(F.col("o_totalprice") / F.lit(365.25)).cast("int").alias("f_floor"),
        F.round("o_totalprice", 1).alias("f_round"),
        F.concat("o_orderstatus", F.lit("/"), "o_orderpriority").alias("f_concat"),
        digits(F.col("o_custkey"), 8).alias("f_lpad"),
        F.lower("o_orderpriority").alias("f_lower"),
        fold_ascii(name).alias("f_translate"),
        fold_ascii(F.concat(name, F.lit("àèñü")), WIDE_ACCENTS).alias("f_translate_wide"),
        days_after("1940-01-01", draw(key, 1, 27000)).alias("f_date_add"),
        days_before(AS_OF, draw(key, 1, 90)).alias("f_date_sub"),
        F.datediff(day(AS_OF), F.col("o_orderdate").cast("date")).cast("bigint").alias("f_datediff"),
        pick(["a", "b", "c"], draw(key, 1, 3)).alias("f_element_at"),
        F.coalesce(null_every(key, 7, 10, F.col("o_custkey")), F.lit(-1)).alias("f_coalesce"),
        F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "P", "cancelled")
        .otherwise("open").alias("f_case"),
        F.col("o_custkey").cast("string").alias("f_cast_string"),
        F.col("o_custkey").cast("double").alias("f_cast_double"),
        F.lit(None).cast("int").alias("f_typed_null"),
    )
