"""Edges of draws, bands, dates, identifiers, masks and patterns."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.functions import privacy as P
from stratalake.functions.bands import age_band, band, in_band
from stratalake.functions.dates import age_years
from stratalake.functions.draws import biased_class, draw, null_every, pick, pick_weighted, tiered
from stratalake.functions.identifiers import WIDE_ACCENTS, email_address, fold_ascii, formatted_id
from stratalake.plans import columns as C


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


@pytest.fixture(scope="module")
def ints(spark):
    return spark.createDataFrame([(x,) for x in (19, 20, 30, 31, None)], "x int").coalesce(1)


def test_band_edges(ints):
    steps = [("short", "<", 20), ("mid", "<=", 30), ("long", None, None)]
    assert column(ints, band("x", steps)) == ["short", "mid", "mid", "long", None]
    assert column(ints, band("x", steps, "unknown"))[-1] == "unknown"
    assert column(ints, in_band("x", 20, 30)) == [False, True, False, False, None]


def test_age_bands(spark):
    ages = spark.createDataFrame([(x,) for x in (0, 17, 18, 34, 35, 49, 50, 64, 65, 99, None)], "x int").coalesce(1)
    assert column(ages, age_band("x")) == ["0-17"] * 2 + ["18-34"] * 2 + ["35-49"] * 2 + ["50-64"] * 2 + ["65+"] * 2 + [None]


def test_draw_of_negative_and_large_keys(spark):
    keys = spark.createDataFrame([(-5,), (6_000_000,), (2_000_000_000,)], "k int").coalesce(1)
    assert column(keys, draw("k", 379, 1000)) == [-5 * 379 % 1000, 6_000_000 * 379 % 1000, 2_000_000_000 * 379 % 1000]


def test_pick_weighted_counts(spark):
    shares = [("a", 60), ("b", 30), ("never", 0), ("c", 10)]
    got = spark.range(1000).select(pick_weighted(draw("id", 53, 100), shares).alias("l")).groupBy("l").count()
    assert {r.l: r["count"] for r in got.collect()} == {"a": 600, "b": 300, "c": 100}


def test_pick_weighted_of_one(spark):
    assert column(spark.range(2), pick_weighted(draw("id", 1, 100), [("only", 100)])) == ["only", "only"]


def test_null_index_and_null_measure(spark):
    one = spark.createDataFrame([(None, 1), (1, 1)], "k bigint, d int").coalesce(1)
    assert column(one, pick(["x", "y"], F.col("k"))) == [None, "y"]
    table = [("<", 20, [("pos", 100)]), (None, None, [("neg", 100)])]
    assert column(one, biased_class("k", "d", table)) == [None, "pos"]
    assert column(one, biased_class("k", "d", table, "none")) == ["none", "pos"]


def test_null_every_and_tiers(spark):
    ids = spark.range(10).coalesce(1)
    assert column(ids, null_every("id", 7, 10, F.col("id"))) == [None, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert column(ids, tiered("id", [(3, F.lit("low")), (8, F.lit("mid")), (10, F.lit("top"))])) == (
        ["low"] * 3 + ["mid"] * 5 + ["top"] * 2)


def test_age_is_days_over_365_and_a_quarter(spark):
    born = spark.createDataFrame([(datetime.date(2023, 2, 1),), (datetime.date(2023, 1, 31),), (datetime.date(1964, 2, 1),)], "b date")
    assert column(born.coalesce(1), age_years("b", "2024-02-01")) == [0, 1, 60]


def test_formatted_id(spark):
    one = spark.createDataFrame([(101,)], "k int")
    assert column(one, formatted_id("k", "A{}-{}", [(7, 1000, 4), (1, 10, 1)])) == ["A0707-1"]
    with pytest.raises(ValueError):
        formatted_id("k", "{}-{}", [(1, 10, 1)])


def test_accents_and_email(spark):
    one = spark.createDataFrame([(7, "Cláudia", "Conceição", "àñÜx")], "k int, f string, l string, w string")
    assert column(one, email_address("k", "f", "l", "mail.org")) == ["claudia.conceicao7@mail.org"]
    assert column(one, fold_ascii("w")) == ["àñÜx"]
    assert column(one, fold_ascii("w", WIDE_ACCENTS)) == ["anUx"]


def test_masks(spark):
    one = spark.createDataFrame([("123.456.789-01", "ana.sa@x.org", None)], "t string, e string, n string")
    masked = P.mask_columns(one, {"t": lambda c: P.keep_last_digits(c, 2), "e": P.mask_email, "n": P.mask_email})
    assert tuple(masked.first()) == ("***.***.***-01", "a***@x.org", None)
    with pytest.raises(ValueError):
        P.mask_columns(one, {"absent": P.mask_email})


def test_pseudonyms_join_and_depend_on_the_salt(spark):
    ids = spark.createDataFrame([(1, 1), (2, 2)], "a int, b bigint").coalesce(1)
    assert column(ids, P.pseudonym("a")) == column(ids, P.pseudonym("b"))
    assert column(ids, P.pseudonym("a", "s")) != column(ids, P.pseudonym("a"))


@pytest.mark.parametrize("kind,make", [
    ("tax_id", C.tax_id), ("health_card", C.health_card), ("registry_id", C.registry_id), ("phone", C.phone)])
def test_generated_identifiers_are_well_formed(spark, kind, make):
    made = spark.range(101, 3000).select(make("id").alias("v"))
    assert made.where(~P.is_valid("v", kind)).count() == 0
    assert made.where(P.is_valid(F.expr("substr(v, 1, length(v) - 1)"), kind)).count() == 0


def test_text_patterns_over_whole_texts(spark):
    filler = "word " * 60_000
    text = f"{filler} a.b@mail.example.com x@y.org {filler} +1 (555) 555-0100 {filler} 10.0.0.1 4111111111111111"
    one = spark.createDataFrame([(text,), (None,), ("@ + .",)], "t string").coalesce(1)
    assert column(one, P.count_in_text("t", "emails")) == [2, 0, 0]
    assert column(one, P.count_in_text("t", "phones")) == [1, 0, 0]
    assert column(one, P.count_in_text("t", "ips")) == [1, 0, 0]
    assert column(one, P.count_in_text("t", "long_numbers")) == [1, 0, 0]


def test_generated_identifiers_are_found_in_text(spark):
    texts = ["cpf 123.456.789-01, rg 12.345.678-9; cns 700 1234 5678 901 tel (11) 91234-5678.", "x123.456.789-012 7001234", None]
    one = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    for kind in P.IDS_IN_TEXT:
        assert column(one, P.count_in_text("t", kind)) == [1, 0, 0], kind
