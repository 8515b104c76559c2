"""Numbering by buckets gives what one unpartitioned window gives."""

import pytest
from conftest import plan_of
from pyspark.sql import Window, functions as F

from stratalake.operators import sequence as Q


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 unique keys, most of them crowded at the low end; a third of the rows in group a, some in NULL."""
    i = F.col("id")
    key = F.when(i < 2500, i).otherwise(i * i * 1000) - 700
    group = F.when(i % 3 == 0, "a").when(i % 11 == 0, None).otherwise(F.concat(F.lit("g"), i % 9))
    return spark.range(3000).select(key.alias("k"), group.alias("g"), (i % 17).alias("w"))


KEYS = {
    "bigint": "k",
    "decimal": "cast(k as decimal(20,0))",
    "string": "format_string('key-%015d', k + 1000)",
    "date": "date_add(date '1900-01-01', cast(row_number() over (order by k) as int))",
    "double": "k / 7",
    "timestamp": "timestamp_seconds(k)",
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("rows_per_bucket", [200, 10_000])
def test_global_seq_equals_row_number(skewed, rows, kind, rows_per_bucket):
    df = skewed.select(F.expr(KEYS[kind]).alias("key"), "w")
    naive = df.withColumn("seq", F.row_number().over(Window.orderBy("key")).cast("bigint"))
    assert rows(Q.global_seq(df, "key", rows_per_bucket=rows_per_bucket)) == rows(naive)


def test_null_key_comes_first(spark, rows):
    df = spark.range(500).select(F.when(F.col("id") != 250, F.col("id")).alias("k"))
    seq = Q.global_seq(df, "k", rows_per_bucket=50)
    assert seq.where("k is null").first().seq == 1
    assert seq.agg(F.max("seq"), F.countDistinct("seq")).first() == (500, 500)


@pytest.mark.parametrize("rows_per_bucket", [150, 10_000])
def test_index_in_group_keeps_null_groups(skewed, rows, rows_per_bucket):
    in_group = Window.partitionBy("g")
    naive = skewed.select("*", (F.row_number().over(in_group.orderBy("k")) - 1).cast("bigint").alias("idx"),
                          F.count("*").over(in_group).alias("qtd"))
    assert rows(Q.index_in_group(skewed, "g", "k", rows_per_bucket=rows_per_bucket)) == rows(naive)


@pytest.mark.parametrize("rows_per_bucket", [150, 10_000])
def test_cumulative_bounds(skewed, rows, rows_per_bucket):
    total = F.sum("w").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
    naive = skewed.select("*", (total - F.col("w")).alias("lower"), total.alias("upper"))
    assert rows(Q.cumulative_bounds(skewed, "k", "w", rows_per_bucket=rows_per_bucket)) == rows(naive)


def test_buckets_are_even_on_crowded_keys(skewed):
    counts = [r["count"] for r in Q.with_order_bucket(skewed, "k", 3000, 200).groupBy("__bucket").count().collect()]
    assert len(counts) >= 12 and max(counts) < 500


def test_group_totals_move_no_whole_group(skewed):
    plan = plan_of(Q.index_in_group(skewed, "g", "k", rows_per_bucket=150))
    assert "SinglePartition" not in plan


def test_pool_index_skips_null_and_repeats(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("É",)], "v string")
    assert rows(Q.pool_index(df, "v")) == [(0, "a"), (1, "b"), (2, "É")]


@pytest.mark.parametrize("in_memory", [1000, 5])
def test_first_n(skewed, rows, in_memory):
    expected = [r.k for r in skewed.orderBy("k").limit(40).collect()]
    assert sorted(r.k for r in Q.first_n(skewed, "k", 40, in_memory=in_memory).collect()) == expected
    assert rows(Q.first_n(skewed, "k", 10_000, in_memory=in_memory)) == rows(skewed)


def test_top_k_limits_before_the_shuffle(skewed):
    counted = skewed.groupBy("g", "w").agg(F.count("*").alias("n"))
    top = Q.top_k_per_group(counted, "g", [F.desc("n"), F.asc("w")], 2)
    assert "WindowGroupLimit" in plan_of(top)
    naive = {}
    for r in counted.collect():
        naive.setdefault(r.g, []).append((-r.n, r.w))
    assert {(r.g, r.w) for r in top.collect()} == {(g, w) for g, v in naive.items() for _, w in sorted(v)[:2]}


def test_first_n_is_ordered_either_way(spark):
    from stratalake.operators.sequence import first_n

    df = spark.range(1000).select((1000 - F.col("id")).alias("k")).repartition(7)
    for limit in (10**9, 0):
        assert [r.k for r in first_n(df, "k", 20, in_memory=limit).collect()] == list(range(1, 21))


def test_many_buckets_for_timestamps_without_zone(spark):
    from stratalake.operators import sequence as S

    df = spark.range(500).select(F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("ts"), "id")
    got = S.global_seq(df, "ts", "seq", rows_per_bucket=5)
    assert {r.id: r.seq for r in got.collect()} == {k: k + 1 for k in range(500)}


@pytest.mark.parametrize("key", ["format_string('%06d', id)", "timestamp_ntz'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)"])
def test_buckets_have_no_cap_for_any_type(spark, key):
    df = spark.range(4000).select(F.expr(key).alias("k"), "id")
    assert Q.with_order_bucket(df, "k", 4000, 20).select("__bucket").distinct().count() > 150
    assert Q.global_seq(df, "k", "seq", rows_per_bucket=20).where("seq != id + 1").count() == 0
