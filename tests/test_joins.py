"""Spread joins give what plain joins give, and a hot key no longer fills one task."""

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from stratalake.operators import joins as J


@pytest.fixture(scope="module")
def fact(spark):
    """9,000 rows: a third on key 7, a tenth NULL, the rest over 500 keys, some without a parent."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 7).when(i % 10 == 1, None).otherwise(i % 500)
    return spark.range(9000).select(i.alias("row"), key.cast("bigint").alias("k"), (i % 13).alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(450).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(fact, dim, rows, how):
    assert rows(J.spread_join(fact, dim, "k", how, share=0.05)) == rows(fact.join(dim, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_with_several_matches_per_key(spark, fact, dim, rows, how):
    twice = dim.unionAll(dim.withColumn("name", F.lit("again")))
    assert rows(J.spread_join(fact, twice, "k", how, share=0.05)) == rows(fact.join(twice, "k", how))


def test_spread_join_on_two_columns(fact, dim, rows):
    left = fact.withColumn("part", F.lit("p"))
    right = dim.withColumn("part", F.lit("p"))
    assert rows(J.spread_join(left, right, ["k", "part"], "left", share=0.05)) == rows(left.join(right, ["k", "part"], "left"))


def test_hot_key_is_found_and_spread(fact, dim):
    hot = J.hot_keys(fact, F.xxhash64("k"), 0.2)
    assert len(hot) == 1 and abs(next(iter(hot.values())) - 1 / 3) < 0.05
    joined = J.spread_join(fact, dim.hint("shuffle_hash"), "k", share=0.02)
    assert "__spread" in plan_of(joined)
    spread = fact.withColumn("s", F.pmod(J._row_mark(fact), F.lit(17))).where("k = 7").groupBy("s").count()
    assert spread.agg(F.max("count")).first()[0] < 3000 / 17 * 1.6


def test_each_hot_key_has_its_own_copies(spark):
    copies = J._copies(F.col("id"), {1: 0.3, 2: 0.02}, 0.01)
    assert [r[0] for r in spark.range(4).orderBy("id").select(copies).collect()] == [1, 32, 2, 1]


def test_chain_of_large_lookups_runs_no_join_before_the_result(spark, fact, dim):
    """Hot keys of a column that a lookup brings in are looked for in that lookup."""
    groups = spark.range(450).select(F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 5).alias("g"))
    seen = []
    find, J.hot_keys = J.hot_keys, lambda df, *more: seen.append(plan_of(df)) or find(df, *more)
    try:
        J.attach_all(fact, [(dim, "k", "inner"), (groups, "name", "left")], broadcast_bytes=0)
        J.attach(fact.join(dim, "k"), groups, "name", broadcast_bytes=0, derived=True)
    finally:
        J.hot_keys = find
    assert len(seen) == 2 and not any("Join" in plan for plan in seen)


def test_no_spreading_without_hot_keys(spark, dim):
    even = spark.range(5000).select((F.col("id") % 450).alias("k"), "id")
    assert "__spread" not in plan_of(J.spread_join(even, dim, "k", share=0.05))


def test_unusable_joins_are_refused(fact, dim):
    with pytest.raises(ValueError):
        J.spread_join(fact, dim, "k", "full")
    with pytest.raises(TypeError):
        J.spread_join(fact, dim.withColumn("k", F.col("k").cast("string")), "k")


def test_attach_switches_by_measured_size(fact, dim, rows):
    small, large = J.attach(fact, dim, "k", "left"), J.attach(fact, dim, "k", "left", broadcast_bytes=0)
    assert rows(small) == rows(large) == rows(fact.join(dim, "k", "left"))
    assert "BroadcastHashJoin" in plan_of(small) and "__spread" in plan_of(large)


def test_measured_bytes_follows_the_strings(spark):
    short = spark.range(100).select(F.lit("x").alias("s"))
    long = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"))
    a, b, none = J.measured_bytes(short, long, short.where("false"))
    assert none == 0 and b - a == 99_900


def test_attach_all_joins_a_chain_of_any_sizes(spark, fact, dim, rows):
    groups = spark.range(450).select(F.concat(F.lit("n"), "id").alias("name"), (F.col("id") % 5).alias("g"))
    plain = fact.join(dim, "k", "inner").join(groups, "name", "left")
    wide = groups.withColumn("note", F.repeat(F.lit("x"), 200))
    for limit in (0, 20_000, 1 << 30):
        for second in (groups, wide):
            both = J.attach_all(fact, [(second, "name", "left"), (dim, "k", "inner")], broadcast_bytes=limit)
            assert rows(both.drop("note")) == rows(plain)
    with pytest.raises(ValueError):
        J.attach_all(fact, [(groups, "name", "left")])


@pytest.fixture()
def chain(spark, fact):
    """Lookups by the fact's key k, by its key v, and by columns that those bring in; the first two and the last are large."""
    by_k = spark.range(450).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") % 9 > 0, F.col("id") % 40).alias("a"), F.repeat(F.lit("x"), 300).alias("note"))
    by_v = spark.range(11).select(F.col("id").alias("v"), F.lit("some").alias("small"))
    by_w = spark.range(9000).where("id % 4 != 1").select(F.col("id").alias("row"), F.repeat(F.lit("z"), 30).alias("own"))
    by_a = spark.range(30).select(F.col("id").alias("a"), F.repeat(F.lit("y"), 3000).alias("text"))
    return by_k, by_v, by_w, by_a


def test_left_rows_do_not_move_for_a_lookup_of_a_lookup(chain, fact, rows, monkeypatch):
    """A large lookup keyed on a column of another is joined there; columns of small lookups come in after the rows have moved."""
    by_k, by_v, by_w, by_a = chain
    seen = []
    monkeypatch.setattr(J, "spread_join", lambda left, right, on, how="inner", f=J.spread_join, **more: seen.append((left.columns, on)) or f(left, right, on, how, **more))
    plain = fact.join(by_v, "v").join(by_k, "k").join(by_w, "row").join(by_a, "a", "left")
    found = J.attach_all(fact, [(by_a, "a", "left"), (by_k, "k", "inner"), (by_v, "v", "inner"), (by_w, "row", "inner")], broadcast_bytes=2000)
    assert seen == [(by_k.columns, ["a"]), (fact.columns, ["row"]), (["row", "k", "v", "own"], ["k"])]
    assert rows(found) == rows(plain) and found.columns == ["row", "a", "k", "v", "small", "note", "text", "own"]


@pytest.mark.parametrize("first", ["inner", "left"])
@pytest.mark.parametrize("then", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [0, 2000, 1 << 30])
def test_lookups_of_lookups_give_what_plain_joins_give(chain, fact, rows, first, then, limit):
    by_k, by_v, _, by_a = chain
    by_k, by_a = by_k.unionAll(by_k.where("k < 50")), by_a.unionAll(by_a.where("a = 3"))  # keys that repeat
    plain = fact.join(by_v, "v", "left_semi").join(by_k, "k", first).join(by_a, "a", then)
    found = J.attach_all(fact, [(by_v, "v", "left_semi"), (by_k, "k", first), (by_a, "a", then)], broadcast_bytes=limit)
    assert rows(found) == rows(plain) and found.columns == plain.columns


def test_large_files_are_not_measured(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(50_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    exact = 50_000 * (16 + 8 + 16 + 64)
    assert J.measured_bytes(stored) == [exact] and J.measured_bytes(stored, limit=1 << 20) == [exact]
    few = stored.where("id < 10")  # a filter may leave little, so it is measured
    told, counted = J.measured_bytes(stored.select("x", "id"), few, limit=1000)
    assert told > 64_000 and told != exact and counted == 10 * (16 + 8 + 16 + 64)
