"""Scale forms of the lookups against the naive joins they replace."""

import random

import pytest
from conftest import plan_of
from pyspark.sql import Window, functions as F

from stratalake.functions.draws import draw
from stratalake.operators import lookup as L

LIMITS = pytest.mark.parametrize("broadcast_bytes", [0, 1 << 30])


def _intervals(kind):
    r = random.Random(kind)
    if kind == "tiny and huge":
        low = [(i * 0.01, i * 0.01 + 0.01) for i in range(300)] + [(0.0, 1e6), (50.0, 900.0), (-1e5, 5.0)]
    elif kind == "overlapping":
        low = [(a, a + r.uniform(0.1, 400)) for a in (r.uniform(-500, 500) for _ in range(200))]
    elif kind == "empty ones":
        low = [(float(i), float(i + i % 2)) for i in range(50)] + [(9.0, 3.0)]
    else:
        low = [(float(i), float(i + 1)) for i in range(0, 900, 2)]
    return [(i, a, b) for i, (a, b) in enumerate(low)]


@LIMITS
@pytest.mark.parametrize("kind", ["tiny and huge", "overlapping", "empty ones", "gaps"])
def test_range_join_equals_nested_loop(spark, rows, kind, broadcast_bytes):
    intervals = _intervals(kind)
    r = random.Random(1)
    values = [(i, r.uniform(-600, 1000)) for i in range(600)] + [
        (1000 + 2 * j + side, x) for j, (_, a, b) in enumerate(intervals) for side, x in enumerate((a, b))]
    points = spark.createDataFrame(values, "p long, v double")
    frame = spark.createDataFrame(intervals, "i long, lo double, hi double")
    found = L.range_join(points, "v", frame, "lo", "hi", broadcast_bytes=broadcast_bytes)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    expected = {(p, i) for p, v in values for i, a, b in intervals if a <= v < b}
    got = [(x.p, x.i) for x in found.collect()]
    assert len(got) == len(expected) and set(got) == expected


def test_range_join_on_a_hot_value(spark):
    points = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    frame = spark.createDataFrame([(0, 10), (10, 2000)], "lo long, hi long")
    found = L.range_join(points, "v", frame, "lo", "hi", broadcast_bytes=0)
    assert {r.lo: r["count"] for r in found.groupBy("lo").count().collect()} == {
        0: 1000 + sum(1 for i in range(10) if i % 3), 10: sum(1 for i in range(10, 2000) if i % 3)}


@LIMITS
@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(12,3)", "long"])
def test_range_join_with_open_ends_and_times(spark, kind, broadcast_bytes):
    r = random.Random(kind)
    intervals = [(i, a, a + r.choice([1, 3, 40, 900])) for i, a in enumerate(r.randrange(-200, 1200) for _ in range(60))]
    intervals += [(100, None, 50), (101, 700, None), (102, None, None), (103, 9, 9), (104, 9, 3)]
    values = [(i, r.randrange(-400, 1500)) for i in range(300)] + [(900, None)]
    time = kind in ("date", "timestamp", "timestamp_ntz")

    def typed(name):
        return F.expr(f"CAST(date_add(DATE'2020-03-01', CAST({name} AS INT)) AS {kind}) AS {name}" if time else f"CAST({name} AS {kind}) AS {name}")

    points = spark.createDataFrame(values, "p long, v long").select("p", typed("v"))
    frame = spark.createDataFrame(intervals, "i long, lo long, hi long").select("i", typed("lo"), typed("hi"))
    found = L.range_join(points, "v", frame, "lo", "hi", broadcast_bytes=broadcast_bytes)
    assert "NestedLoop" not in plan_of(found)
    expected = sorted((p, i) for p, v in values for i, a, b in intervals
                      if v is not None and (a is None or a <= v) and (b is None or v < b) and (a is None or b is None or a < b))
    assert sorted((x.p, x.i) for x in found.collect()) == expected


def test_range_join_with_infinite_values(spark):
    inf = float("inf")
    frame = spark.createDataFrame([(0, -inf, 0.0), (1, 0.0, inf), (2, 5.0, None), (3, None, None)], "i long, lo double, hi double")
    points = spark.createDataFrame([(-inf,), (-3e300,), (0.0,), (7.0,), (inf,)], "v double")
    found = sorted((x.v, x.i) for x in L.range_join(points, "v", frame, "lo", "hi").collect())
    assert found == [(-inf, 0), (-inf, 3), (-3e300, 0), (-3e300, 3), (0.0, 1), (0.0, 3), (7.0, 1), (7.0, 2), (7.0, 3), (inf, 2), (inf, 3)]


def test_range_join_without_intervals(spark):
    points, none = spark.range(5), spark.createDataFrame([], "lo long, hi long, name string")
    found = L.range_join(points, "id", none, "lo", "hi")
    assert found.columns == ["id", "lo", "hi", "name"] and found.count() == 0


@LIMITS
@pytest.mark.parametrize("rows_per_bucket", [10, 1000])
def test_weighted_draw_equals_theta_join(spark, rows, broadcast_bytes, rows_per_bucket):
    weights = spark.createDataFrame([(i, 0 if i == 3 else 5000 if i == 40 else i % 5) for i in range(60)], "item long, w long")
    keys = spark.range(100_000, 104_000).withColumnRenamed("id", "k")
    drawn = L.weighted_draw(keys, "k", 17, weights, "item", "w", broadcast_bytes=broadcast_bytes, rows_per_bucket=rows_per_bucket)
    bounds = weights.withColumn("hi", F.sum("w").over(Window.orderBy("item"))).withColumn("lo", F.col("hi") - F.col("w"))
    total = bounds.agg(F.max("hi")).first()[0]
    at = draw("k", 17, total)
    naive = keys.join(bounds, (at >= F.col("lo")) & (at < F.col("hi"))).select("k", "item")
    assert rows(drawn) == rows(naive) and drawn.count() == 4000
    assert drawn.where("item = 3").count() == 0


def test_weighted_draw_needs_weight(spark):
    with pytest.raises(ValueError):
        L.weighted_draw(spark.range(3), "id", 17, spark.createDataFrame([(1, 0)], "item long, w long"), "item", "w")


@LIMITS
def test_pick_in_group_equals_residual_join(spark, rows, broadcast_bytes):
    group = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.concat(F.lit("g"), F.col("id") % 7))
    facts = spark.range(2000).select(F.col("id").alias("k"), group.alias("g"))
    options = spark.createDataFrame(
        [("hot", f"o{i:03d}") for i in range(40)] + [(f"g{i}", f"o{j}") for i in range(5) for j in range(i + 1)], "g string, o string")
    picked = L.pick_in_group(facts, "g", "k", 67, options, "o", broadcast_bytes=broadcast_bytes, rows_per_bucket=10)
    in_group = Window.partitionBy("g")
    numbered = options.select("g", "o", (F.row_number().over(in_group.orderBy("o")) - 1).alias("i"), F.count("*").over(in_group).alias("n"))
    naive = facts.alias("f").join(
        numbered.alias("x"), (F.col("f.g") == F.col("x.g")) & (F.col("x.i") == F.pmod(F.col("f.k") * 67, F.col("x.n"))), "left",
    ).select("f.k", "f.g", "x.o")
    assert rows(picked) == rows(naive)


@LIMITS
def test_conditional_lookup_equals_three_guarded_joins(spark, rows, broadcast_bytes):
    pool = spark.createDataFrame([(k, i, f"{k}{i}") for k, n in (("pos", 5), ("neg", 5), ("neu", 3)) for i in range(n)],
                                 "kind string, idx int, txt string")
    kind = F.element_at(F.array(*map(F.lit, ["pos", "neg", "neu", "odd"])), (F.pmod("id", F.lit(4)) + 1).cast("int"))
    facts = spark.range(500).select(F.col("id").alias("seq"), kind.alias("kind"))
    naive = facts
    for k, n in (("pos", 5), ("neg", 5), ("neu", 3)):
        one = pool.where(F.col("kind") == k).select(F.col("idx").alias(f"i_{k}"), F.col("txt").alias(f"t_{k}"))
        naive = naive.join(one, (F.col("kind") == k) & (F.col(f"i_{k}") == F.pmod(F.col("seq") * 13, F.lit(n))), "left")
    naive = naive.select("seq", "kind", F.coalesce("t_pos", "t_neg", "t_neu").alias("txt"))
    assert rows(L.conditional_lookup(facts, "kind", "seq", 13, pool, broadcast_bytes=broadcast_bytes)) == rows(naive)


@LIMITS
def test_pool_lookup_literal_equals_table(spark, rows, broadcast_bytes):
    names = ["d", "a", "c", "é", "b"]
    keys = spark.range(100).select(F.when(F.col("id") != 5, F.col("id")).alias("k"))
    table = spark.createDataFrame([(n,) for n in names], "name string")
    literal = L.pool_lookup(keys, "k", 31, names, "name")
    assert rows(literal) == rows(L.pool_lookup(keys, "k", 31, table, "name", broadcast_bytes=broadcast_bytes))
    assert literal.where("k is null and name is not null").count() == 0
