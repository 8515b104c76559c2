"""Tables that are replaced whole, and gold figures kept as partial states."""

import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as registered
from stratalake.sources import gold as G
from stratalake.sources.lake import Lake
from stratalake.sources.shared import new_folder

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def lake(spark):
    folder = new_folder(spark, "layers")
    made = Lake(spark, folder, f"l{folder[-8:]}").setup()
    yield made
    made.drop()


@pytest.mark.parametrize("name", ["table_replaced_whole", "gold_incremental", "gold_compacted", "gold_from_deliveries", "landing_inventory", "ingest_drift"])
def test_sql(spark, name):
    assert compare(registered.queries()[name](spark, FOLDER), duck(FOLDER), registered.oracle_sql()[name]) is None


def test_failed_rebuild_leaves_the_table(spark, lake):
    table = lake.sink_table(spark.range(5), "silver", "t", comment="It's old")
    shown = lake.current("silver", "t")
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broke"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broke"):
        lake.sink_table(broken, "silver", "t")
    assert lake.current("silver", "t") == shown and lake.versions("silver", "t") == [shown]
    assert table.count() == lake.table("silver", "t").count() == 5


def test_readers_see_one_version(spark, lake):
    reader = lake.sink_table(spark.range(5), "silver", "t")
    lake.sink_table(spark.range(7).withColumn("more", F.lit("x")), "silver", "t")
    assert reader.count() == 5 and reader.columns == ["id"]
    assert lake.table("silver", "t").columns == ["id", "more"] and lake.table("silver", "t").count() == 7
    itself = lake.sink_table(lake.table("silver", "t").where("id < 2"), "silver", "t")  # a table rebuilt from itself
    assert itself.count() == 2


def test_versions_and_vacuum(spark, lake):
    for n in range(4):
        lake.sink_table(spark.range(n), "gold", "t")
    lake.sink_table(spark.range(9), "gold", "t2")
    old = lake.versions("gold", "t")
    assert len(old) == 4 and lake.current("gold", "t") == old[-1]
    assert sorted(r.tableName for r in lake.tables("gold").collect()) == ["t", "t2"]
    assert lake.restore("gold", "t", old[1]).count() == 1
    assert lake.vacuum("gold", "t", keep=1) == [old[0], old[2]]
    assert lake.versions("gold", "t") == [old[1], old[3]] and lake.table("gold", "t").count() == 1 and lake.table("gold", "t2").count() == 9
    with pytest.raises(ValueError):
        lake.restore("gold", "t", old[0])


def test_partitions_are_pruned_through_the_table(spark, lake):
    table = lake.sink_table(spark.range(100).withColumn("p", F.col("id") % 4), "silver", "p", partition_by=["p"])
    assert table.where("p = 1").count() == 25
    assert len(table.where("p = 1").select("id").inputFiles()) >= 1
    plan = table.where("p = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def _figures(lake, name="f"):
    return G.IncrementalGold(lake, name, ["k"], {
        "n": G.rows(), "big": G.rows(F.col("v") > 5), "sum": G.total("v"), "mean": G.mean("v"), "low": G.least("v"), "high": G.most("v"),
        "different": G.distinct("v"), "about": G.sketched("v")})


def _full(df):
    return df.groupBy("k").agg(
        F.count("*").alias("n"), F.count_if(F.col("v") > 5).alias("big"), F.sum("v").alias("sum"), F.round(F.avg("v"), 4).alias("mean"),
        F.min("v").alias("low"), F.max("v").alias("high"), F.count_distinct("v").alias("different"))


def test_batches_equal_one_run(spark, lake, rows):
    data = spark.range(3000).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") * 7 % 40).alias("v"), (F.col("id") % 3).alias("b"))
    data = data.withColumn("k", F.when(F.col("k") != 3, F.col("k")))  # a NULL key is a key
    drops = {str(b): data.where(F.col("b") == b) for b in range(3)}
    figures = _figures(lake)
    figures.refresh({"0": drops["0"], "1": drops["1"].limit(10)})
    figures.refresh({"1": drops["1"]})
    got = figures.refresh({"2": drops["2"]})
    assert rows(got.drop("about")) == rows(_full(data))
    assert all(abs(r.about - r.different) <= 1 + 0.08 * r.different for r in got.collect())
    figures.compact("0-1", ["0", "1"])
    assert sorted(figures.batches()) == ["0-1", "2"] and rows(figures.publish()) == rows(got)
    again = _figures(lake).refresh({"2": drops["2"].where("v > 5")})  # the states outlive the object
    assert rows(again.drop("about")) == rows(_full(data.where("b < 2 or v > 5")))


def test_earlier_batches_are_not_read_again(spark, lake):
    figures, folder = _figures(lake), new_folder(spark, "drops")
    data = spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    data.write.parquet(f"{folder}/a")
    figures.refresh({"a": spark.read.parquet(f"{folder}/a")})
    spark.range(1).select(F.lit("other").alias("k")).write.mode("overwrite").parquet(f"{folder}/a")  # what it came from is gone
    assert figures.refresh({"b": data}).first()["n"] == 20


def test_sketched_counts_of_many_values(spark, lake):
    data = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    figures = _figures(lake, "many")
    got = figures.refresh({str(b): data.where(F.col("v") % 2 == b) for b in range(2)})
    assert all(abs(r.about / r.different - 1) < 0.05 and r.different == 20_000 for r in got.collect())


def test_measures_need_names(lake):
    for measures in ({}, {"k": G.rows()}):
        with pytest.raises(ValueError):
            G.IncrementalGold(lake, "x", ["k"], measures)
