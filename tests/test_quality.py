"""Audits and aggregations at their edges."""

from conftest import plan_of
from pyspark.sql import functions as F

from stratalake.operators import aggregate as agg
from stratalake.operators import quality as Q
from stratalake.operators.generate import id_range, inline, load_static, pool
from stratalake.sources.contract import Contract
import pytest


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(
        [(1, 10, "F", 5.0), (2, None, "F", 1.0), (3, 10, "P", 0.0), (4, 99, "O", 2.0), (5, 98, None, 4.0), (6, 99, "P", 0.0)],
        "id int, fk int, status string, wait double")


def test_silver_clean(visits):
    assert sorted(r.id for r in Q.silver_clean(visits, "fk", "status", "P").collect()) == [1, 4]
    # Total, NULL key, NULL status, cancelled, kept: each row counts once.
    assert tuple(Q.rejected_counts(visits, "fk", "status", "P").first()) == (6, 1, 1, 2, 2)


def test_status_audit(visits):
    got = Q.status_audit(visits, "fk", "status", {"done": "F", "off": "P"}, "wait").first()
    assert (got.total, got.null_fk, got.done, got.off, got.mean_measure) == (6, 1, 2, 2, 2.0)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_orphans(spark, visits, broadcast_bytes):
    dim = spark.createDataFrame([(10,), (10,), (None,)], "k int")
    got = Q.orphan_audit(visits, "fk", dim, "k", broadcast_bytes=broadcast_bytes).first()
    assert tuple(got) == (6, 1, 3, 2)
    assert tuple(Q.orphan_audit(visits.where("false"), "fk", dim, "k").first()) == (0, 0, 0, 0)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_qualifying_keeps_child_rows_once(spark, visits, broadcast_bytes):
    parents = spark.createDataFrame([(10, "F"), (10, "F"), (99, "P")], "fk int, s string")
    kept = Q.qualifying(visits, parents, "fk", F.col("s") == "F", broadcast_bytes=broadcast_bytes)
    assert sorted(r.id for r in kept.collect()) == [1, 3]


def test_unique_and_dependency_audits(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "a", "x"), (2, "a", None), (3, "b", "y")], "k int, v string, w string")
    assert [tuple(r) for r in Q.audit_unique(df, ["k", "v", "w"]).collect()] == [(1, "a", None, 2)]
    assert [tuple(r) for r in Q.audit_fd(df, ["k"], ["w"]).collect()] == [(2, 2)]
    assert Q.audit_fd(df, ["k"], ["v"]).count() == 0


def test_distribution_keeps_both_sides(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "v string")
    declared = spark.createDataFrame([("a", 0.5), ("c", 0.25)], "v string, share double")
    got = {r.v: (r.n, r.observed, r.declared, r.deviation) for r in Q.audit_distribution(df, "v", declared).collect()}
    assert got == {"a": (2, 0.5, 0.5, 0.0), "b": (1, 0.25, 0.0, 0.25), None: (1, 0.25, 0.0, 0.25), "c": (0, 0.0, 0.25, -0.25)}


def test_profile_exact_and_sketched(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (2, "x")], "n int, s string")
    exact = {r["column"]: r.asDict() for r in Q.profile(df, exact=True).collect()}
    assert exact["s"] == {"column": "s", "dtype": "string", "non_null": 2, "nulls": 1, "distinct": 1, "min": "x", "max": "x"}
    sketched = {r["column"]: r.asDict() for r in Q.profile(df).collect()}
    assert sketched == exact
    none = {r["column"]: r["distinct"] for r in Q.profile(df.where("false"), exact=True).collect()}
    assert none == {"n": 0, "s": 0}


def test_profile_of_nested_columns(spark):
    df = spark.createDataFrame([({"a": 1}, [2]), ({"a": 2}, [1])], "m map<string,int>, v array<int>")
    got = {r["column"]: (r["distinct"], r["min"]) for r in Q.profile(df, exact=True).collect()}
    assert got == {"m": (2, None), "v": (2, "[1]")}


def test_ratios_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "flag boolean, v int")
    assert tuple(agg.rate_gap(empty, F.col("flag"), F.col("v") > 0).first()) == (0, 0, None, None, None)
    assert empty.agg(agg.ratio(F.col("flag"))).first()[0] is None


def test_load_per_capacity_without_capacity(spark):
    load = spark.createDataFrame([(1, 6), (2, 5), (3, 4)], "k int, load int")
    beds = spark.createDataFrame([(1, 4), (2, 0)], "k int, beds int")
    got = {r.k: r.load_per_beds for r in agg.load_per_capacity(load, beds, "k", "load", "beds").collect()}
    assert got == {1: 1.5, 2: None, 3: None}


def test_leader_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("h", "z")], "g string, c string")
    assert sorted(tuple(r) for r in agg.leader_per_group(df, "g", "c").collect()) == [("g", "a", 1), ("h", "z", 1)]


def test_distinct_counts_do_not_pass_whole_groups(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "site int, person int")
    plan = plan_of(agg.kpi(df, ["site"], {"people": F.countDistinct("person"), "n": F.count(F.lit(1))}))
    keys = [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning(")]
    assert len(keys) == 2 and any("site" in k and "person" in k for k in keys)


def test_generators(spark):
    ids = id_range(spark, 101, 1600, "k", 7)
    assert ids.agg(F.min("k"), F.max("k"), F.count("k")).first() == (101, 1600, 1500) and "Generate" not in plan_of(ids)
    assert [tuple(r) for r in pool(spark, ["b", "a", "c"], "v").collect()] == [(0, "a"), (1, "b"), (2, "c")]
    assert inline(spark, ["a", "b"], [(1, "x")]).first().asDict() == {"a": 1, "b": "x"}
    schema = Contract.of("a int!", "b string").schema()
    assert load_static(spark, [(1, None)], schema).schema == schema
    with pytest.raises(Exception):
        load_static(spark, [(None, "x")], schema)


def test_distinct_values_of_nested_columns_and_zeros(spark):
    df = spark.createDataFrame([(["a, b"], 0.0), (["a", "b"], -0.0), (None, None)], "a array<string>, x double")
    assert {r["column"]: r["distinct"] for r in Q.profile(df, exact=True).collect()} == {"a": 2, "x": 1}


def test_shares_of_small_values(spark):
    from stratalake.operators.aggregate import share_of_total

    df = spark.createDataFrame([(k, 0.004) for k in range(4)], "k int, v double")
    assert {r.share_of_total for r in share_of_total(df, ["k"], "v").collect()} == {0.25}
