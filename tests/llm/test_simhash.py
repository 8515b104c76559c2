"""SimHash: fingerprints and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratalake.llm import simhash
from stratalake.llm.common import components

SCHEMA = "doc_id long, text string, fp string, key string"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(shingles))


def brute_roots(numbers, radius=4):
    """For each number the smallest place that links reach."""
    root = list(range(len(numbers)))
    changed = True
    while changed:
        changed = False
        for a in range(len(numbers)):
            for b in range(len(numbers)):
                if (numbers[a] ^ numbers[b]).bit_count() <= radius and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def test_masks_cover_every_four_positions():
    masks = [m % (1 << 64) for m in simhash.covering_masks()]
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(3000):
        places = sum(1 << p for p in rng.sample(range(64), 4))
        assert any(not m & places for m in masks)


def test_documents(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 40, 400]))) for _ in range(30)]
    texts = [*base, *base[:8], None, "", " \n\t ", None, "UPPER lower", "upper LOWER", "é É", "ñ\x85x y", "a" * 100_000]
    for t in base:  # near copies
        words = t.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    numbers = [brute_fingerprint(t) for t in texts]
    roots = brute_roots(numbers)
    assert {i: int(got[i].fingerprint, 16) for i in got} == dict(enumerate(numbers))
    assert {i: got[i].component_id for i in got} == dict(enumerate(roots))


@pytest.mark.parametrize("bucket", [2, 1024])
def test_dense_groups_by_pairs_and_by_midpoints(spark, bucket):
    rng = random.Random(3)
    numbers = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(40):
            flips = rng.sample(range(64), rng.randrange(5))
            numbers.add(centre ^ sum(1 << p for p in flips))
    numbers |= {rng.getrandbits(64) for _ in range(50)} | {0, (1 << 64) - 1}
    numbers = sorted(n - (1 << 64) if n >> 63 else n for n in numbers)
    links = simhash.bucket_links(spark.createDataFrame([(n,) for n in numbers], "fp long"), bucket=bucket)
    root = {r.node: r.root for r in simhash.components(links).collect()}
    place = brute_roots([n % (1 << 64) for n in numbers])
    assert {n: root.get(n, n) for n in numbers} == {n: numbers[p] for n, p in zip(numbers, place, strict=True)}


def test_rows_with_equal_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (5, "other words here now"), (None, "alone in the world")], "doc_id long, text string")
    rows = sorted(simhash.near_duplicates(docs).select("doc_id", "component_id").collect(), key=str)
    assert rows == [(5, 5), (5, 5), (5, 5), (None, 5), (None, None)]


def test_empty_table(spark):
    out = simhash.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_long_chains_become_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    other = spark.createDataFrame([(1000, 1001), (1001, 1000), (1002, 1002)], "u long, v long")
    got = {r.node: r.root for r in simhash.components(edges.unionByName(other)).collect()}
    assert got == {n: 0 for n in range(201)} | {1000: 1000, 1001: 1000}


def test_stars_hold_for_numbers_of_both_signs():
    fp = np.array([1, 3, 1 - (1 << 63), 12345678901234567], np.int64)
    u, v = simhash._stars(fp, 4)
    assert dict(zip(u.tolist(), v.tolist(), strict=True)) == {1: 1 - (1 << 63), 3: 1 - (1 << 63)}


@pytest.mark.parametrize("limit", ["67108864", "0"])
def test_components_of_hubs(spark, limit):
    """A hub with most links, chains and loose pairs, by broadcast and by spread joins."""
    links = [(1, k) for k in range(100, 700)] + [(k, k + 1) for k in range(1000, 1030)] + [(5000, 100), (7001, 7000), (8, 8)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = sorted((root(u), root(v)))
        parent[b] = a
    spark.conf.set("spark.stratalake.broadcastBytes", limit)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = {r.node: r.root for r in components(spark.createDataFrame(links * 2, "u long, v long")).collect()}
    finally:
        spark.conf.unset("spark.stratalake.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {x: root(x) for x in parent if x != 8}
