"""The filter audit against SQL and against brute force over every order."""

import random
from itertools import permutations

import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as registered
from stratalake.llm import interactions

FOLDER = "/root/testdata/sf0.001"


def test_sql(spark):
    name = "op11_filter_interactions"
    assert compare(registered.queries()[name](spark, FOLDER), duck(FOLDER), registered.oracle_sql()[name]) is None


def brute(rows, k):
    """rows: (part, mask, outcome values); the audit by applying every order to every row."""
    names, out = "ABCDE"[:k], {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys(names, 0)
        for order in permutations(names):
            left = own
            for step, f in enumerate(order, 1):
                bit = 1 << names.index(f)
                gone, kept = [r for r in left if r[1] & bit], [r for r in left if not r[1] & bit]
                fails = [r for r in own if r[1] & bit]
                total[f] += len(gone)
                out[part, "".join(order), step] = [len(kept), len(gone), len(fails) - len(gone), sum(r[1] == bit for r in own), sum(r[2] for r in gone), f]
                left = kept
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {key: tuple(v) for key, v in out.items()}


@pytest.mark.parametrize("k", [1, 3, 5])
def test_orders(spark, k):
    rng = random.Random(k)
    rows = [(rng.choice("xyz"), rng.randrange(1 << k) if rng.random() < 0.7 else 0, rng.randrange(2)) for _ in range(300)] + [("clean", 0, 1)]
    frame = spark.createDataFrame(rows, "p string, m int, o int")
    counts = interactions.mask_counts(frame, "p", "m", {"o": F.col("o") == 1})
    got = interactions.audit(counts, "ABCDE"[:k], ["o"])
    found = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["o_lost"], r["shapley"]) for r in got.collect()}
    assert found == brute(rows, k)


def test_walk_agrees_with_each_state():
    rng = np.random.default_rng(1)
    cells = {m: rng.integers(0, 9, 2) for m in range(32) if m % 3}
    states = interactions.survivors(cells, 5)
    for s in range(32):
        assert (states[s] == sum((v for m, v in cells.items() if not m & s), np.zeros(2, int))).all()
    assert (interactions.survivors({}, 2) == 0).all()


def test_bad_filters(spark):
    for names in ("AA", "", "ABCDEFGH"):
        with pytest.raises(ValueError):
            interactions.audit(spark.createDataFrame([], "part string, mask int, n long"), names, [])


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    docs = [(1, None, None, 0), (2, "", None, 0), (None, "", "", 0), (3, long, "en", 1), (3, long, "en", 2), (9, long, "en", 3), (4, "a" * 300_000, "en", 4),
            (5, "| " * 250, "en", 5), (6, "ÀÉ AB" * 3, "en", 6)]
    docs = spark.createDataFrame([(i, t, lang, "clash") for i, t, lang, _ in docs], "doc_id long, text string, lang string, mask string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 0, None), (3, 1, 0), (None, 1, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    rows = {(r["part"], r["filter_order"], r["step"]): r for r in interactions.audit_documents(docs, labels).collect()}
    assert len(rows) == 2 * 600
    first = rows["", "ABCDE", 1]  # three empty texts fail A; none of B, C, D; the copy of id 1 is id 2
    assert (first["kept"], first["removed"], first["unique_fails"], first["good_lost"], first["toxic_lost"]) == (0, 3, 2, 1, 1)
    copies = rows["", "EABCD", 1]
    assert (copies["kept"], copies["removed"], copies["shapley"]) == (2, 1, 60)
    english = rows["en", "ABCDE", 1]  # 4 and 6 are short
    assert (english["kept"], english["removed"], english["good_lost"]) == (4, 2, 0)
    assert rows["en", "BACDE", 1]["removed"] == 1 and rows["en", "CABDE", 1]["removed"] == 1  # 5, 6
    assert rows["en", "EABCD", 1]["removed"] == 1  # 9, not the repeated smallest id 3
    assert rows["en", "DABCE", 1]["toxic_lost"] == 1
    assert interactions.audit_documents(docs.where("false"), labels).collect() == []
    assert interactions.audit_documents(docs, labels.where("false")).where("good_lost > 0").count() == 0


def test_large_forms(spark):
    """Joins beyond the broadcast limit give the same rows."""
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    want = sorted(interactions.audit_documents(docs, labels).collect())
    spark.conf.set("spark.stratalake.broadcastBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(interactions.audit_documents(docs, labels).collect()) == want
    finally:
        spark.conf.unset("spark.stratalake.broadcastBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
