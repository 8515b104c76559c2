"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as registered
from stratalake.llm import runs

FOLDER = "/root/testdata/sf0.001"


def brute(w):
    """Runs of a sequence of words as (start, length, period), by looking at every place for every period."""
    n, best = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in best.items())


def collapse(w, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def words_of(text):
    return [x for x in text.encode().split()] if text else []


def sequences(rng, many):
    for _ in range(many):
        n, k = rng.choice([0, 1, 3, 6, 10, 30, 100, 300]), rng.choice([1, 2, 3, 50])
        t = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.6 and n > 4:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // rng.choice([2, 4, 5, 9])))
            for i in range(a, rng.randint(a, n)):
                t[i] = t[a + (i - a) % p]
        yield t


@pytest.mark.parametrize("long_text", [1 << 21, 0])
@pytest.mark.parametrize("chunk", [1 << 20, 5])
def test_runs_of_batches(monkeypatch, long_text, chunk):
    monkeypatch.setattr(runs, "LONG_TEXT", long_text)  # 0: the sparser cover
    monkeypatch.setattr(runs, "_CHUNK", chunk)
    rng = random.Random(3)
    for _ in range(40 if chunk > 5 else 8):
        texts = list(sequences(rng, rng.choice([1, 3, 8])))
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(int)
        got = runs.find_runs(np.array([x for t in texts for x in t], np.int64), first)
        assert [tuple(x) for x in got.tolist()] == [(d, *r) for d, t in enumerate(texts) for r in brute(t)]


@pytest.mark.parametrize("modulus", list(runs.COVERS))
def test_extensions(modulus):
    rng = np.random.default_rng(modulus)
    for size, k in ((40, 1), (60, 2), (200, 3)):
        s = np.append(rng.integers(0, k, size), k)
        index = runs.Extensions(s, modulus)
        i, j = np.triu_indices(len(s), 1)
        got = index.common(i, j)
        for a, b, n in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
            assert (s[a:a + n] == s[b:b + n]).all() and s[a + n] != (s[b + n] if b + n < len(s) else -1)


def test_blocks_with_one_hash(monkeypatch):
    monkeypatch.setattr(runs, "grams", lambda s, n: np.zeros(len(s) - n + 1, np.uint64))
    test_extensions(13)


def test_query_by_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = registered.queries()["op13_periodic_runs"](spark, FOLDER).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    changed = 0
    for r in rows:
        w, h = words_of(texts[r["doc_id"]]), zlib.crc32(str(r["doc_id"]).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            changed += 1
        if n > 3000:
            continue
        found = brute(w)
        w = [x.decode() for x in w]
        top = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if found else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapse(w, found).encode()).hexdigest()
    assert changed > 5


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000)) + " again and again" * 4000
    rows = [(1, None, 0), (None, "a " * 9, 1), (2, "", 2), (2, " \n\t", 3), (3, "x y x y x y x y", 4), (3, "x y x y x y x y", 5), (4, long, 6), (5, "é é " * 6, 7)]
    docs = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, runs int, kept string")
    got = {}
    for r in runs.collapsed(docs).collect():
        got.setdefault(r["doc_id"], []).append(([tuple(x) for x in r["runs"]], r["kept"], r["n_words"]))
    assert got[1] == [([], "", 0)] and got[2] == [([], "", 0)] * 2
    assert got[None] == [([(0, 9, 1)], "a", 9)]
    assert got[3] == [([(0, 8, 2)], "x y", 8)] * 2
    assert got[5] == [([(0, 6, 1)], "é é", 6)]
    w = long.split()
    assert got[4] == [([tuple(x) for x in brute_tail(w)], collapse(w, brute_tail(w)), len(w))]
    empty = runs.collapsed(docs.where("false"))
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_words", "runs", "kept"]


def brute_tail(w):
    """The one run of a text that ends in repeats of three words."""
    start = 3000
    return [(start, len(w) - start, 3)]


def test_null_id_changes_no_text(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(None, "a b  c"), (1, None)], "doc_id long, text string")
    got = docs.select(runs.periodic_words(F.col("text"), F.col("doc_id")).alias("t")).collect()
    assert sorted(r["t"] for r in got) == ["", "a b  c"]
