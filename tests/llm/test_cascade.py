"""Quality rules against SQL, against plain counts, and in any order."""

import random
from collections import Counter

import numpy as np
import pytest
from oracle import compare, duck

import __spark_entry__ as registered
from stratalake.llm import cascade

FOLDER = "/root/testdata/sf0.001"


def test_sql(spark):
    name = "op12_quality_rules"
    assert compare(registered.queries()[name](spark, FOLDER), duck(FOLDER), registered.oracle_sql()[name]) is None


def plain(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words by definition."""
    white = " \t\n\x0b\x0c\r"
    w = "".join(c if c not in white else " " for c in text).split(" ")
    w = [x for x in w if x]
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if x.strip(white)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["a", "bé", "##", "a|b", "!", "ЖЖ", "x" * 40, "1", "THE"]
    out = ["", " \n\x0b", "a", "one line\none line\n\n \n one line"]
    for _ in range(150):
        n, k = rng.choice([1, 7, 8, 9, 40, 200]), rng.choice([1, 2, 9])
        body = [rng.choice(words[:k]) for _ in range(n)]
        if rng.random() < 0.5:
            body = body[:rng.randint(1, n)] * rng.randint(1, 4)
        out.append("".join(x + rng.choice([" ", "\n", "\t", "  "]) for x in body))
    return out


def test_base_counts(texts):
    for batch in (texts, texts[:1], texts[5:6], []):
        t = cascade.Texts([x.encode() for x in batch])
        got = np.stack([t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words], axis=1)
        assert [tuple(r) for r in got.tolist()] == [plain(x) for x in batch]


def test_order_decides_no_verdict(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = [sorted(cascade.judged(docs, rules).drop("rejected_by").collect()) for rules in (cascade.RULES, cascade.RULES[::-1])]
    assert found[0] == found[1] == sorted(cascade.cascade(docs).drop("rejected_by").collect())
    alone = {r["doc_id"] for rule in cascade.RULES for r in cascade.judged(docs, [rule]).where("rejected_by is not null").collect()}
    assert alone == {r["doc_id"] for r in found[0] if not r["kept"] and not r["base_failed"]}


def test_order_by_rejection_per_cost():
    rules = [cascade.Rule(n, None) for n in "abcd"]
    said = {"a": (0.01, 0.1), "b": (0.001, 0.05), "c": (0.001, 0.0), "d": (0.0001, 0.0)}
    found = [cascade.Estimate(n, 10, cost, share) for n, (cost, share) in said.items()]
    assert [r.name for r in cascade.ordered(rules, found)] == ["b", "a", "d", "c"]


def test_rejected_texts_are_not_shown_again(spark, texts):
    seen = []

    def rule(name, reject):
        def rejects(t, rows):
            seen.append((name, rows.tolist()))
            return reject(rows)
        return cascade.Rule(name, rejects)

    t = cascade.Texts([b"a b c d e f g h i j k l m n o p q r s t u"] * 4)
    rows = np.flatnonzero(~t.base_failed())
    for r in (rule("first", lambda rows: rows % 2 == 0), rule("second", lambda rows: rows > 0)):
        gone = r.rejects(t, rows)
        rows = rows[~gone]
    assert seen == [("first", [0, 1, 2, 3]), ("second", [1, 3])] and not len(rows)


def test_estimates(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {e.rule: e for e in cascade.estimates(docs, sample=50)}
    assert set(found) == {r.name for r in cascade.RULES}
    assert all(0 < e.texts <= 50 * docs.rdd.getNumPartitions() and e.seconds > 0 and 0 <= e.rejected <= 1 for e in found.values())
    assert found["symbols"].rejected > 0
    nothing = cascade.estimates(docs.where("false"))
    assert [(e.texts, e.seconds, e.rejected) for e in nothing] == [(0, 0.0, 0.0)] * len(cascade.RULES)


def test_odd_rows(spark):
    good = " ".join(f"word{chr(97 + i % 26)}{i}" for i in range(30))
    long = " ".join(f"word{i}" for i in range(60_000))
    docs = [(1, None), (None, ""), (2, good), (2, good), (3, long), (4, good + " |" * 9), (5, "x" * 500_000), (6, (good + "\n") * 2)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n_words int, kept int")
    got = sorted(((r["doc_id"] or 0, r["n_words"], r["base_failed"], r["kept"], r["rejected_by"]) for r in cascade.cascade(docs).collect()), key=str)
    assert got == sorted([(1, 0, True, False, None), (0, 0, True, False, None), (2, 30, False, True, None), (2, 30, False, True, None), (3, 60_000, False, True, None),
                          (4, 39, False, False, "symbols"), (5, 1, True, False, None), (6, 60, True, False, None)], key=str)
    assert cascade.cascade(docs.where("false")).collect() == []


def test_junk_goes_and_clean_texts_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in registered.queries()["op12_quality_rules"](spark, folder).collect() if r["doc_id"] in labels and r["n_words"] >= 20]
    kept = {q: [r["kept"] for r in rows if labels[r["doc_id"]] == q] for q in (0, 1)}
    assert sum(kept[1]) >= 0.99 * len(kept[1]) and sum(kept[0]) <= 0.03 * len(kept[0])
