"""Indexed search, extraction, a learned class, check digits and tests of association."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from oracle import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as registered
from stratalake.functions import checks
from stratalake.operators import extract, learned
from stratalake.operators import statistics as ST
from stratalake.operators.text_search import GramIndex, char_grams
from stratalake.operators.vector_index import VectorIndex
from stratalake.operators.vectors import cosine_topk
from stratalake.sources.shared import new_folder

FOLDER = "/root/testdata/sf0.001"
RNG = random.Random(5)


@pytest.mark.parametrize("name", [
    "vector_index_exact", "vector_index_recall", "text_search_misspelt", "extract_phrases", "extract_phrases_joined", "learned_class", "pii_check_digits",
    "rank_correlation", "chi_square", "wait_sentiment_test"])
def test_sql(spark, name):
    assert compare(registered.queries()[name](spark, FOLDER), duck(FOLDER), registered.oracle_sql()[name]) is None


def test_cells_hold_every_vector_and_are_read_alone(spark):
    random_ = np.random.default_rng(2)
    centres = random_.standard_normal((6, 8)) * 4
    data = [(i, (centres[i % 6] + random_.standard_normal(8) * 0.3).tolist()) for i in range(600)]
    odd = [(1000, None), (1001, [0.0] * 8), (1002, [float("nan")] + [1.0] * 7), *[(2000 + i, data[0][1]) for i in range(300)]]
    corpus = spark.createDataFrame(data + odd, "id long, v array<double>")
    index = VectorIndex.build(corpus, "id", "v", new_folder(spark, "index"), cells=6)
    assert sorted(r.id for r in index.rows().collect()) == sorted([i for i, _ in data] + [2000 + i for i in range(300)])
    assert {r.cell for r in index.cell_sizes().collect()} == {r.cell for r in index.rows().select("cell").distinct().collect()}
    queries = corpus.where("id % 20 = 0").select(F.col("id").alias("q"), "v")
    true = {(r.q, r.rank): (r.id, r.cosine) for r in cosine_topk(queries.where("v is not null and q < 600"), index.rows(), "q", "id", "v", 4).collect()}
    found = {(r.q, r.rank): (r.id, r.cosine) for r in index.search(queries.where("q < 600"), "q", 4, 6, queries_per_pass=7).collect()}
    assert found == true
    one = index.search(queries.where("q = 20"), "q", 4, 1)
    assert len(one.collect()) == 4
    assert 1 <= index.probes_for(queries.where("q < 600"), "q", 4) <= 6
    assert index.search(queries.where("q = 1000"), "q", 4, 2).count() == 0
    assert VectorIndex.open(spark, index.path).centres.tolist() == index.centres.tolist()


def test_empty_index(spark):
    corpus = spark.createDataFrame([(1, None)], "id long, v array<double>")
    index = VectorIndex.build(corpus, "id", "v", new_folder(spark, "index"))
    queries = spark.createDataFrame([(1, [1.0])], "q long, v array<double>")
    assert index.search(queries, "q", 3, 2).count() == 0 and index.rows().count() == 0 and index.probes_for(queries, "q", 3) == 1


def test_char_grams(spark):
    rows = spark.createDataFrame([("Ab\t c",), (" ",), (None,), ("é",)], "t string").select(char_grams("t").alias("g")).collect()
    assert [r.g for r in rows] == [[" ab", "ab ", "b c", " c "], [], [], [" é "]]


def test_search_of_misspelt_names(spark):
    names = ["cardiac arrest", "cardiac arrhythmia", "skin rash", "skin rash", "broken arm", "", None]
    texts = spark.createDataFrame([(i, n, "x") for i, n in enumerate(names)], "id long, name string, key string")
    index = GramIndex.build(texts, "id", "name", new_folder(spark, "grams"))
    asked = spark.createDataFrame([(1, "CARDIAC AREST"), (2, "skn rash"), (3, "zzz"), (4, None), (5, "arm, broken")], "q long, t string")
    best = {r.q: (r.key, r.copies) for r in index.search(asked, "q", "t", 1).collect()}
    assert best == {1: (0, 1), 2: (2, 2), 5: (4, 1)}
    same = index.search(asked, "q", "t", 2)
    spark.conf.set("spark.stratalake.broadcastBytes", "0")
    try:
        assert sorted(index.search(asked, "q", "t", 2).collect()) == sorted(same.collect())
    finally:
        spark.conf.unset("spark.stratalake.broadcastBytes")
    perfect = index.search(spark.createDataFrame([(1, "broken  ARM")], "q long, t string"), "q", "t", 1).first()
    assert perfect.score == 1.0


def brute_extract(texts, phrases):
    out = []
    listed = {(c, tuple(split(p))) for c, p in phrases if c and split(p)}
    for key, text in texts:
        w = split(text)
        for c, p in listed:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    out.append((key, c, " ".join(p), i, i + len(p), bool(set(w[max(i - extract.REACH, 0):i]) & set(extract.NEGATIONS))))
    return sorted(out)


def split(text):
    return [x for x in "".join(ch if ch.isalnum() else " " for ch in (text or "").lower()).split()]


@pytest.mark.parametrize("limit", [None, 0])
def test_extraction(spark, limit):
    words = ["pain", "no", "chest", "not", "the", "back", "é"]
    texts = [(i, " ".join(RNG.choices(words, k=RNG.randrange(0, 14))) + RNG.choice(["", ".", "!? "])) for i in range(60)] + [(7, None), (None, "Chest-PAIN"), (8, "pain " * 3000)]
    phrases = [("a", "chest pain"), ("a", "Chest  pain!"), ("b", "pain"), ("c", "the back pain no"), ("b", "é"), ("c", "..."), (None, "pain"), ("d", "pain pain"), ("d", None)]
    got = extract.extract_phrases(spark.createDataFrame(texts, "id long, text string"), "id", "text", spark.createDataFrame(phrases, "category string, phrase string"), broadcast_bytes=limit)
    rows = sorted(tuple(r) for r in got.where("id is not null").collect())
    assert rows == brute_extract([t for t in texts if t[0] is not None], phrases)
    assert got.where("id is null").count() == 2
    nothing = extract.extract_phrases(spark.createDataFrame(texts, "id long, text string"), "id", "text", spark.createDataFrame([], "category string, phrase string"), broadcast_bytes=limit)
    assert nothing.count() == 0 and nothing.columns == got.columns


def test_fifty_thousand_phrases(spark):
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    own = texts.select(F.explode(extract.text_words("text")).alias("w")).distinct().limit(20).select(F.lit("known").alias("category"), F.col("w").alias("phrase"))
    many = spark.range(50_000).select(F.lit("made").alias("category"), F.concat(F.lit("qq"), F.col("id").cast("string"), F.lit(" zz")).alias("phrase"))
    got = extract.extract_phrases(texts, "doc_id", "text", many.unionAll(own))
    alone = extract.extract_phrases(texts, "doc_id", "text", own)
    assert got.count() == alone.count() > 0


def test_sequences_that_no_phrase_holds_are_not_joined(spark, monkeypatch):
    """Phrases of any lengths, also longer than all texts; what reaches the join is little more than what is found."""
    texts = [(i, " ".join(RNG.choices([f"w{x}" for x in range(400)] + ["not"], k=RNG.choice([0, 1, 5, 60, 700])))) for i in range(80)] + [(90, None)]
    phrases = [("a", " ".join(split(t)[3:3 + n])) for n, (_, t) in zip([1, 2, 5, 40, 600] * 16, texts)] + [("b", "w1"), ("b", "w2 w3"), ("c", "x " * 60_000)]
    seen = []
    monkeypatch.setattr(extract, "attach", lambda left, *more, f=extract.attach, **named: seen.append(left.count()) or f(left, *more, **named))
    monkeypatch.setattr(extract, "SLICE_WORDS", 500)
    got = extract.extract_phrases(spark.createDataFrame(texts, "id long, text string"), "id", "text", spark.createDataFrame(phrases, "category string, phrase string"), broadcast_bytes=0)
    want = brute_extract(texts, phrases)
    assert sorted(tuple(r) for r in got.collect()) == want and any(r[5] for r in want)
    assert len(want) / 2 <= seen[0] <= len(want) + sum(len(split(t)) for _, t in texts) / 20


def test_a_crowded_filter_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(extract, "MOST_BITS", 1 << 7)
    texts = [(i, " ".join(RNG.choices("abcdefgh", k=30))) for i in range(40)]
    phrases = [("a", " ".join(RNG.choices("abcdefgh", k=3))) for _ in range(200)]
    got = extract.extract_phrases(spark.createDataFrame(texts, "id long, text string"), "id", "text", spark.createDataFrame(phrases, "category string, phrase string"), broadcast_bytes=0)
    assert sorted(tuple(r) for r in got.collect()) == brute_extract(texts, phrases)


def test_long_lists_make_no_automaton(spark, monkeypatch):
    """Lists far below the broadcast limit would fill a worker as an automaton; occurrences leave a task in parts."""
    texts = spark.createDataFrame([(i, "not one two " * 50) for i in range(40)], "id long, text string")
    long = spark.range(70_000).select(F.lit("a").alias("category"), F.concat(F.lit("two not one two "), F.col("id").cast("string")).alias("phrase"))
    short = spark.createDataFrame([("a", "one two"), ("b", "one two"), ("b", "two")], "category string, phrase string")
    used = []
    monkeypatch.setattr(extract, "_by_automaton", lambda *more, f=extract._by_automaton: used.append(True) or f(*more))
    monkeypatch.setattr(extract, "SLICE_FOUND", 70)
    got = extract.extract_phrases(texts, "id", "text", long.unionAll(short))
    assert not used and sorted(got.collect()) == sorted(extract.extract_phrases(texts, "id", "text", short).collect()) and used


def test_learned_class_by_definition(spark):
    texts = [(1, "good good day"), (2, "bad day"), (3, "bad bad"), (4, "new good"), (5, None), (6, "zzz"), (7, "bad good")]
    labels = [(1, "p"), (2, "n"), (3, "n"), (None, "p"), (4, None)]
    docs = spark.createDataFrame(texts, "id long, text string")
    model = learned.fit_classes(docs, spark.createDataFrame(labels, "id long, c string"), "id", "text", "c")
    counts = {"p": Counter(good=2, day=1), "n": Counter(bad=3, day=1)}
    weight = lambda c, w: math.log((counts[c][w] + 1) / (sum(counts[c].values()) + 3))
    prior = {"p": math.log(1 / 3), "n": math.log(2 / 3)}
    rows = {r.id: (r.predicted, r.score) for r in model.classify(docs, "id", "text").collect()}
    for key, text in texts:
        scores = {c: prior[c] + sum(weight(c, w) for w in (text or "").split() if w in ("good", "bad", "day")) for c in prior}
        best = max(scores, key=lambda c: (scores[c], c == "n"))
        assert rows[key][0] == best and rows[key][1] == pytest.approx(scores[best])
    empty = learned.fit_classes(docs, spark.createDataFrame([], "id long, c string"), "id", "text", "c")
    assert {r.predicted for r in empty.classify(docs, "id", "text").collect()} == {None}


def brute_tax(d):
    def digit(n):
        rest = 11 - sum(d[i] * (n + 1 - i) for i in range(n)) % 11
        return 0 if rest >= 10 else rest
    return len(d) == 11 and len(set(d)) > 1 and d[9] == digit(9) and d[10] == digit(10)


def brute_luhn(d):
    points = [x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d[::-1])]
    return len(d) > 1 and sum(points) % 10 == 0


def test_check_digits(spark):
    values = ["529.982.247-25", "111.111.111-11", "529.982.247-24", "52998224725", "", None, "abc", "4539 1488 0343 6467", "4539148803436466", "0", "00"]
    values += ["".join(RNG.choices("0123456789", k=RNG.choice([11, 15, 16]))) for _ in range(400)]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    rows = frame.select("v", checks.tax_id_valid("v").alias("tax"), checks.health_card_valid("v").alias("card"), checks.luhn_valid("v").alias("luhn"),
                        checks.tax_id_valid(checks.with_tax_digits("v")).alias("made")).collect()
    for r in rows:
        d = [int(x) for x in r.v or "" if x.isdigit()]
        assert r.tax == brute_tax(d) and r.luhn == brute_luhn(d)
        assert r.card == (len(d) == 15 and d[0] in checks.HEALTH_CARD_FIRST and sum(x * (15 - i) for i, x in enumerate(d)) % 11 == 0)
        assert r.made == (len(d) >= 9 and len(set(d[:9])) > 1 or r.made and len(d) >= 9)
    by = {r.v: (r.tax, r.luhn) for r in rows}
    assert by["529.982.247-25"][0] and by["52998224725"][0] and not by["111.111.111-11"][0] and by["4539 1488 0343 6467"][1]
    assert any(r.card for r in rows) and any(r.luhn for r in rows)


def ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


@pytest.mark.parametrize("bucket", [None, 10])
def test_rank_correlation(spark, bucket):
    data = [(RNG.randrange(30), RNG.randrange(9) / 2) for _ in range(200)]
    frame = spark.createDataFrame(data + [(None, 1.0), (3, None)], "x long, y double")
    got = ST.rank_correlation(frame, "x", "y", rows_per_bucket=bucket).first()
    want = np.corrcoef(ranks([x for x, _ in data]), ranks([y for _, y in data]))[0, 1]
    assert got.n == 200 and got.rank_corr == pytest.approx(want, abs=1e-6)
    assert tuple(ST.rank_correlation(frame.where("x < 0"), "x", "y").first()) == (0, None)
    assert ST.rank_correlation(frame.where("x = 3"), "x", "y").first().rank_corr is None


def test_chi_square(spark):
    data = [(RNG.choice("abc"), RNG.choice("xy") if RNG.random() < 0.8 else "z") for _ in range(300)] + [("d", "z")]
    got = ST.chi_square(spark.createDataFrame(data + [(None, "x")], "r string, c string"), "r", "c").first()
    o = Counter(data)
    nr, nc, n = Counter(r for r, _ in data), Counter(c for _, c in data), len(data)
    want = sum((o[r, c] - nr[r] * nc[c] / n) ** 2 / (nr[r] * nc[c] / n) for r in nr for c in nc)
    assert (got.n, got.freedom) == (n, 6) and got.chi_square == pytest.approx(want, abs=1e-5)
    assert got.cramers_v == pytest.approx(math.sqrt(want / n / 2), abs=1e-5)
    assert tuple(ST.chi_square(spark.createDataFrame([("a", "x")], "r string, c string"), "r", "c").first()) == (1, 0.0, 0, None)
