"""Text scores, tags, classes and vector search on small fixtures."""

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from stratalake.operators import text as X
from stratalake.operators.vectors import centroids, cosine_topk

LEXICON = {"good": 1, "great": 2, "bad": -1, "awful": -3}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([
        (1, "Good, GOOD and great!"), (2, "goodness is badly spelled"), (3, None), (4, ""),
        (5, "bad" + " filler" * 50_000 + " awful"), (6, "great bad bad"), (7, "123 good-bad_great")], "id int, t string")


SCORES = {1: 4, 2: 0, 3: 0, 4: 0, 5: -4, 6: 0, 7: 2}


def test_score_inside_the_row(texts):
    scored = X.score_text(texts, "t", "id", LEXICON)
    assert {r.id: r.score for r in scored.collect()} == SCORES
    assert {r.id: r.polarity for r in scored.collect()}[5] == "negative"
    assert "Exchange" not in plan_of(scored)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_score_by_join(spark, texts, rows, broadcast_bytes):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score int")
    joined = X.score_text(texts, "t", "id", lexicon, broadcast_bytes=broadcast_bytes)
    assert rows(joined) == rows(X.score_text(texts, "t", "id", LEXICON))


def test_words_must_be_plain(texts):
    with pytest.raises(ValueError):
        X.found_words("t", ["good!"])


def test_tags_are_multi_label(texts):
    rules = {"z_bad": "(?i)bad", "a_good": "(?i)good", "number": "[0-9]+"}
    tags = {r.id: r.tags for r in texts.select("id", X.tag_text("t", rules).alias("tags")).collect()}
    assert tags[1] == ["a_good"] and tags[7] == ["a_good", "number", "z_bad"] and tags[3] == [] and tags[4] == []


def test_class_ties_and_default(texts):
    classes = texts.select("id", X.classify_text("t", {"b": ["good", "great"], "a": ["bad"]}, "none").alias("c"))
    assert {r.id: r.c for r in classes.collect()} == {1: "b", 2: "none", 3: "none", 4: "none", 5: "a", 6: "a", 7: "b"}


def test_accuracy(spark):
    df = spark.createDataFrame([("p", "p"), ("p", "n"), ("n", "n"), ("n", "n")], "x string, y string")
    got = {(r.predicted, r.actual): (r.n, r.accuracy) for r in X.score_against_truth(df, F.col("x"), F.col("y")).collect()}
    assert got == {("p", "p"): (1, 0.75), ("p", "n"): (1, 0.75), ("n", "n"): (2, 0.75)}


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(3)
    made = [(i, i % 7, r.normal(size=16).tolist()) for i in range(400)]
    return made, spark.createDataFrame(made + [(900, 1, [0.0] * 16), (901, 1, None)], "id long, g int, v array<double>").repartition(5)


@pytest.mark.parametrize("queries_per_pass", [3, 100])
def test_cosine_topk_equals_brute_force(vectors, queries_per_pass):
    made, corpus = vectors
    queries = corpus.where("id < 10").withColumnRenamed("id", "q")
    found = cosine_topk(queries, corpus, "q", "id", "v", 4, queries_per_pass=queries_per_pass).collect()
    assert len(found) == 40
    matrix = np.array([m[2] for m in made])
    unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
    for q in range(10):
        cosines = np.round(unit @ unit[q], 5)
        best = np.lexsort((np.arange(400), -cosines))[:4]
        got = sorted((r for r in found if r.q == q), key=lambda r: r.rank)
        assert [r.id for r in got] == best.tolist() and np.allclose([r.cosine for r in got], cosines[best])


def test_cosine_topk_without_usable_queries(vectors):
    for queries in (vectors[1].where("false"), vectors[1].where("id = 900")):
        assert cosine_topk(queries.withColumnRenamed("id", "q"), vectors[1], "q", "id", "v", 2).count() == 0


def test_cosine_topk_moves_candidates_only(vectors):
    plan = plan_of(cosine_topk(vectors[1].where("id < 3").withColumnRenamed("id", "q"), vectors[1], "q", "id", "v", 2))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "WindowGroupLimit" in plan


def test_centroids(vectors):
    made, corpus = vectors
    got = {r.g: r.v for r in centroids(corpus.where("id < 900"), "g", "v").collect()}
    for g in range(7):
        assert np.allclose(got[g], np.mean([m[2] for m in made if m[1] == g], axis=0))


def test_words_of_any_script(spark):
    df = spark.createDataFrame([("Está péssimo, für f r",), ("ÓTIMO est",)], "t string")
    found = df.select(X.found_words("t", ["está", "péssimo", "f", "ótimo", "est"]).alias("w")).collect()
    assert [r.w for r in found] == [["está", "péssimo", "f"], ["ótimo", "est"]]
