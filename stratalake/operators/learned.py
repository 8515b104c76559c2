"""A learned text class: multinomial naive Bayes with counts by aggregation and weights joined to the words."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from stratalake.operators.extract import text_words
from stratalake.operators.joins import attach
from stratalake.sources.shared import new_folder

#: Classes are columns of the model, so their number is bounded.
MOST_CLASSES = 200


def word_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (key, word, n); counted in the map tasks before anything moves."""
    return texts.select(key, F.explode(text_words(text)).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class ClassModel:
    """``classes`` with the logarithm of each one's share, and a stored frame (word, w0, w1, ...) of log-probabilities."""

    classes: list
    priors: list[float]
    words: DataFrame

    def classify(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """Rows (key, predicted, score): the class with the largest log-probability; of equal ones the smaller.

        Words that no example holds say nothing; texts without a known word, NULL texts too, get the most frequent
        class. Rows that repeat a key are one text. Weights are broadcast where they measure small, else the join is spread
        over frequent words; a text comes back as one row of partial sums from each task.
        """
        keys = texts.select(F.col(key)).distinct()
        if not self.classes:
            return keys.select(key, F.lit(None).cast("string").alias("predicted"), F.lit(None).cast("double").alias("score"))
        counts = word_counts(texts, key, text)
        weighted = attach(counts, self.words, "word")
        sums = [F.sum(F.col("n") * F.col(f"w{i}")).alias(f"s{i}") for i in range(len(self.classes))]
        scored = weighted.groupBy(key).agg(*sums)
        told = keys.join(scored, key, "left")
        options = [F.struct((F.coalesce(F.col(f"s{i}"), F.lit(0.0)) + F.lit(p)).alias("score"), F.lit(-i).alias("order"), F.lit(c).alias("predicted"))
                   for i, (c, p) in enumerate(zip(self.classes, self.priors))]
        return told.select(key, F.array_max(F.array(*options)).alias("best")).select(key, "best.predicted", "best.score")


def fit_classes(texts: DataFrame, labels: DataFrame, key: str, text: str, label: str, *, smoothing: float = 1.0) -> ClassModel:
    """The model of all labelled texts. Of several labels of a key the smallest counts; NULL labels and keys are passed over.

    A class's share of the labelled texts is its prior. A word's probability in a class is its count plus
    ``smoothing`` over the class's words plus ``smoothing`` times the words that any class holds.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(key, F.col(label).alias("__class"))
    known = known.groupBy(key).agg(F.min("__class").alias("__class"))
    told = attach(texts.select(key, F.col(text).alias("__text")), known, key)
    shares = {r["__class"]: r["n"] for r in told.groupBy("__class").agg(F.count("*").alias("n")).limit(MOST_CLASSES + 1).collect()}
    if len(shares) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    classes = sorted(shares)
    n = sum(shares.values())
    words = told.select("__class", F.explode(text_words("__text")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"), *[F.count_if(F.col("__class") == c).alias(f"n{i}") for i, c in enumerate(classes)])
    folder = new_folder(texts.sparkSession, "class-counts")
    counts.write.parquet(folder)
    counts = texts.sparkSession.read.schema(counts.schema).parquet(folder)
    totals = counts.agg(F.count("*"), *[F.coalesce(F.sum(f"n{i}"), F.lit(0)) for i in range(len(classes))]).first()
    weights = [F.log((F.col(f"n{i}") + smoothing) / F.lit(float(totals[i + 1] + smoothing * totals[0]))).alias(f"w{i}") for i in range(len(classes))]
    return ClassModel(classes, [math.log(shares[c] / n) for c in classes], counts.select("word", *weights))
