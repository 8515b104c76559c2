"""Lexicon scores, rule tags and keyword classes over whole texts.

Words are runs of letters of any script in the lower-cased text. A literal lexicon is matched inside the row, so
a text never leaves its task; a lexicon held in a DataFrame is joined with the words.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.functions.draws import col
from stratalake.operators.joins import attach, broadcast_limit, measured_bytes

_BETWEEN = r"[^\p{L}]+"


def found_words(text: Column | str, words: Sequence[str]) -> Column:
    """Every occurrence of the listed words as whole words, in order; empty for a NULL text."""
    bad = [w for w in words if not w.isalpha() or w != w.lower()]
    if bad:
        raise ValueError(f"words must be lower-case letters: {bad}")
    tokens = F.split(F.lower(col(text)), _BETWEEN)
    return F.coalesce(F.filter(tokens, lambda word: word.isin(sorted(words))), F.array().cast("array<string>"))


def lexicon_score(text: Column | str, lexicon: Mapping[str, int]) -> Column:
    """Sum of the scores of all lexicon words in the text; 0 if there are none."""
    scores = F.create_map(*[F.lit(x) for word in sorted(lexicon) for x in (word, int(lexicon[word]))])
    return F.aggregate(
        found_words(text, list(lexicon)), F.lit(0).cast("bigint"),
        lambda total, word: total + F.element_at(scores, word).cast("bigint"))


def polarity(score: Column | str) -> Column:
    score = col(score)
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def score_text(
    df: DataFrame,
    text: str,
    key: str,
    lexicon: Mapping[str, int] | DataFrame,
    *,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Score and polarity per key, with a row for texts that hold no lexicon word.

    A DataFrame lexicon has columns ``word`` and ``score``. If it is too large to broadcast, words are
    counted per key before they are moved, and words that fill a large share of the text are spread.
    """
    if not isinstance(lexicon, DataFrame):
        scored = df.select(key, lexicon_score(text, lexicon).alias("score"))
    else:
        words = df.select(key, F.explode_outer(F.split(F.lower(F.col(text)), _BETWEEN)).alias("word"))
        size = measured_bytes(lexicon)[0]
        if size > broadcast_limit(df, broadcast_bytes):
            words = words.groupBy(key, "word").agg(F.count(F.lit(1)).alias("times"))
        else:
            words = words.withColumn("times", F.lit(1))
        hits = attach(words, lexicon.select("word", "score"), "word", "left", broadcast_bytes=broadcast_bytes, size=size)
        points = F.coalesce(F.col("score"), F.lit(0)) * F.col("times")
        scored = hits.groupBy(key).agg(F.sum(points).cast("bigint").alias("score"))
    return scored.select(key, "score", polarity("score").alias("polarity"))


def tag_text(text: Column | str, rules: Mapping[str, str]) -> Column:
    """Names of all rules whose pattern occurs in the text, sorted; empty for a NULL text."""
    text = col(text)
    return F.array_compact(F.array(*[F.when(text.rlike(rules[name]), F.lit(name)) for name in sorted(rules)]))


def classify_text(text: Column | str, keywords: Mapping[str, Sequence[str]], default: str) -> Column:
    """Category with most keyword occurrences; ties go to the smaller name, no occurrence gives the default."""
    names = sorted(keywords)
    found = found_words(text, sorted({word for name in names for word in keywords[name]}))

    def hits(words: Column, name: str) -> Column:
        return F.size(F.filter(words, lambda word: word.isin(list(keywords[name]))))

    def best(words: Column) -> Column:
        # The default stands behind no hits and ahead of any category without hits.
        entries = [F.struct(hits(words, name).alias("hits"), F.lit(-1 - i).alias("rank"), F.lit(name).alias("name"))
                   for i, name in enumerate(names)]
        none = F.struct(F.lit(0).alias("hits"), F.lit(0).alias("rank"), F.lit(default).alias("name"))
        return F.array_max(F.array(none, *entries))["name"]

    # transform() over a one-element array binds the found words, so the text is searched once.
    return F.element_at(F.transform(F.array(found), best), 1)


def score_against_truth(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """Confusion counts with the overall accuracy on every row."""
    counts = df.groupBy(predicted.alias("predicted"), actual.alias("actual")).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # one row per pair of classes
    right = F.sum(F.when(F.col("predicted").eqNullSafe(F.col("actual")), F.col("n")).otherwise(0)).over(everything)
    return counts.withColumn("accuracy", F.round(F.try_divide(right, F.sum("n").over(everything)), 6))
