"""Search of short texts by character n-grams: TF-IDF weights in a postings table, cosine by a join on the grams.

Misspelt, shortened and rearranged queries share most of their grams with the text that was meant. A gram's weight in a
text is its count times ``ln((1 + N) / (1 + texts with it)) + 1``; texts and queries are taken at length 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stratalake.functions.draws import col
from stratalake.operators.joins import attach
from stratalake.operators.sequence import top_k_per_group


def char_grams(text: Column | str, n: int = 3) -> Column:
    """The character n-grams of a text in lower case, with one space for all white space and one at either end.

    NULL and blank texts have none.
    """
    bare = F.trim(F.regexp_replace(F.lower(col(text)), r"\s+", " "))
    chars = F.split(F.concat(F.lit(" "), bare, F.lit(" ")), "")
    chars = F.filter(chars, lambda c: c != "")
    # shifted copies side by side: no place is looked up, so long texts cost their length
    shifted = [F.slice(chars, k + 1, F.greatest(F.size(chars) - n + 1, F.lit(0))) for k in range(n)]
    grams = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y)), shifted)
    return F.when(F.length(bare) > 0, grams).otherwise(F.array().cast("array<string>"))


class GramIndex:
    """Postings (text id, gram, weight) and the grams' own weights, stored under a folder.

    Equal texts are one entry under their smallest key, with their number, so copies cost one entry each search.
    """

    def __init__(self, spark: SparkSession, path: str, n: int = 3):
        self.spark, self.path, self.n = spark, path.rstrip("/"), n

    @classmethod
    def build(cls, texts: DataFrame, key: str, text: str, path: str, n: int = 3) -> GramIndex:
        index = cls(texts.sparkSession, path, n)
        entries = texts.where(F.col(key).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(key).alias("key"), F.count("*").alias("copies"))
        entries.select("key", "copies", "text").write.parquet(f"{index.path}/entries")
        counts = index.entries().select("key", F.explode(char_grams("text", n)).alias("gram")).groupBy("key", "gram").agg(F.count("*").alias("tf"))
        counts.write.parquet(f"{index.path}/counts")
        counts = index.spark.read.parquet(f"{index.path}/counts")
        held = counts.groupBy("gram").agg(F.count("*").alias("df")).select("gram", index._idf(F.col("df")).alias("idf"))
        held.write.parquet(f"{index.path}/grams")
        weighted = attach(counts, index.grams(), "gram").select("key", "gram", (F.col("tf") * F.col("idf")).alias("w"))
        lengths = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("length"))
        postings = weighted.join(lengths, "key").select("gram", "key", (F.col("w") / F.col("length")).alias("w"))
        postings.write.parquet(f"{index.path}/postings")
        return index

    def entries(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/entries")

    def grams(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/grams")

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def _idf(self, df: Column) -> Column:
        n = self.entries().count()
        return F.log((1 + F.lit(n)) / (1 + df)) + 1

    def search(self, queries: DataFrame, query_key: str, query_text: str, k: int, *, digits: int = 6) -> DataFrame:
        """Rows (query, key, copies, score, rank): the ``k`` entries with the largest cosine, rounded, then the smallest key.

        Grams that no entry holds count in a query's length and match nothing; queries without a known gram find
        nothing. Queries that repeat a key with other texts are taken as one text. The query's grams are broadcast where
        they measure small, else the join is spread over common grams.
        """
        grams = queries.select(F.col(query_key).alias("__query"), F.explode(char_grams(query_text, self.n)).alias("gram"))
        counts = grams.groupBy("__query", "gram").agg(F.count("*").alias("tf"))
        unknown = F.log(F.lit(float(1 + self.entries().count()))) + 1
        weighted = attach(counts, self.grams(), "gram", "left").select(
            "__query", "gram", (F.col("tf") * F.coalesce("idf", unknown)).alias("qw"))
        lengths = weighted.groupBy("__query").agg(F.sqrt(F.sum(F.col("qw") * F.col("qw"))).alias("qlength"))
        asked = weighted.join(lengths, "__query").select("gram", "__query", (F.col("qw") / F.col("qlength")).alias("qw"))
        scored = attach(self.postings(), asked, "gram").groupBy("__query", "key").agg(F.round(F.sum(F.col("w") * F.col("qw")), digits).alias("score"))
        best = top_k_per_group(scored, "__query", [F.desc("score"), F.asc("key")], k)
        found = attach(best, self.entries().select("key", "copies"), "key", derived=True)
        return found.select(F.col("__query").alias(query_key), "key", "copies", "score", "rank")
