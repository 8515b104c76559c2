"""Exact cosine search of a few query vectors in a corpus of any size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from stratalake.operators.sequence import top_k_per_group

#: Query vectors compared in one pass over the corpus.
QUERIES_PER_PASS = 1_024


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Mean vector per group; what is moved is one partial sum per group and dimension."""
    cells = df.select(group, F.posexplode(vector).alias("at", "x"))
    means = cells.groupBy(group, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    entries = means.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("entries"))
    return entries.select(group, F.col("entries.x").alias(vector))


def cosine_topk(
    queries: DataFrame, corpus: DataFrame, query_key: str, corpus_key: str, vector: str, k: int, *,
    digits: int = 5, queries_per_pass: int = QUERIES_PER_PASS,
) -> DataFrame:
    """The ``k`` corpus rows nearest to each query by cosine, ranked by rounded cosine and then corpus key.

    Queries travel to the tasks as a matrix; a batch of corpus rows is one matrix product, and a task hands on
    its k best rows per query, so what is moved does not grow with the pairs compared. Queries beyond
    ``queries_per_pass`` are taken in further passes over the corpus. Vectors of length 0 match nothing.
    """
    n_queries = queries.count()
    passes = max(1, -(-n_queries // queries_per_pass))
    found = None
    for p in range(passes):
        chunk = queries
        if passes > 1:
            chunk = queries.where(F.pmod(F.xxhash64(query_key), F.lit(passes)) == p)
        part = _search(chunk.select(query_key, vector), corpus, query_key, corpus_key, vector, k, digits)
        found = part if found is None else found.unionAll(part)
    return found


def _search(queries: DataFrame, corpus: DataFrame, query_key: str, corpus_key: str, vector: str, k: int, digits: int):
    rows = queries.collect()  # about queries_per_pass rows
    keys = [r[0] for r in rows]
    matrix = np.array([r[1] for r in rows] or [[]], dtype="float64")
    lengths = np.linalg.norm(matrix, axis=1)
    keys = [key for key, length in zip(keys, lengths) if length > 0]
    matrix = matrix[lengths > 0] / lengths[lengths > 0][:, None]
    if not keys:
        corpus = corpus.where(F.lit(False))

    def best_rows(ids: np.ndarray, at: np.ndarray, cosines: np.ndarray) -> np.ndarray:
        """Positions of the k best entries of each query."""
        order = np.lexsort((ids, -cosines, at))
        starts = np.searchsorted(at[order], np.arange(len(keys)))
        return order[np.arange(len(order)) - starts[at[order]] < k]

    def best_of_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, at, cosines = np.array([], dtype="int64"), np.array([], dtype="int64"), np.array([])
        for batch in batches:
            vectors = np.stack(batch.iloc[:, 1].to_numpy()).astype("float64")
            norms = np.linalg.norm(vectors, axis=1)
            some = batch.iloc[:, 0].to_numpy()[norms > 0]
            near = np.round((vectors[norms > 0] / norms[norms > 0][:, None]) @ matrix.T, digits) + 0.0  # no negative zero
            if len(some) > k:
                rows_, at_ = np.nonzero(near >= -np.partition(-near, k - 1, axis=0)[k - 1])
            else:
                rows_, at_ = np.nonzero(np.ones_like(near, dtype=bool))
            ids = np.concatenate([ids, some[rows_]]) if len(ids) else some[rows_]
            at, cosines = np.concatenate([at, at_]), np.concatenate([cosines, near[rows_, at_]])
            best = best_rows(ids, at, cosines)
            ids, at, cosines = ids[best], at[best], cosines[best]
        if len(ids):
            yield pd.DataFrame({query_key: [keys[q] for q in at], corpus_key: ids, "cosine": cosines})

    schema = T.StructType([
        T.StructField(query_key, queries.schema[query_key].dataType),
        T.StructField(corpus_key, corpus.schema[corpus_key].dataType),
        T.StructField("cosine", T.DoubleType()),
    ])
    usable = corpus.select(corpus_key, vector).where(F.col(vector).isNotNull())
    candidates = usable.mapInPandas(best_of_task, schema)
    return top_k_per_group(candidates, query_key, [F.desc("cosine"), F.asc(corpus_key)], k)
