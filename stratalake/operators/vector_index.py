"""Cosine search by an inverted file: vectors lie in cells around centres, and a query reads the nearest cells alone."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stratalake.operators.joins import attach
from stratalake.operators.sequence import top_k_per_group
from stratalake.operators.vectors import centroids
from stratalake.sources.shared import new_folder

#: The most cells, and the rows that the centres are fitted on for each cell.
MOST_CELLS, SAMPLE_PER_CELL = 4_096, 256
#: Rows of a cell that one task writes.
ROWS_PER_FILE = 250_000
#: Queries that travel to the tasks in one pass over the cells that they probe.
QUERIES_PER_PASS = 1_024
_ARROW = {T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.StringType: pa.string()}


def _unit(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors of a length above 0, and those vectors at length 1."""
    rows = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
    x = np.array([column[i].as_py() for i in rows.tolist()], dtype="float64") if len(rows) else np.zeros((0, 1))
    length = np.linalg.norm(x, axis=1)
    some = np.isfinite(length) & (length > 0)
    return rows[some], x[some] / length[some][:, None]


def _with_cell(df: DataFrame, vector: str, centres: np.ndarray, n: int, spread: np.ndarray | None = None) -> DataFrame:
    """``df`` with its ``n`` nearest cells and, for the nearest, the files it is spread over; rows without a direction go."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = _unit(batch.column(vector))
            if not len(rows):
                continue
            near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :n]
            files = np.ones(len(rows), np.int32) if spread is None else spread[near[:, 0]]
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(rows)) for c in batch.columns), pa.array(near.astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(files)],
                names=[*batch.schema.names, "__cells", "__files"])

    return df.mapInArrow(assign, T.StructType([*df.schema.fields, *T._parse_datatype_string("__cells array<int>, __files int").fields]))


def fit_centres(corpus: DataFrame, key: str, vector: str, cells: int, rounds: int = 8, sample: int | None = None) -> np.ndarray:
    """Centres of ``cells`` cells by spherical k-means over about ``sample`` rows, chosen by a hash of the key.

    Each round assigns the sample in tasks and averages it by an aggregation; the driver holds the centres alone.
    """
    sample = SAMPLE_PER_CELL * cells if sample is None else sample
    directed = F.exists(vector, lambda x: x != 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x) < math.inf, F.lit(False)))
    rows = corpus.select(key, vector).where(F.col(vector).isNotNull() & directed)
    n = rows.count()
    if n > sample:
        rows = rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(sample / n * (1 << 30)) + 1)
    rows = _stored(rows, "centre-sample")
    first = rows.groupBy(vector).agg(F.min(F.xxhash64(key)).alias("h")).orderBy("h").limit(cells).collect()  # different vectors, at most `cells`
    if not first:
        return np.zeros((0, 1))
    centres = np.array([r[0] for r in first], dtype="float64")
    length = np.linalg.norm(centres, axis=1)
    centres /= length[:, None]
    for _ in range(rounds):
        placed = _with_cell(rows, vector, centres, 1).withColumn("cell", F.col("__cells")[0])
        told = centroids(placed, "cell", vector).collect()  # a row per cell
        new = centres.copy()
        for r in told:
            new[r["cell"]] = r[vector]
        length = np.linalg.norm(new, axis=1)
        centres = np.where(length[:, None] > 0, new / np.maximum(length, 1e-300)[:, None], centres)
    return centres


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class VectorIndex:
    """An inverted file under a folder: Parquet by cell, and the centres beside it."""

    def __init__(self, spark: SparkSession, path: str, key: str, vector: str, centres: np.ndarray):
        self.spark, self.path, self.key, self.vector, self.centres = spark, path.rstrip("/"), key, vector, centres

    @classmethod
    def build(cls, corpus: DataFrame, key: str, vector: str, path: str, cells: int | None = None, *, rounds: int = 8, sample: int | None = None) -> VectorIndex:
        """Index every vector of a length above 0. ``cells``: by default the square root of the rows, at most 4,096.

        A cell that holds many rows is written by several tasks, so no cell is gathered in one.
        """
        n = corpus.count()
        cells = min(MOST_CELLS, max(1, round(math.sqrt(n)))) if cells is None else cells
        centres = fit_centres(corpus, key, vector, cells, rounds, sample)
        rows = corpus.select(key, vector)
        spark, index = corpus.sparkSession, cls(corpus.sparkSession, path, key, vector, centres)
        if not len(centres):
            rows.where("false").withColumn("cell", F.lit(0)).write.parquet(f"{index.path}/cells")
        else:
            held = _with_cell(rows, vector, centres, 1).groupBy(F.col("__cells")[0].alias("cell")).count().collect()  # a row per cell
            spread = np.ones(len(centres), np.int32)
            for r in held:
                spread[r["cell"]] = -(-r["count"] // ROWS_PER_FILE)
            placed = _with_cell(rows, vector, centres, 1, spread).withColumn("cell", F.col("__cells")[0])
            placed = placed.repartition("cell", F.pmod(F.xxhash64(key), F.col("__files")))
            placed.select(key, vector, "cell").write.partitionBy("cell").parquet(f"{index.path}/cells")
        told = spark.createDataFrame([(key, vector, json.dumps(centres.tolist()))], "key string, vector string, centres string")
        told.coalesce(1).write.json(f"{index.path}/centres")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorIndex:
        told = spark.read.schema("key string, vector string, centres string").json(f"{path.rstrip('/')}/centres").first()
        return cls(spark, path, told["key"], told["vector"], np.array(json.loads(told["centres"])))

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/cells")

    def cell_sizes(self) -> DataFrame:
        """Bytes and files of each cell, from the listing of the files."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{self.path}/cells")
        cell = F.regexp_extract("_metadata.file_path", "/cell=([0-9]+)/", 1).cast("int")
        return files.select(cell.alias("cell"), F.col("_metadata.file_size").alias("bytes")).groupBy("cell").agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("files"))

    def probed(self, queries: DataFrame, query_key: str, probes: int) -> DataFrame:
        """Rows (query, cell): the cells that each query reads."""
        placed = _with_cell(queries.select(query_key, self.vector), self.vector, self.centres, max(probes, 1))
        return placed.select(query_key, F.explode("__cells").alias("cell"))

    def probes_for(self, queries: DataFrame, query_key: str, k: int, target: float = 0.95, sample: int = 256) -> int:
        """The fewest probes that find ``target`` of the true ``k`` neighbours of about ``sample`` queries, chosen by a hash.

        The sample is searched in all cells; where the cell of a true neighbour stands in the order of its query's cells
        tells how many probes it takes to find it.
        """
        n, cells = queries.count(), len(self.centres)
        if not n or not cells:
            return 1
        share = min(1.0, sample / n)
        some = _stored(queries.where(F.pmod(F.xxhash64(query_key, F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)) + 1).select(query_key, self.vector), "some-queries")
        true = self.search(some, query_key, k, cells).select(query_key, self.key)
        placed = _with_cell(some, self.vector, self.centres, cells).select(query_key, "__cells")
        held = attach(self.rows().select(self.key, "cell"), _stored(true, "true-neighbours"), self.key)
        place = attach(held, placed, query_key, derived=True).select(F.array_position("__cells", F.col("cell")).alias("place"))
        told = sorted((r["place"], r["n"]) for r in place.groupBy("place").agg(F.count("*").alias("n")).collect())  # a row per place
        found, total = 0, sum(n for _, n in told)
        for at, n in told:
            found += n
            if found >= target * total:
                return at
        return 1

    def search(self, queries: DataFrame, query_key: str, k: int, probes: int, *, digits: int = 5, queries_per_pass: int = QUERIES_PER_PASS) -> DataFrame:
        """The ``k`` rows nearest to each query among those of its ``probes`` nearest cells, ranked by rounded cosine, then key.

        Cosines are exact; with all cells probed so is the result. Queries travel in blocks of neighbouring ones; a pass
        reads only the cells that its block probes, and a task hands on its k best rows per query. Queries without a
        direction find nothing.
        """
        schema = T.StructType([T.StructField(query_key, queries.schema[query_key].dataType), self.rows().schema[self.key], T.StructField("cosine", T.DoubleType())])
        if not len(self.centres):
            return top_k_per_group(self.spark.createDataFrame([], schema), query_key, [F.desc("cosine"), F.asc(self.key)], k)
        placed = _stored(_with_cell(queries.select(query_key, self.vector), self.vector, self.centres, max(probes, 1)), "probes")
        n = placed.count()
        passes = max(1, -(-n // queries_per_pass))
        blocks = placed.withColumn("__block", F.lit(0))
        if passes > 1:  # blocks by cell, so that the queries of a pass probe the same cells
            nearest, at, entries = F.col("__cells")[0], 0, []
            for cell, held in sorted(placed.groupBy(nearest.alias("c")).agg(F.count("*")).collect()):  # a row per cell
                blocks_of_cell = F.struct(F.lit(at // queries_per_pass).alias("first"), F.lit(-(-held // queries_per_pass)).alias("n"))
                entries += [F.lit(cell), blocks_of_cell]
                at += held
            own = F.create_map(*entries)[nearest]
            blocks = placed.withColumn("__block", own["first"] + F.pmod(F.xxhash64(query_key), own["n"]).cast("int"))
        found = None
        for b in sorted(r[0] for r in blocks.select("__block").distinct().collect()):
            part = self._pass(blocks.where(F.col("__block") == b), query_key, k, digits, schema)
            found = part if found is None else found.unionAll(part)
        if found is None:
            found = self.spark.createDataFrame([], schema)
        return top_k_per_group(found, query_key, [F.desc("cosine"), F.asc(self.key)], k)

    def _pass(self, block: DataFrame, query_key: str, k: int, digits: int, schema: T.StructType) -> DataFrame:
        told = block.select(query_key, self.vector, "__cells").collect()  # about queries_per_pass rows
        keys = [r[0] for r in told]
        matrix = np.array([r[1] for r in told], dtype="float64")
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        asked: dict[int, list[int]] = {}
        for q, r in enumerate(told):
            for c in r[2]:
                asked.setdefault(c, []).append(q)
        asked = {c: np.array(qs) for c, qs in asked.items()}
        key, vector = self.key, self.vector

        def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, at, near = [], np.zeros(0, np.int64), np.zeros(0)
            for batch in batches:
                rows, x = _unit(batch.column(vector))
                cell, names = batch.column("cell").to_numpy()[rows], batch.column(key).take(pa.array(rows)).to_pylist()
                for c in np.unique(cell).tolist():
                    own = np.flatnonzero(cell == c)
                    found = np.round(x[own] @ matrix[asked[c]].T, digits) + 0.0
                    r, q = np.nonzero(found >= (-np.partition(-found, k - 1, axis=0)[k - 1] if len(own) > k else -2.0))
                    ids += [names[own[i]] for i in r.tolist()]
                    at, near = np.concatenate([at, asked[c][q]]), np.concatenate([near, found[r, q]])
                order = sorted(range(len(ids)), key=lambda i: (at[i], -near[i], ids[i]))
                seen = np.bincount(at, minlength=len(keys))
                begin = np.concatenate([[0], np.cumsum(seen)])
                order = [i for n, i in enumerate(order) if n - begin[at[i]] < k]
                ids, at, near = [ids[i] for i in order], at[order], near[order]
            if ids:
                columns = [pa.array([keys[q] for q in at.tolist()], _ARROW.get(type(schema[0].dataType))), pa.array(ids, _ARROW.get(type(schema[1].dataType)))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(near)], names=schema.names)

        return self.rows().where(F.col("cell").isin(sorted(asked))).mapInArrow(best_of_task, schema)

