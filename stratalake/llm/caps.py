"""Near-duplicate embeddings by spherical-cap filters with structured random product codes.

A filter is a direction; a vector falls into it if its inner product with the direction exceeds a threshold. The
directions of a table are all pairs of a codeword of the first half of the coordinates and one of the second, after a
random rotation, so the few directions that a vector exceeds are listed without visiting the many others. Vectors
that share a filter (and a label) are compared exactly.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import attach

from .common import components, stored, trim

COSINE = 0.98
#: Independent rotations, the filters a vector is expected to exceed in each, and the least it is listed in.
TABLES, LISTED, LEAST = 5, 6, 4
#: Vectors of a filter that are compared in one step; larger filters are dealt into blocks of about this size.
BLOCK = 768
#: Vectors of one label that a filter is expected to hold if vectors lie evenly.
FILL = 32


class ProductCode:
    """The filters for vectors of one dimension, drawn from a fixed seed."""

    def __init__(self, dimension: int, vectors: int):
        self.half = dimension // 2
        bits = math.ceil(math.log2(max(vectors, 1) * LISTED / FILL + 1) / 2)
        self.size = 1 << min(max(bits, 4), 14)
        self.threshold = NormalDist().inv_cdf(1 - min(0.5, LISTED / self.size**2)) / math.sqrt(dimension)
        random = np.random.default_rng(dimension)
        unit = lambda n, d: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(random.standard_normal((n, d)))
        self.tables = []
        for _ in range(TABLES if dimension >= 4 else 0):
            rotation = np.linalg.qr(random.standard_normal((dimension, dimension)))[0]
            self.tables.append((rotation, unit(self.size, self.half) / math.sqrt(2), unit(self.size, dimension - self.half) / math.sqrt(2)))

    def listed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``x`` and the filters that they exceed; rows with fewer than ``LEAST`` in a table get a lower threshold there."""
        if not self.tables:
            return np.arange(len(x)), np.zeros(len(x), np.int64)
        rows, filters = [], []
        for t, (rotation, one, two) in enumerate(self.tables):
            y = x @ rotation
            a, b = y[:, :self.half] @ one.T, y[:, self.half:] @ two.T
            open_rows, threshold = np.arange(len(x)), np.full(len(x), self.threshold)
            while len(open_rows):
                r, f = self._exceeded(a[open_rows], b[open_rows], threshold[open_rows])
                enough = np.bincount(r, minlength=len(open_rows)) >= LEAST
                done = enough[r]
                rows.append(open_rows[r[done]])
                filters.append(f[done] + t * self.size**2)
                open_rows = open_rows[~enough]
                threshold[open_rows] -= 0.1 * self.threshold + 1e-3
        return np.concatenate(rows), np.concatenate(filters)

    def _exceeded(self, a: np.ndarray, b: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, first = np.nonzero(a >= (threshold - b.max(axis=1))[:, None])  # codewords with any partner
        step, out = max(1, (1 << 22) // self.size), []
        for k in range(0, len(rows), step):
            r, c = rows[k:k + step], first[k:k + step]
            at, second = np.nonzero(b[r] >= (threshold[r] - a[r, c])[:, None])
            out.append((r[at], c[at] * self.size + second))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2


def _vectors(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit vectors in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def linked(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Rows (id, n_links, component_id, kept): near-duplicates among vectors of equal, not null label.

    Vectors link if their cosine, in double precision, is at least ``cosine``; pairs are found through filters, and
    each pair found is settled exactly. ``n_links`` counts the other rows linked, ``component_id`` is the smallest id
    that links reach, ``kept`` says that it is the row's own. Null or zero vectors, those with null or non-finite
    components and rows without a label link with nothing; vectors of different lengths do not either. Equal vectors are
    one class throughout, whatever their number, and count each other. Rows that repeat an id count as rows; a null
    id is kept and nobody's ``component_id`` unless there is no other.
    """
    number = F.transform(F.col(embedding), lambda x: x.cast("double"))
    sound = F.coalesce((F.size(embedding) > 0) & F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(number, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v"), (sound & F.col(label).isNotNull()).alias("sound"))
    classes = rows.where("sound").groupBy("label", "v").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("rid"), "label", "v", "least", "n", F.size("v").alias("d")), "classes")
    total = classes.count()

    def decode(batches):
        codes = {}
        for batch in batches:
            d = batch.column("d").to_numpy()
            for size in np.unique(d).tolist():
                at = pa.array(np.flatnonzero(d == size))
                own = batch.take(at)
                codes.setdefault(size, ProductCode(size, total))
                step = max(64, min(2048, (1 << 22) // codes[size].size))  # rows of inner products with all codewords
                for k in range(0, own.num_rows, step):
                    part = own.slice(k, step)
                    row, f = codes[size].listed(_vectors(part.column("v")))
                    taken = pa.array(row)
                    yield pa.RecordBatch.from_arrays([*(part.column(c).take(taken) for c in ("rid", "label", "d")), pa.array(f)], names=["rid", "label", "d", "f"])

    lists = T.StructType([*(classes.schema[c] for c in ("rid", "label", "d")), T.StructField("f", T.LongType())])
    listed = stored(classes.select("rid", "label", "d", "v").mapInArrow(decode, lists), "filters")
    fill = stored(listed.groupBy("label", "d", "f").agg(F.count("*").alias("k")).where("k > 1"), "fill")
    shared = attach(listed, fill, ["label", "d", "f"]).select("rid", "f", F.ceil(F.col("k") / block).cast("int").alias("blocks"))
    mine = shared.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("f", "blocks"))).alias("own"))  # a vector's own filters
    whole = classes.join(mine, "rid").withColumn("fs", F.transform("own", lambda x: x["f"])).withColumn("o", F.explode("own"))
    whole = whole.select("rid", "label", "d", "v", "n", "fs", F.col("o.f").alias("f"), F.col("o.blocks").alias("blocks"),
                         F.pmod(F.hash("rid"), F.col("o.blocks")).alias("b"))
    cells = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, b) as i, greatest(x, b) as j))")
    dealt = whole.withColumn("cell", F.explode(cells)).select("label", "d", "f", "cell.i", "cell.j", "b", "rid", "n", "v", "fs")
    key = ["label", "d", "f", "i", "j"]
    dealt = dealt.repartition(*key).sortWithinPartitions(*key)

    def compare(batches):
        for rows in _groups(batches, key):
            out = _cell(rows, cosine)
            if out is not None:
                yield out
        trim()

    found = stored(dealt.mapInArrow(compare, "rid long, links long, root long"), "links")
    roots = components(found.where("root is not null").select(F.col("rid").alias("u"), F.col("root").alias("v")))
    links = found.groupBy("rid").agg(F.sum("links").alias("links"))
    placed = classes.join(links, "rid", "left").join(roots.withColumnRenamed("node", "rid"), "rid", "left")
    placed = placed.select("label", "v", "least", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root"))
    placed = stored(placed, "placed")
    least = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    placed = stored(attach(placed, least, "root").select("label", "v", "n_links", "component_id"), "component")
    good = attach(rows.where("sound"), placed, ["label", "v"]).select("id", "n_links", "component_id")
    rest = rows.where("not sound").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = good.unionByName(rest)
    return out.select(F.col("id").alias(id), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _groups(batches, key: list[str]):
    """Runs of rows with equal key, from rows sorted by it; a run has at most about two blocks of rows."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        new = np.zeros(table.num_rows, bool)
        for c in key:
            x = table.column(c).to_numpy()
            new[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(new).tolist()]
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 1:
                yield table.slice(a, b - a).combine_chunks()
        held = table.slice(edges[-1]).combine_chunks()
    if held is not None and held.num_rows > 1:
        yield held


def _cell(rows: pa.Table, cosine: float) -> pa.RecordBatch | None:
    """Links of the rows of one cell: for each row those whose smallest shared filter is this one, and its root here."""
    column = lambda c: rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0)
    rid, n, b, f = column("rid").to_numpy(), column("n").to_numpy(), column("b").to_numpy(), column("f")[0].as_py()
    i, j = column("i")[0].as_py(), column("j")[0].as_py()
    x = _vectors(column("v"))
    near = x @ x.T >= cosine
    np.fill_diagonal(near, False)
    if i != j:
        near &= b[:, None] != b[None, :]
    if not near.any():
        return None
    fs = column("fs")
    flat, owner = fs.flatten().to_numpy(), np.repeat(np.arange(len(rid)), fs.value_lengths().to_numpy())
    below = flat < f
    names, place = np.unique(flat[below], return_inverse=True)
    member = np.zeros((len(rid), max(len(names), 1)), np.float32)
    member[owner[below], place] = 1
    first = near & (member @ member.T == 0)
    links = first @ n
    label = np.arange(len(rid))
    while True:
        new = np.minimum(label, np.where(near, label, len(rid)).min(axis=1))
        new = new[new]
        if (new == label).all():
            break
        label = new
    root = np.array([None if r == k else int(rid[r]) for k, r in enumerate(label.tolist())], object)
    some = np.flatnonzero((links > 0) | (label != np.arange(len(rid))))
    return pa.RecordBatch.from_arrays([pa.array(rid[some]), pa.array(links[some].astype(np.int64)), pa.array(root[some], pa.int64())], names=["rid", "links", "root"])
