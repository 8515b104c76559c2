"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets one of the 31 nonzero vectors of five bits; the mask of a nonzero five-bit vector v holds the
positions whose vector has an odd product with v. Four positions span at most four of the five dimensions, so for any
two fingerprints that differ in at most four bits some v is orthogonal to all places where they differ: they agree
under its mask. 31 tables therefore find every pair, and none is missed by chance.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import attach

from .common import Words, components, stored, text_batches

RADIUS = 4
WORDS = 4
SEED = 42
#: Different fingerprints of a bucket that one row may hold; larger buckets are linked over midpoints.
BUCKET = 1024
_BLOCK = 1 << 14


def covering_masks(radius: int = RADIUS) -> list[int]:
    """The masks, as signed 64-bit numbers."""
    size = (1 << (radius + 1)) - 1
    vectors = [i % size + 1 for i in range(64)]
    masks = (sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size + 1))
    return [_signed(m) for m in masks]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash(texts: list[bytes], words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprints of some texts (see ``fingerprints``) as unsigned numbers."""
    w = Words(texts, lower=True)
    count = np.diff(w.first)
    shingles = np.where(count == 0, 0, np.maximum(count - words + 1, 1))
    place = np.concatenate([[0], np.cumsum(shingles)])
    text = np.repeat(np.arange(len(texts)), shingles)
    begin = w.first[text] + np.arange(place[-1]) - place[text]
    last = np.minimum(begin + words, w.first[text + 1]) - 1
    sums = np.zeros((len(texts), 64), np.int64)
    view, digest = memoryview(w.buffer), xxhash.xxh64_intdigest
    for a in range(0, int(place[-1]), _BLOCK):
        b = min(a + _BLOCK, int(place[-1]))
        spans = zip(w.start[begin[a:b]].tolist(), w.end[last[a:b]].tolist(), strict=True)
        h = np.array([digest(view[s:e], seed) for s, e in spans], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        owners, where = np.unique(text[a:b], return_index=True)
        sums[owners] += np.add.reduceat(bits, where, axis=0, dtype=np.int64)
    ones = 2 * sums > shingles[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row (id, fp) for each row of ``docs``; ``fp`` is the fingerprint as a signed 64-bit number.

    Words are runs of bytes other than 0x20 and 0x09-0x0D after lower-casing A-Z; shingles are four consecutive words
    joined by a space, repeats included, or the whole sequence where there are fewer. A bit is set if it is set in
    over half of the shingles' XXH64. Null, empty and blank texts have fingerprint zero.
    """
    name = id

    def run(batches):
        for batch, texts in text_batches(batches, text):
            yield pa.RecordBatch.from_arrays(
                [batch.column(name), pa.array(simhash(texts).view(np.int64))], names=[name, "fp"])

    schema = T.StructType([docs.schema[id], T.StructField("fp", T.LongType())])
    return docs.select(id, text).mapInArrow(run, schema)


def bucket_links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) whose components are those of "at most ``radius`` bits differ" among different fingerprints.

    Buckets of two are settled by their smallest and largest member. Larger ones up to ``bucket`` are compared in one
    row and give a link from each member to the smallest of its component there, never all pairs. Beyond that
    every member names all points within half the radius that share its masked bits: two fingerprints lie within the
    radius exactly if they name a common point, and a point can be named by some 2,000 fingerprints at most.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    cells = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
    rows = fps.select("fp", F.explode(cells).alias("c")).select("fp", "c.t", "c.key")
    counted = rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    counted = stored(counted.where("n > 1"), "buckets")
    near = F.expr(f"bit_count(u ^ v) <= {radius}")
    two = counted.where("n = 2").where(near).select("u", "v")
    members = attach(rows, counted.where("n > 2").select("t", "key", "n"), ["t", "key"])

    def within(batches):
        for batch in batches:
            us, vs = [], []
            for fp in batch.column("fps"):
                u, v = _stars(np.array(fp.as_py(), np.int64), radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    small = members.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    small = small.select("fps").mapInArrow(within, "u long, v long")
    spark = fps.sparkSession
    free = [[i for i in range(64) if not m >> i & 1] for m in masks]
    steps = [(t, [_signed(sum(1 << i for i in c)) for k in range(radius // 2 + 1) for c in combinations(bits, k)]) for t, bits in enumerate(free)]
    steps = spark.createDataFrame(steps, "t int, steps array<long>")  # 31 rows of about 500 numbers
    large = members.where(F.col("n") > bucket).join(F.broadcast(steps), "t")
    named = large.select("fp", F.explode("steps").alias("step")).select("fp", F.expr("fp ^ step").alias("point")).distinct()
    points = named.groupBy("point").agg(F.min("fp").alias("v"), F.collect_list("fp").alias("fps")).where("size(fps) > 1")
    over = points.select(F.explode("fps").alias("u"), "v").where("u != v")
    return two.unionByName(small).unionByName(over).distinct()


def _stars(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links from members of a bucket to the smallest member of their component in it."""
    fp = np.sort(fp)
    bits = fp.view(np.uint64)  # the bit count of a negative number is that of its absolute value
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label, len(fp)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    linked = label != np.arange(len(fp))
    return fp[linked], fp[label[linked]]


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """For each row of ``docs``: id, ``fingerprint`` (16 hex digits) and ``component_id``.

    Fingerprints that differ in at most four bits are linked; ``component_id`` is the smallest id that links reach, the
    own one included. Equal fingerprints are one class before any search, so copies cost one row each; a hot class
    (empty texts, say) or component meets its result by broadcast, or spread over many tasks. Rows with a repeated id
    each get a result; a null id keeps its place and is nobody's ``component_id`` unless its component has no other.
    Columns besides id and text are not read. No rows: an empty result.
    """
    found = stored(fingerprints(docs, id, text).select(F.col(id).alias("id"), "fp"), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    roots = components(bucket_links(classes.select("fp"), bucket=bucket)).select(F.col("node").alias("fp"), "root")
    placed = classes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "placed")
    least = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    component = stored(attach(placed, least, "root").select("fp", "component_id"), "component")
    out = attach(found, component, "fp")
    return out.select(F.col("id").alias(id), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
