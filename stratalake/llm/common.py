"""What several operators share: stored intermediate tables, words of text batches, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.joins import attach
from stratalake.sources.shared import new_folder

#: Bytes of text that a task turns into arrays at a time; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read again: later steps start from files that outlive executors."""
    folder = new_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_batches(spark: SparkSession) -> None:
    """Rows travel to Python 1,000 at a time in this session, unless it sets another number: texts are long rows.

    At Spark's default of 10,000 rows a batch of ordinary pages takes tens of megabytes in the JVM and again in Python,
    for each task, and one of long texts any amount.
    """
    if spark.conf.get(_BATCH_ROWS, "10000") == "10000":
        spark.conf.set(_BATCH_ROWS, "1000")


_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now: it does so once the driver's JVM has collected their plans.

    Plans hang together by references that a first collection only queues, hence two, each with a moment for the cleaner.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def binary(column: pa.Array) -> list[bytes]:
    """The values of a text column as bytes; null counts as empty."""
    return [x if x is not None else b"" for x in column.cast(pa.binary()).to_pylist()]


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES):
    """Slices of the batches with their texts as bytes, each slice of about ``limit`` bytes or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = int(size[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(size, before + limit, side="right")))
            part = batch.slice(begin, end - begin)
            yield part, binary(part.column(column))
            begin = end
    trim()


def trim() -> None:
    """Give memory that a task has freed back to the system: Python workers live on, and so would their largest size."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


class Words:
    """The words of a batch of texts: maximal runs of bytes other than 0x20 and 0x09-0x0D.

    ``buffer`` holds all words, each followed by one space, so consecutive words of one text are a slice of it.
    ``start`` and ``end`` bound each word there; words ``first[d]`` to ``first[d + 1]`` are those of text d.
    """

    def __init__(self, texts: list[bytes], lower: bool = False, table: np.ndarray | None = None):
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            table = _LOWER
        if table is not None:
            raw = table[raw]
        space = _SPACE[raw]
        before = np.empty_like(space)
        before[0], before[1:] = True, space[:-1]
        begin, stop = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        keep = ~space
        keep[stop] = True
        self.buffer = raw[keep]
        length = stop - begin
        self.end = np.cumsum(length + 1) - 1
        self.start = self.end - length
        self.buffer[self.end] = 32
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(begin, offsets)

    def numbered(self) -> tuple[np.ndarray, pa.Array]:
        """A number from 0 for each word, equal exactly for equal words, and the words by number, each followed by a space."""
        ends = np.append(self.start, len(self.buffer)).astype(np.int64)
        column = pa.Array.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.buffer))])
        found = column.dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary

    def hashes(self) -> np.ndarray:
        """A 64-bit number for each word, the same for equal words."""
        out = np.empty(len(self.start), np.uint64)
        a = 0
        while a < len(out):
            b = max(a + 1, int(np.searchsorted(self.end, self.start[a] + BATCH_BYTES, side="right")))
            low, high = int(self.start[a]), int(self.end[b - 1])
            if high - low > BATCH_BYTES:  # one very long word
                out[a] = xxhash.xxh64_intdigest(self.buffer[low:high])
            else:
                power, inverse = _power_tables(high - low + 1)
                total = np.zeros(high - low + 1, np.uint64)
                np.cumsum((self.buffer[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=total[1:])
                s, e = self.start[a:b] - low, self.end[a:b] - low
                out[a:b] = mixed((total[e] - total[s]) * inverse[s])
            a = b
        return out


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("power", ())) < size:
        for name, base in (("power", _BASE), ("inverse", _INVERSE)):
            steps = np.full(max(size, 1 << 16), base)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["power"], _powers["inverse"]


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers with their bits scattered (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n-grams that begin at each place but the last n - 1."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for k in range(n):
        out = mixed(out * np.uint64(0x100000001B3) + hashes[k:k + size])
    return out


def components(edges: DataFrame) -> DataFrame:
    """Connected components of links (u, v) between ordered ids: a row (node, root) for each node of a link.

    ``root`` is the smallest node of the component. Alternating large-star and small-star steps. A node's smallest
    neighbour comes from an aggregation that combines before its shuffle and is stored, so that the join back to its
    links has both sides at hand: it is a broadcast where the stored side measures small, else the links of hubs are
    spread over many tasks. No links: no rows.
    """
    links = stored(_oriented(edges.select("u", "v")).where("u > v").distinct(), "links")
    state = None
    while True:
        now = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 7))")).first()
        if now == state or not now[0]:
            break
        state = now
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = attach(both, stored(least, "least"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.distinct(), "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        pairs = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = attach(large, least, "u").select(F.explode(pairs).alias("p")).select("p.u", "p.v").where("u != v").distinct()
        links = stored(small, "links")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))


def plain_names(df: DataFrame) -> DataFrame:
    """The frame with columns c0, c1, ..., names that no operator uses for its own; ``toDF`` gives the old ones back."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])
