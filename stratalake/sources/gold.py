"""Gold figures that are refreshed from new batches alone.

A figure per key is kept as partial states, one set for each batch: sums and counts, extremes, distinct (key, value)
pairs, or a HyperLogLog sketch. A refresh reads the rows of the batches it is given, stores their states beside those
of earlier batches, and merges states; rows of earlier batches are not read again. A batch that comes again replaces
its own states.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.draws import col
from stratalake.sources.lake import Lake
from stratalake.sources.shared import new_folder


@dataclass(frozen=True)
class Measure:
    """How a figure is kept: aggregates over a batch's rows, the aggregate that merges each, and the figure itself.

    ``pairs`` is the column whose distinct values are counted exactly; such a measure has no other state.
    """

    partial: tuple[Column, ...] = ()
    merge: tuple[Callable[[Column], Column], ...] = ()
    figure: Callable[..., Column] | None = None
    pairs: Column | None = None


def rows(condition: Column | None = None) -> Measure:
    """Number of rows, or of those that meet a condition."""
    counted = F.count(F.lit(1)) if condition is None else F.count_if(condition)
    return Measure((counted,), (F.sum,), lambda n: n)


def total(value: Column | str) -> Measure:
    return Measure((F.sum(col(value)),), (F.sum,), lambda s: s)


def mean(value: Column | str, digits: int = 4) -> Measure:
    """Mean of the values that are not NULL, from their sum and number."""
    return Measure((F.sum(col(value)), F.count(col(value))), (F.sum, F.sum), lambda s, n: F.round(F.try_divide(s.cast("double"), n), digits))


def least(value: Column | str) -> Measure:
    return Measure((F.min(col(value)),), (F.min,), lambda x: x)


def most(value: Column | str) -> Measure:
    return Measure((F.max(col(value)),), (F.max,), lambda x: x)


def distinct(value: Column | str) -> Measure:
    """Exact number of distinct values; the state holds each (key, value) pair of a batch once."""
    return Measure(pairs=col(value))


def sketched(value: Column | str, lg_k: int = 12) -> Measure:
    """Estimated number of distinct values from sketches of fixed size, with a standard error of about 1.04 / sqrt(2^lg_k)."""
    return Measure((F.hll_sketch_agg(col(value), lg_k),), (F.hll_union_agg,), F.hll_sketch_estimate)


class IncrementalGold:
    """A gold table of figures per key over all batches taken so far.

    States lie in folders of their own; a table ``<name>_batches`` tells which folder holds each batch's, and the gold
    table is published from them. Both are switched as a whole, so a refresh that fails changes neither or is made good
    by the next one, and a reader never sees half a refresh.
    """

    def __init__(self, lake: Lake, name: str, keys: Sequence[str], measures: Mapping[str, Measure]):
        if not measures or set(keys) & set(measures):
            raise ValueError("measures need names of their own, one at least")
        self.lake, self.name, self.keys, self.measures = lake, name, list(keys), dict(measures)

    @property
    def _register(self) -> str:
        return f"{self.name}_batches"

    def batches(self) -> dict[str, str]:
        """The batches taken and the folders of their states."""
        if not self.lake.versions("gold", self._register):
            return {}
        return {r["batch"]: r["folder"] for r in self.lake.table("gold", self._register).collect()}  # a row per batch

    def refresh(self, new: Mapping[str, DataFrame]) -> DataFrame:
        """Take new batches, or batches that replace earlier ones of the same name, and return the gold table."""
        told = self.batches() | {batch: self._store(self._partial(df), {m: self._pairs(df, m) for m in self._exact}) for batch, df in new.items()}
        self._tell(told)
        return self.publish()

    def compact(self, into: str, batches: Sequence[str]) -> None:
        """Merge the states of some batches into one batch; they can then only be replaced together."""
        told = self.batches()
        folders = [told.pop(b) for b in batches]
        told[into] = self._store(self._merged(folders), {m: self._stored_pairs(folders, m) for m in self._exact})
        self._tell(told)

    def publish(self) -> DataFrame:
        """Write the gold table from the stored states; there must be a batch."""
        folders = list(self.batches().values())
        if not folders:
            raise ValueError("no batch has been taken yet")
        merged = self._merged(folders)
        figures = [F.col(k) for k in self.keys]
        for name, m in self.measures.items():
            if m.pairs is None:
                figures.append(m.figure(*[F.col(c) for c in self._states(name)]).alias(name))
        out = merged.select(*figures)
        for name in self._exact:
            # distinct pairs first, so a key with a third of the rows is spread by its values
            counted = self._stored_pairs(folders, name).groupBy(*self.keys).agg(F.count("__value").alias(name))
            same = reduce(lambda a, b: a & b, [out[k].eqNullSafe(counted[k]) for k in self.keys], F.lit(True))
            out = out.join(counted, same, "left").select(*[out[c] for c in out.columns], F.coalesce(counted[name], F.lit(0)).alias(name))
        return self.lake.promote(out.select(*self.keys, *self.measures), "gold", self.name)

    @property
    def _exact(self) -> list[str]:
        return [name for name, m in self.measures.items() if m.pairs is not None]

    def _states(self, name: str) -> list[str]:
        return [f"__{name}_{i}" for i in range(len(self.measures[name].partial))]

    def _partial(self, df: DataFrame) -> DataFrame:
        states = [p.alias(c) for name, m in self.measures.items() for p, c in zip(m.partial, self._states(name))]
        return df.groupBy(*self.keys).agg(*states, F.count(F.lit(1)).alias("__rows"))

    def _pairs(self, df: DataFrame, name: str) -> DataFrame:
        return df.select(*self.keys, self.measures[name].pairs.alias("__value")).distinct()

    def _store(self, partial: DataFrame, pairs: Mapping[str, DataFrame]) -> str:
        folder = new_folder(self.lake.spark, f"states-{self.name}")
        partial.write.parquet(f"{folder}/partial")
        for name, frame in pairs.items():
            frame.write.parquet(f"{folder}/pairs-{name}")
        return folder

    def _tell(self, told: Mapping[str, str]) -> None:
        self.lake.sink_table(self.lake.spark.createDataFrame(sorted(told.items()), "batch string, folder string"), "gold", self._register)

    def _merged(self, folders: Sequence[str]) -> DataFrame:
        stored = self.lake.spark.read.parquet(*[f"{f}/partial" for f in folders])
        merged = [merge(F.col(c)).alias(c) for name, m in self.measures.items() for merge, c in zip(m.merge, self._states(name))]
        return stored.groupBy(*self.keys).agg(*merged, F.sum("__rows").alias("__rows"))

    def _stored_pairs(self, folders: Sequence[str], name: str) -> DataFrame:
        return self.lake.spark.read.parquet(*[f"{f}/pairs-{name}" for f in folders]).distinct()
