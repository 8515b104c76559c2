"""Filter interaction audit: what every order of some filters removes, from one count of the rows by the filters they fail.

A row is known by its mask, the set of filters that it fails. Counts by part and mask, at most 2^k for k filters, hold all
that any order can do: the rows that survive a set of filters are those whose mask shares no filter with it. The sets
are walked in Gray-code order, one filter toggled at a time. Each mask cell keeps a counter of its failures among the
active filters; a cell leaves the running survivors when the counter rises from 0 and returns when it falls back. The
2^k states are stored, and each step of an order is the difference of two of them.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.joins import attach_all

from .common import stored

#: Orders of all filters are listed, so their number is bounded.
MOST_FILTERS = 7
_SEPARATORS = " \t\n\x0b\x0c\r"


def document_filters(text: Column) -> dict[str, Column]:
    """Failure conditions A to D on a text; true where it fails. Words are maximal runs without 0x20 and 0x09-0x0D.

    A: under 200 words. B: fewer distinct words than half of all. C: over 3 % of the code points are A-Z. D: one of
    ``#$%&*|`` occurs. Null counts as empty, which fails A alone.
    """
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(_SEPARATORS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]")}


def mask_of(filters: list[Column]) -> Column:
    """The set of failed filters as a number: bit i is the i-th filter. Unknown counts as passed."""
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0))


def first_copies(rows: DataFrame, id: str, digest: str) -> DataFrame:
    """Stored rows (digest, first): the smallest id of each digest that stands in rows with different ids.

    The aggregation combines before its shuffle, so a digest of many rows is one row from each task. Null ids do not count.
    """
    ends = rows.groupBy(digest).agg(F.min(id).alias("first"), F.max(id).alias("last"))
    return stored(ends.where("first < last").select(digest, "first"), "first-copies")


def mask_counts(rows: DataFrame, part: str, mask: str, outcomes: dict[str, Column]) -> DataFrame:
    """Rows (part, mask, n, one column per outcome): how many rows there are, and for how many each outcome holds."""
    sums = [F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))).cast("long").alias(name) for name, c in outcomes.items()]
    return rows.groupBy(F.col(part).alias("part"), F.col(mask).alias("mask")).agg(F.count("*").alias("n"), *sums)


def survivors(cells: dict[int, np.ndarray], filters: int) -> np.ndarray:
    """For each set of filters, as a bit mask, the sums over the cells that fail none of it, by a Gray-code walk."""
    width = len(next(iter(cells.values()))) if cells else 1
    failures = dict.fromkeys(cells, 0)
    running = sum(cells.values(), np.zeros(width, np.int64))
    states = np.zeros((1 << filters, width), np.int64)
    states[0], active = running, 0
    for step in range(1, 1 << filters):
        toggled = step & -step  # the one bit in which consecutive Gray codes differ
        active ^= toggled
        change = 1 if active & toggled else -1
        for mask, counts in cells.items():
            if mask & toggled:
                if failures[mask] == (0 if change > 0 else 1):
                    running = running - change * counts
                failures[mask] += change
        states[active] = running
    return states


def audit(counts: DataFrame, names: str, outcomes: list[str]) -> DataFrame:
    """What each step of each order of the filters does, for each part of ``mask_counts``.

    ``names``: a letter per filter, that of bit 0 first. Rows (part, filter_order, step, kept, removed, redundant,
    unique_fails, ``<outcome>_lost`` per outcome, shapley): rows left after the step, removed by it, failing its filter
    but removed earlier, failing its filter alone, removed by it with the outcome, and removed by its filter summed
    over all orders. Parts without failures give zeros; no rows give no rows. A part has at most 2^k cells, so one
    task holds that many numbers at a time.
    """
    k = len(names)
    if not 1 <= k <= MOST_FILTERS or len(set(names)) != k:
        raise ValueError(f"one to {MOST_FILTERS} filters of different letters are needed")
    orders = ["".join(o) for o in permutations(names)]
    place = {f: i for i, f in enumerate(names)}
    lost = [f"{o}_lost" for o in outcomes]
    numbers = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]

    def steps(cells: dict[int, np.ndarray]) -> tuple[list[str], list[int], np.ndarray]:
        states = survivors(cells, k)
        alone = [int(cells[1 << i][0]) if 1 << i in cells else 0 for i in range(k)]
        shapley, rows, letters = [0] * k, [], []
        for order in orders:
            before = 0
            for letter in order:
                i = place[letter]
                after = before | 1 << i
                gone = states[before] - states[after]
                fails = states[0][0] - states[1 << i][0]
                shapley[i] += int(gone[0])
                rows.append([states[after][0], gone[0], fails - gone[0], alone[i], *gone[1:], 0])
                letters.append(i)
                before = after
        table = np.array(rows, np.int64)
        table[:, -1] = np.array(shapley)[letters]
        return [o for o in orders for _ in range(k)], list(range(1, k + 1)) * len(orders), table

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cells = {c["mask"]: np.array([c["n"], *(c[o] for o in outcomes)], np.int64) for c in row["cells"]}
                order, step, table = steps(cells)
                columns = [pa.array([row["part"]] * len(order), pa.string()), pa.array(order), pa.array(step, pa.int32()),
                           *(pa.array(table[:, j]) for j in range(len(numbers)))]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *numbers])

    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *outcomes)).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in numbers)
    return cells.select(F.col("part").cast("string"), "cells").mapInArrow(run, schema)


def audit_documents(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``audit`` of the filters A to D of ``document_filters`` and E, identical to the text of a smaller id, for each ``part``.

    ``labels`` has columns ``quality`` and ``toxic`` by id; an id is good or toxic if any of its rows says 1. A null
    text is empty, a null part the empty string; a null id has no labels and is no copy. Every row counts, rows that
    repeat an id as well, and of those with the smallest id of a text none is a copy. First copies and outcomes are joined by
    broadcast where they measure small, else with hot digests and ids spread. Texts are read once and never shuffled: a stored row of id, part, mask and SHA-256 stands
    for each. Other columns are not read.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    facts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                        mask_of(list(document_filters(F.col(text)).values())).alias("mask"), F.unhex(F.sha2(whole, 256)).alias("digest"))
    facts = stored(facts, "filter-masks")
    says = labels.select(F.col(id).alias("id"), F.expr("coalesce(quality = 1, false)").alias("good"), F.expr("coalesce(toxic = 1, false)").alias("toxic"))
    says = says.where("id is not null and (good or toxic)").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    rows = attach_all(facts, [(first_copies(facts, "id", "digest"), "digest", "left"), (stored(says, "outcomes"), "id", "left")])
    rows = rows.withColumn("mask", F.col("mask").bitwiseOR(F.when(F.col("id") > F.col("first"), F.lit(16)).otherwise(F.lit(0))))
    return audit(mask_counts(rows, "part", "mask", {"good": F.col("good"), "toxic": F.col("toxic")}), "ABCDE", ["good", "toxic"])
