"""Placement of rows on shards through a permutation-filled lookup table.

Every shard has an order of preference over the slots of a table of prime size. Shards take turns, each claiming its
next free slot, until the table is full: all get the same number of slots (give or take one), and a shard that joins or
leaves moves few slots besides its own. A row's slot is a hash of its key modulo the table size, its shard one lookup.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import plain_names

#: A prime; the table has so many rows and is broadcast (about 1 MB).
SLOTS = 65_537
MOST_SLOTS = 1_000_003


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The number of the shard that owns each slot. The order of ``shards`` decides who begins."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need different names")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"the table size must be a prime from the number of shards to {MOST_SLOTS}")
    place = [xxhash.xxh64_intdigest(s, seed=1) % slots for s in shards]
    step = [xxhash.xxh64_intdigest(s, seed=2) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    owner, left = [-1] * slots, slots
    while True:
        for k in range(len(shards)):
            at = place[k]
            while owner[at] >= 0:
                at = (at + step[k]) % slots
            owner[at], place[k] = k, (at + step[k]) % slots
            left -= 1
            if not left:
                return np.array(owner, np.int32)


def assign(df: DataFrame, keys: list[str], shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` (int) and ``shard`` (a name): equal keys share a shard, and no row is shuffled.

    A null key counts as a value of its own; all columns travel along and repeated rows stay. Columns named like a result
    are replaced by it; they may be keys all the same.
    """
    if not keys:
        raise ValueError("no key given")
    names, plain = [c.lower() for c in df.columns], plain_names(df)
    kept = [k for k, c in enumerate(names) if c not in ("slot", "shard")]
    table = [(k, shards[s]) for k, s in enumerate(lookup_table(shards, slots).tolist())]
    table = F.broadcast(df.sparkSession.createDataFrame(table, "slot int, shard string"))  # `slots` rows
    slot = F.pmod(F.xxhash64(*[F.col(f"c{names.index(k.lower())}") for k in keys]), F.lit(slots)).cast("int")
    found = plain.withColumn("slot", slot).join(table, "slot").select(*[f"c{k}" for k in kept], "slot", "shard")
    return found.toDF(*[df.columns[k] for k in kept], "slot", "shard")


def write_shards(assigned: DataFrame, folder: str, rows_a_file: int = 1_000_000) -> None:
    """Write the rows of ``assign`` as Parquet, a folder for each shard.

    Each slot's rows are dealt over tasks by a hash of the whole row, so a key that holds a third of all rows fills many files
    of its shard and not one task.
    """
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in assigned.columns]), F.lit(16))
    assigned.repartition("shard", spread).write.option("maxRecordsPerFile", rows_a_file).partitionBy("shard").parquet(folder)
