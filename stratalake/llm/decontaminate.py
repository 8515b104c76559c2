"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

A training text meets a test item where they share a seed. Every place of an item begins one: its word if that is rare
in the texts, else its word pair if that is rare, else its three words however often they occur. So a seed is as short,
and as hard to edit away, as its rarity allows, and copies that repeat never lose theirs. Around the seeds a window of
the text is aligned with the item; the score counts matching words and charges replaced, missing and added ones, so
edited copies score below exact ones by their edits. Windows that cannot reach the score, by the words and seeds that
they share with the item, are told before the alignment. Texts never move: the test items are the stated query set, sent
to the tasks in blocks of bounded size; one pass over the texts counts a block's n-grams, another joins its seeds and
aligns.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, grams, text_batches

#: Words of the longest seeds.
SEED_WORDS = 3
#: A shorter seed must occur in the texts at most so many times, as a share of the texts and at least.
RARE_SHARE, RARE_LEAST = 2e-5, 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: The least score, as a share of that of an exact copy, at which a passage counts as a copy.
LEAST_SCORE = 0.6
#: Words of test items in a block that is sent to the tasks (some tens of bytes each).
BLOCK_WORDS = 400_000
#: Words that an aligned passage may run beyond the item's length on either side, as a share of that length.
MARGIN = 0.5

_TABLE = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _TABLE[_c] = 32


def normalised(texts: list[bytes]) -> Words:
    """Words without case and ASCII punctuation."""
    return Words([t.lower() if t.isascii() else t.decode("utf-8", "replace").lower().encode() for t in texts], table=_TABLE)


class Items:
    """A block of test items: their words as numbers and their seeds in sorted order."""

    def __init__(self, ids: list, texts: list[bytes], n: int, frequent: dict[int, np.ndarray] | None = None):
        """``frequent``: for each length below ``n`` the n-grams that are no seeds; without it all n-grams are listed, to be counted."""
        w = normalised(texts)
        self.ids, self.hashes, self.first, self.n = ids, w.hashes(), w.first, n
        self.size = np.diff(self.first)
        item = np.repeat(np.arange(len(ids)), self.size)
        place = np.arange(len(item))
        room = self.first[item + 1] - place
        gram = {k: np.append(grams(self.hashes, k), np.zeros(k - 1, np.uint64))[:len(place)] for k in range(1, n + 1)}
        short = self.size[item] < n  # an item shorter than a seed is its own n-gram
        chosen: list[tuple[int, np.ndarray]] = []
        if frequent is None:
            chosen = [(k, np.flatnonzero((room >= k) & ~short)) for k in range(1, n)]
        else:
            left = ~short
            for k in range(1, n + 1):
                fits = left & (room >= k)
                if k < n:
                    fits &= ~np.isin(gram[k], frequent.get(k, np.zeros(0, np.uint64)))
                chosen.append((k, np.flatnonzero(fits)))
                left &= ~fits
        for k in range(1, n):
            chosen.append((k, np.flatnonzero(short & (room == self.size[item]) & (room == k))) if frequent is not None else (k, np.zeros(0, np.int64)))
        self.keys = {}
        for k, at in chosen:
            if len(at):
                self.keys[k] = np.union1d(self.keys.get(k, np.zeros(0, np.uint64)), gram[k][at])
        place = np.concatenate([at for _, at in chosen])
        seed = np.concatenate([gram[k][at] for k, at in chosen])
        order = np.argsort(seed, kind="stable")
        self.seed, self.seed_item = seed[order], item[place[order]]
        self.seed_place = place[order] - self.first[self.seed_item]
        self._sieves, self._words = {}, {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_sieves": {}, "_words": {}}  # tasks make their own: they are larger than all else

    def sieve(self, k: int) -> np.ndarray:
        """Which leading bits the seeds of ``k`` words have."""
        if k not in self._sieves:
            self._sieves[k] = _sieve(self.keys[k])
        return self._sieves[k]

    def bound(self, own: int, passage: np.ndarray, hits: int) -> float:
        """A score that no alignment of an item with a passage exceeds, where they share at most ``hits`` seeds.

        Of m matched words, in runs that an edit parts, all but n - 1 a run begin a shared seed of up to n words.
        """
        if own not in self._words:
            self._words[own] = np.unique(self.hashes[self.first[own]:self.first[own + 1]], return_counts=True)
        words, n = self._words[own]
        at = np.minimum(np.searchsorted(words, passage), len(words) - 1)
        m = int(np.minimum(np.bincount(at[words[at] == passage], minlength=len(words)), n).sum())
        edits = (m - hits) / (self.n - 1) - 1 if 1 < self.n <= self.size[own] else 0
        return MATCH * m + max(edits, 0) * max(MISMATCH, GAP)

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a list of words where a seed begins, and the seeds' numbers."""
        found = []
        for k, keys in self.keys.items():
            g = grams(hashes, k)
            at = np.flatnonzero(self.sieve(k)[(g >> _SIEVE).astype(np.int64)])
            at = at[keys[np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)] == g[at]]
            found.append((at, g[at]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_SIEVE = np.uint64(64 - 22)


def _sieve(keys: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 22, bool)
    out[(keys >> _SIEVE).astype(np.int64)] = True
    return out


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment (Smith-Waterman, linear gaps) of two lists of numbers: score, begin and end in the passage."""
    n = len(passage)
    steps = np.arange(n + 1) * -GAP
    score, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, MISMATCH)
        above = score[1:] + GAP
        new, start = np.zeros(n + 1, np.int64), np.arange(n + 1)
        take = diagonal >= above
        new[1:] = np.maximum(np.where(take, diagonal, above), 0)
        start[1:] = np.where(new[1:] > 0, np.where(take, begin[:-1], begin[1:]), start[1:])
        run = np.maximum.accumulate(new + steps)  # words of the passage that the item lacks
        left = run - steps
        source = np.maximum.accumulate(np.where(new + steps == run, np.arange(n + 1), 0))
        score, begin = left, start[source]
        top = int(score.argmax())
        if score[top] > best[0]:
            best = (int(score[top]), int(begin[top]), top)
    return best


def _passages(items: Items, first: int, at: np.ndarray, number: np.ndarray, size: int):
    """For each item that seeds of a text name: the passages to align, as places in the text's words, and the item's seeds in the text."""
    low, high = np.searchsorted(items.seed, number), np.searchsorted(items.seed, number, side="right")
    count = high - low
    row = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    item, begin = items.seed_item[row], np.repeat(at - first, count) - items.seed_place[row]  # where the item would begin
    order = np.lexsort((begin, item))
    item, begin = item[order], begin[order]
    for k in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
        own, length = int(item[k[0]]), int(items.size[item[k[0]]])
        room = max(int(length * MARGIN), 8)
        for part in np.split(begin[k], np.flatnonzero(np.diff(begin[k]) > room) + 1):
            yield own, max(int(part[0]) - room, 0), min(int(part[-1]) + length + room, size), len(k)


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
                 least: float = LEAST_SCORE, seed_words: int = SEED_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows (id, item, score, begin, end): the best copy of each test item in each text, with its words' places there.

    ``score`` is the alignment's share of an exact copy's, ``least`` or more. Words have no case and no ASCII
    punctuation; words are numbered from 0, ``end`` is past the last. Null and empty texts and items without words
    match nothing. Items with equal words are each reported; rows that repeat an id each report their own. Test items
    are sent to the tasks in blocks of about ``block_words`` words, two passes over the texts for each block, so any number
    of items is judged.
    """
    name = id
    schema = T.StructType([docs.schema[id], benchmark.schema[item], *T._parse_datatype_string("score double, begin long, end long").fields])
    source = docs.select(F.col(id), F.col(text).alias("_text"))
    found, limit = [], max(RARE_LEAST, int(RARE_SHARE * docs.count()))
    for ids, texts in _blocks(benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("text")), block_words):
        items = Items(ids, texts, seed_words, _frequent(source.select("_text"), Items(ids, texts, seed_words), limit))
        if not len(items.seed):
            continue
        found.append(source.mapInArrow(_aligner(items, name, "_text", item, least), schema))
    if not found:
        return docs.sparkSession.createDataFrame([], schema)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _frequent(source: DataFrame, items: Items, limit: int) -> dict[int, np.ndarray]:
    """By length, the listed n-grams that occur over ``limit`` times in the texts; counts are over all texts."""

    def count(batches):
        for _, texts in text_batches(batches, "_text"):
            w = normalised(texts)
            hashes = w.hashes()
            for k, keys in items.keys.items():
                g = grams(hashes, k)
                at = np.flatnonzero(items.sieve(k)[(g >> _SIEVE).astype(np.int64)])
                at = at[keys[np.minimum(np.searchsorted(keys, g[at]), len(keys) - 1)] == g[at]]
                at = at[at + k <= w.first[np.searchsorted(w.first, at, side="right")]]  # within one text
                value, n = np.unique(g[at], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), k, np.int32)), pa.array(value.view(np.int64)), pa.array(n)], names=["k", "gram", "n"])

    if not items.keys:
        return {}
    counted = source.mapInArrow(count, "k int, gram long, n long").groupBy("k", "gram").agg(F.sum("n").alias("n")).where(F.col("n") > limit)
    told: dict[int, list[int]] = {}
    for r in counted.select("k", "gram").collect():  # at most the block's n-grams
        told.setdefault(r["k"], []).append(r["gram"])
    return {k: np.sort(np.array(own, np.int64).view(np.uint64)) for k, own in told.items()}


def _blocks(items: DataFrame, block_words: int):
    """The test items in blocks; rows come to the driver one partition at a time."""
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        text = (row["text"] or "").encode()
        ids.append(row["id"])
        texts.append(text)
        size += len(re.findall(rb"\S+", text))
        if size >= block_words:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _aligner(items: Items, name: str, text: str, item_name: str, least: float):
    def run(batches):
        for batch, texts in text_batches(batches, text):
            w = normalised(texts)
            hashes = w.hashes()
            at, number = items.hits(hashes)
            owner = np.searchsorted(w.first, at, side="right") - 1
            order = np.argsort(owner, kind="stable")
            at, number, owner = at[order], number[order], owner[order]
            inside = at + 1 <= w.first[owner + 1]
            best: dict[tuple[int, int], tuple] = {}
            for k in np.split(np.arange(len(at)), np.flatnonzero(np.diff(owner)) + 1) if len(at) else ():
                doc = int(owner[k[0]])
                first, size = int(w.first[doc]), int(w.first[doc + 1] - w.first[doc])
                for own, a, b, n in _passages(items, first, at[k][inside[k]], number[k][inside[k]], size):
                    words, passage = items.hashes[items.first[own]:items.first[own + 1]], hashes[first + a:first + b]
                    if items.bound(own, passage, n) < least * MATCH * len(words) - 1e-6:
                        continue
                    score, begin, end = align(words, passage)
                    share = score / (MATCH * len(words))
                    if share >= least and share > best.get((doc, own), (0,))[0]:
                        best[doc, own] = (share, a + begin, a + end)
            rows = list(best)
            yield pa.RecordBatch.from_arrays([
                batch.column(name).take(pa.array([d for d, _ in rows], pa.int64())), pa.array([items.ids[i] for _, i in rows], pa.int64()),
                *(pa.array([best[r][c] for r in rows], kind) for c, kind in enumerate((pa.float64(), pa.int64(), pa.int64())))],
                names=[name, item_name, "score", "begin", "end"])

    return run
