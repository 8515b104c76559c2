"""Periodic runs of words: maximal stretches that repeat with a smallest period, found by constant-time extensions.

How far two places of a text agree (their longest common extension, LCE) is answered from a difference cover: residues
modulo v such that any two places reach sampled ones by one common shift below v. Only suffixes that begin at sampled
places are sorted, as strings of v-word blocks; the common prefix of neighbours in that order goes into a sparse table,
so an LCE compares fewer than v words and then takes one range minimum. A reversed copy answers for the words before.

A run of period p and at least four periods agrees with itself, shifted by p, over three periods or more, so one of the
places 0, 3p, 6p, ... lies inside: over all periods that grid has harmonically few places. Where a grid place agrees
with the place p further on, the two extensions give the whole stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, grams, text_batches

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Difference covers by modulus.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: Texts with more words than this take the sparser cover.
LONG_TEXT = 1 << 21
#: Grid places that are looked at together.
_CHUNK = 1 << 20


class Extensions:
    """Longest common extensions to the right within a sequence of numbers.

    No two places may agree up to the end of the sequence, which holds if each text in it ends in a number of its own.
    """

    def __init__(self, s: np.ndarray, modulus: int = 13):
        self.n, self.v = len(s), modulus
        # beyond the end stand numbers that occur once
        self.s = np.concatenate([s, s.max(initial=0) + 1 + np.arange(2 * modulus)])
        cover = np.array(COVERS[modulus])
        self.shift = self._shifts(cover)
        sampled = np.zeros(modulus, bool)
        sampled[cover] = True
        self.at = np.flatnonzero(sampled[np.arange(self.n + modulus) % modulus])  # at least one sample beyond the end for each residue
        self.number = np.full(self.n + 2 * modulus, -1)
        self.number[self.at] = np.arange(len(self.at))
        self._sort()

    def _shifts(self, cover: np.ndarray) -> np.ndarray:
        """The least shift that brings places with two residues to sampled ones."""
        v = self.v
        out = np.full((v, v), v)
        for a in cover.tolist():
            for shift in range(v):
                i = (a - shift) % v
                for b in cover.tolist():
                    j = (b - shift) % v
                    out[i, j] = min(out[i, j], shift)
        if out.max() >= v:
            raise ValueError("not a difference cover")
        return out

    def _blocks(self) -> np.ndarray:
        """A number for each sampled place, equal exactly where the next v words are."""
        at, v, s = self.at, self.v, self.s
        s = np.concatenate([s, s[-1] + 1 + np.arange(v)])
        key = grams(s.astype(np.uint64), v)[at]
        order = np.argsort(key, kind="stable")
        same = np.flatnonzero(key[order][1:] == key[order][:-1])
        a, b = at[order[same]], at[order[same + 1]]
        if all((s[a + k] == s[b + k]).all() for k in range(v)):
            return np.unique(key, return_inverse=True)[1]
        number = np.zeros(len(at), np.int64)  # different blocks with one hash: word for word
        for k in range(v):
            number = np.unique(number * (int(s.max()) + 1) + s[at + k], return_inverse=True)[1]
        return number

    def _sort(self) -> None:
        m, v = len(self.at), self.v
        rank = self._blocks()  # of a suffix: where the group of those that look equal so far begins
        order = np.argsort(rank, kind="stable")
        rank = _group_starts(rank, order)
        levels, span = [rank], 1
        while True:
            group = rank[order]
            open_ = np.flatnonzero(np.bincount(rank, minlength=m)[group] > 1)
            if not len(open_):
                break
            own = order[open_]
            after = self.at[own] + span * v  # the place from which the suffixes are told apart next
            inside = after < self.n + v
            follow = np.where(inside, rank[self.number[np.where(inside, after, self.at[0])]], m + own)
            again = np.lexsort((follow, rank[own]))
            own, follow = own[again], follow[again]
            order[open_] = own
            old = rank[own]
            new = np.concatenate([[True], (old[1:] != old[:-1]) | (follow[1:] != follow[:-1])])
            rank = rank.copy()
            rank[own] = np.maximum.accumulate(np.where(new, open_, 0))
            levels.append(rank)
            span *= 2
        self.rank = np.empty(m, np.int64)
        self.rank[order] = np.arange(m)
        self.table = _sparse(self._neighbours(order, levels))

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """The words in whole blocks that each sorted suffix shares with the one before it."""
        a, b = self.at[order[:-1]], self.at[order[1:]]
        shared = np.zeros(len(a), np.int64)
        limit = self.n + self.v
        for h in range(len(levels) - 1, -1, -1):
            i, j = a + shared, b + shared
            inside = np.flatnonzero((i < limit) & (j < limit))
            equal = inside[levels[h][self.number[i[inside]]] == levels[h][self.number[j[inside]]]]
            shared[equal] += self.v << h
        return np.concatenate([[0], shared])

    def _few(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from two places on, up to ``most``, by looking."""
        out = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for k in range(int(most.max(initial=0))):
            live = live[most[live] > k]
            live = live[self.s[i[live] + k] == self.s[j[live] + k]]
            if not len(live):
                break
            out[live] = k + 1
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree from places i and j on; i and j differ and lie within the sequence."""
        shift = self.shift[i % self.v, j % self.v]
        out = self._few(i, j, shift)
        far = np.flatnonzero(out == shift)
        i, j = i[far] + shift[far], j[far] + shift[far]
        a, b = self.rank[self.number[i]], self.rank[self.number[j]]
        shared = _minimum(self.table, np.minimum(a, b) + 1, np.maximum(a, b))
        out[far] += shared + self._few(i + shared, j + shared, np.full(len(far), self.v))
        return out


def _group_starts(values: np.ndarray, order: np.ndarray) -> np.ndarray:
    ranked = values[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
    out = np.empty(len(values), np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    return out


def _sparse(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all stretches whose length is a power of two."""
    table, span = [values.astype(np.int32)], 1
    while 2 * span <= len(values):
        last = table[-1]
        table.append(np.minimum(last[:-span], last[span:]))
        span *= 2
    return table


def _minimum(table: list[np.ndarray], low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value from low to high, both included."""
    level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    out = np.empty(len(low), np.int64)
    for k in np.unique(level).tolist():
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[k][low[own]], table[k][high[own] - (1 << k) + 1])
    return out


def _grid(count: np.ndarray, first: np.ndarray):
    """Pieces (place, period) of the grid of all texts: places 0, 3p, 6p, ... that have a place p further on."""
    periods = count // LEAST_PERIODS
    text = np.repeat(np.arange(len(count)), periods)
    period = np.arange(len(text)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    step = (LEAST_PERIODS - 1) * period
    places = (count[text] - period - 1) // step + 1
    total, a = np.cumsum(places), 0
    while a < len(places):
        base = int(total[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(total, base + _CHUNK, side="right")))
        own = np.repeat(np.arange(a, b), places[a:b])
        nth = np.arange(len(own)) - np.repeat(total[a:b] - places[a:b] - base, places[a:b])
        yield first[text[own]] + nth * step[own], period[own]
        a = b


def find_runs(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Runs of a batch of texts, rows (text, start, length, period) ordered by text, start and period.

    ``ids``: numbers of the words, those of text d from ``first[d]`` to ``first[d + 1]``. A run is a stretch of
    consecutive words of one text with smallest period p and at least max(6, 4 p) words that cannot be made longer.
    """
    count = np.diff(first)
    # every text ends in a number of its own, so nothing agrees across texts
    gap = np.arange(len(count))
    moved = first[:-1] + gap
    s = np.empty(len(ids) + len(count), np.int64)
    inner = np.ones(len(s), bool)
    inner[first[1:] + gap] = False
    s[inner] = ids
    s[~inner] = ids.max(initial=0) + 1 + gap
    near = []
    for place, period in _grid(count, moved):
        equal = np.flatnonzero(s[place] == s[place + period])
        place, period = place[equal], period[equal]
        # three or more neighbouring places agree in a run
        beside = (s[place + 1] == s[np.minimum(place + period + 1, len(s) - 1)]) | ((place > 0) & (s[place - 1] == s[place + period - 1]))
        near.append(np.stack([place[beside], period[beside]]))
    place, period = np.concatenate(near, axis=1) if near else np.zeros((2, 0), np.int64)
    if not len(place):
        return np.zeros((0, 4), np.int64)
    # only texts with such places are indexed
    owner = np.searchsorted(moved, place, side="right") - 1
    texts = np.unique(owner)
    size = count[texts] + 1
    begin = np.concatenate([[0], np.cumsum(size)])
    taken = np.repeat(moved[texts] - begin[:-1], size) + np.arange(begin[-1])
    own = np.searchsorted(texts, owner)
    place = place - moved[owner] + begin[own]
    part = np.unique(s[taken], return_inverse=True)[1]
    n = len(part)
    modulus = 57 if n > LONG_TEXT else 13
    right = Extensions(part, modulus).common(place, place + period)
    # reversed, each text must again end in a number of its own: its separator now stands before it, so the next one's follows it
    left = Extensions(part[::-1].copy(), modulus).common(n - 1 - place, n - 1 - place - period)
    start = place - left + 1
    length = left + right - 1 + period
    good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    found = np.stack([own[good], start[good], length[good], period[good]], axis=1)
    found = np.unique(found, axis=0)
    keep = np.concatenate([[True], (found[1:, :3] != found[:-1, :3]).any(axis=1)]) if len(found) else np.zeros(0, bool)
    found = found[keep]  # a stretch has its multiples of the smallest period as periods as well
    found[:, 1] -= begin[found[:, 0]]
    found[:, 0] = texts[found[:, 0]]
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def collapsed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, n_words, ``runs`` (array of start, length, period by start, then period) and ``kept``.

    Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, numbered from 0; null and empty texts have none.
    ``kept`` are the words, joined by a space, that no run holds after its first period. Rows with equal or null ids
    each get a row; other columns are not read. A task holds about a megabyte of texts, or one longer text, and for it
    some hundred bytes a word at most.
    """
    name = id

    def run(batches):
        for batch, texts in text_batches(batches, text):
            w = Words(texts)
            found = find_runs(w.numbered()[0], w.first)
            begin = w.first[found[:, 0]] + found[:, 1]
            change = np.zeros(len(w.start) + 1, np.int64)
            np.add.at(change, begin + found[:, 3], 1)
            np.add.at(change, begin + found[:, 2], -1)
            gone = np.cumsum(change[:-1]) > 0
            bound = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
            kept = _joined(w, gone)
            structs = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], names=["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(name), pa.array(np.diff(w.first).astype(np.int64)), pa.ListArray.from_arrays(pa.array(bound, pa.int32()), structs),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=[name, "n_words", "runs", "kept"])

    schema = "n_words long, runs array<struct<start: long, length: long, period: long>>, kept string"
    return docs.select(id, text).mapInArrow(run, T.StructType([docs.schema[id], *T._parse_datatype_string(schema).fields]))


def _joined(w: Words, gone: np.ndarray) -> list[bytes]:
    """The words of each text that are not gone, joined by one space."""
    size = w.end - w.start + 1
    alive = np.repeat(~gone, size)
    left = w.buffer[alive]
    at = np.concatenate([[0], np.cumsum(np.where(gone, 0, size))])[w.first]
    whole = left.tobytes()
    return [whole[a:max(a, b - 1)] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def longest(runs: str = "runs") -> Column:
    """The run with greatest length in an array of runs; of equals that with the smallest start, then period. Null: no run."""
    key = F.transform(runs, lambda r: F.struct(-r["length"], r["start"], r["period"], r.alias("run")))
    return F.array_min(key)["run"]


def periodic_words(text: Column, id: Column) -> Column:
    """Texts of which a tenth end in a repeated stretch, by a rule on the id; the others as they are, null as empty.

    Let h be crc32 of the id in decimal and g = floor(h / 10). If h is a multiple of 10 and there are n > 0 words, each
    word i from a = g % n on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)); the words are joined
    by a space. A null id changes nothing.
    """
    text = F.coalesce(text, F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    h = F.crc32(id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (bare != ""), changed).otherwise(text)
