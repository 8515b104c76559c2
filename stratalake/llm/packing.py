"""Packing of token pieces into sequences by a configuration linear program.

The histogram of piece lengths (at most one row per length) says everything about the packing. A configuration is a
multiset of lengths that fits one sequence; the program asks for the fewest sequences, in fractions, whose configurations
hold every length as often as it occurs. Multiplicative weights price the lengths: a price falls exponentially with the
length's coverage. A knapsack dynamic program finds the best value of a configuration under these prices and the best
configuration through each length; those near the best value are taken, prices fall, and so on. Prices also bound the
number of sequences from below (their sum over all pieces by the best value), so the search ends when the fractional
solution is close to the best bound. Later phases start from the best prices with smaller steps. The solution is rounded
down to whole copies. For what stays uncovered (much of it where there are thousands of lengths, few pieces each), the
best prices go on: knapsacks over the lengths left give configurations in whole copies, prices falling with the share
that is covered. The last pieces are put in by best fit. The plan - which pieces of a length go to which configuration -
is then looked up by length and running number.
"""

from __future__ import annotations

import bisect
import os
import struct
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.joins import attach

from .common import Words, stored, text_batches

CAPACITY = 4096
END_ID = 1
#: Words whose ids a Python worker remembers, with and without punctuation; beyond that it starts to remember anew.
WORDS_KEPT = 350_000

_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_MARK_CODES = frozenset(_MARKS)
#: Letters below this code point have one form, and the same small letter everywhere.
_LATIN_END = "\u0250"
#: Byte-level models write a byte as a letter: printable ones as they are, the others in order from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of a text by a tokenizer that lower-cases, drops white space and takes no context across it.

    The tokenizer encodes every run of bytes between ASCII white space once; a run's trailing ASCII marks are a token
    group of their own after a letter or digit, so they are encoded apart. Runs of Latin letters go to its model without
    normalising, if the tokenizer treats them as one group. Runs that may hold one of the tokenizer's special strings
    (``<|...``) are encoded as they stand.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model, self.words, self.cores = Tokenizer.from_file(path), {}, {}
        # whether a run of letters is one group, whose bytes the model takes as letters
        encode = lambda x: self.model.encode(x, add_special_tokens=False).ids
        self.runs = all([t.id for t in self.model.model.tokenize(self._letters(x.encode()))] == encode(x) for x in ("word", "éÀß", "ñandú", "Straße"))

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        w = Words([t if b"<|" in t else t.lower() for t in texts])
        number, different = w.numbered()
        different = different.to_pylist()
        fresh = [x for x in different if x not in self.words]
        if len(self.words) + len(fresh) > WORDS_KEPT:
            self.words.clear()
            fresh = different
        if fresh:
            self._learn(fresh)
        found = [self.words[x] for x in different]
        size = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        flat, begin = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size) - size
        many = size[number]
        place = np.cumsum(many) - many
        ids = flat[np.repeat(begin[number] - place, many) + np.arange(int(many.sum()))].tobytes()
        at = (np.append(place, int(many.sum()))[w.first] * 4).tolist()
        return [ids[a:b] for a, b in zip(at, at[1:], strict=False)]

    def _learn(self, fresh: list[bytes]) -> None:
        """Encode words, each followed by a space."""
        words = [x[:-1] for x in fresh]
        marked = {x: self._parts(x) for x in words if x[-1] in _MARK_CODES}  # other words are a part of their own
        new = {p for own in marked.values() for p in own}
        new.update(x for x in words if x not in marked)
        unseen = new.difference(self.cores)
        if len(self.cores) + len(unseen) > WORDS_KEPT:
            self.cores.clear()
            unseen = new
        tokenize, cores, other = self.model.model.tokenize, self.cores, []
        for p in unseen:
            letters = self._letters(p) if self.runs else None
            if letters is None:
                other.append(p)
            else:
                cores[p] = _packed([t.id for t in tokenize(letters)])
        for p, e in zip(other, self.model.encode_batch_fast([p.decode("utf-8", "replace") for p in other], add_special_tokens=False), strict=True):
            cores[p] = _packed(e.ids)
        for x, key in zip(words, fresh, strict=True):
            own = marked.get(x)
            self.words[key] = cores[x] if own is None else b"".join([cores[p] for p in own])

    @staticmethod
    def _letters(word: bytes) -> str | None:
        """A run of Latin letters as the tokenizer's model takes it, a letter for each byte; None for other words."""
        if word.isalpha() and word.islower():
            return word.decode()
        low = word.decode("utf-8", "replace").lower()
        return low.encode().decode("latin-1").translate(_BYTE_LETTERS) if low.isalpha() and max(low) < _LATIN_END else None

    def _parts(self, word: bytes) -> tuple[bytes, ...]:
        core = word.rstrip(_MARKS)
        if len(core) == len(word) or b"<|" in word:
            return (word,)
        if core[-1:].isalnum() or core and self._normal(core)[-1:].isalpha():
            return core, word[len(core):]
        return (word,)

    def _normal(self, word: bytes) -> str:
        """A word as the tokenizer sees it: a letter may become a letter and a mark."""
        text = word.decode("utf-8", "replace")
        return self.model.normalizer.normalize_str(text) if self.model.normalizer else text


_encoders: dict[str, WordIds] = {}  # of this Python worker


def token_pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Rows (id, piece, start, length, ids): the token ids of each text and ``end_id``, cut every ``capacity`` ids.

    ``ids`` holds little-endian unsigned 32-bit numbers. Null and empty texts are the end id alone. Rows with equal
    ids (or a null id) each give their pieces. ``tokenizer``: path of a file for which ``WordIds`` holds.
    """
    path, name = tokenizer or default_tokenizer(), id

    def run(batches):
        if path not in _encoders:
            _encoders[path] = WordIds(path)
        encode, width, end = _encoders[path], 4 * capacity, np.array([end_id], "<u4").tobytes()
        for batch, texts in text_batches(batches, text):
            row, piece, start, ids = [], [], [], []
            for i, own in enumerate(encode(texts)):
                whole = own + end
                for n, at in enumerate(range(0, len(whole), width)):
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    ids.append(whole[at:at + width])
            yield pa.RecordBatch.from_arrays([
                batch.column(name).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[name, "piece", "start", "length", "ids"])

    schema = T.StructType([docs.schema[id], *T._parse_datatype_string("piece int, start long, length long, ids binary").fields])
    return docs.select(id, text).mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece has its place in a sequence of ``capacity`` tokens.

    Needs a column ``length`` (1 to ``capacity``); all others travel along. Offsets in a sequence leave no gap and
    begin at 0. Each task numbers its pieces by length, the numbers are stored, and totals of the tasks before it are
    added, so a length that a third of all pieces share needs no common task; the totals, a row per task and length, are
    broadcast where they measure small and joined in a shuffle beyond. Equal rows are placed one by one. Columns
    named like a result are replaced by it. No rows: an empty result.
    """
    pieces = pieces.drop("sequence_id", "offset")
    names, rest = pieces.columns, [c for c in pieces.columns if c != "length"]
    plain = pieces.select("length", *rest).toDF("length", *[f"c{k}" for k in range(len(rest))])
    placed = _placed(plain, capacity).toDF("length", *rest, "sequence_id", "offset")
    return placed.select(*names, "sequence_id", "offset")


def _placed(pieces: DataFrame, capacity: int) -> DataFrame:

    def number(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            length = batch.column("length").to_numpy()
            if length.min() < 1 or length.max() > capacity:
                raise ValueError(f"lengths must be from 1 to {capacity}")
            nth = _running(length) + seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth)],
                                             names=[*batch.schema.names, "_part", "_nth"])

    extra = T._parse_datatype_string("_part int, _nth long").fields
    numbered = stored(pieces.mapInArrow(number, T.StructType([*pieces.schema.fields, *extra])), "pieces")
    counts = stored(numbered.groupBy("length", "_part").agg(F.count("*").alias("n")), "lengths")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(counts.select("length", "_part", F.coalesce(before, F.lit(0)).alias("_before")), "starts")
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # a row for each length
    key, first, sequence, times, offset = _lookup(plan(histogram, capacity))

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            nth = batch.column("_nth").to_numpy() + batch.column("_before").to_numpy()
            at = np.searchsorted(key, (length << 48) + nth, side="right") - 1
            nth = nth - first[at]
            names = [n for n in batch.schema.names if n not in ("_part", "_nth", "_before")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence[at] + nth // times[at]), pa.array(offset[at] + nth % times[at] * length)],
                names=[*names, "sequence_id", "offset"])

    out = T.StructType([*pieces.schema.fields, *T._parse_datatype_string("sequence_id long, offset long").fields])
    joined = attach(numbered, starts, ["length", "_part"]).select(*numbered.columns, "_before")
    return joined.mapInArrow(place, out)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: (sequence_id, length, ids) from the rows of ``pack(token_pieces(...))``."""
    part = F.struct("offset", "length", "ids")
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))  # at most one sequence of ids a row
    ids = F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    return whole.select("sequence_id", F.aggregate("p", F.lit(0).cast("long"), lambda a, p: a + p["length"]).alias("length"), ids.alias("ids"))


def _running(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    begin = np.maximum.accumulate(np.where(new, np.arange(len(values)), 0))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - begin
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Configurations with their numbers of copies, [(copies, [(length, times), ...]), ...], that use up the histogram."""
    size = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        size[length] = n
    lengths = np.flatnonzero(size)
    if not len(lengths):
        return []
    shares, prices, bound = solve(lengths, size[lengths], capacity)
    options = []
    if shares and sum(shares.values()) <= (1 + _LOOSE) * bound:
        copies, left = {}, size.copy()
        for config, x in sorted(shares.items(), key=lambda c: (-c[1], c[0])):
            _take(config, int(x + 1e-9), copies, left)
        options.append((copies, left))
    options.append(({}, size.copy()))
    plans = [_rounded({}, size, capacity)]  # where every share is below one copy, rounding leaves all pieces to best fit
    for copies, left in options:
        _extract(lengths, prices, size, copies, left, capacity)
        plans.append(_rounded(copies, left, capacity))
    return min(plans[::-1], key=lambda o: sum(n for n, _ in o))


def _take(config: tuple, n: int, copies: dict, left: np.ndarray) -> int:
    """Take up to ``n`` copies of a configuration, as far as its pieces go."""
    n = min([n, *(int(left[j]) // k for j, k in config)])
    if n > 0:
        copies[config] = copies.get(config, 0) + n
        for j, k in config:
            left[j] -= n * k
    return max(n, 0)


def _extract(lengths: np.ndarray, prices: np.ndarray, size: np.ndarray, copies: dict, left: np.ndarray, capacity: int,
             rounds: int = 60, rate: float = 0.1, slack: float = 0.02, step: float = 0.25) -> None:
    """Take whole configurations of the best value from the pieces that are left, until the rest has no more of them.

    ``rate``: how steeply a covered length loses price; ``slack``: how far below the best value a configuration may be;
    ``step``: the share of a length's pieces that one configuration may take in one round.
    """
    for _ in range(rounds):
        some = np.flatnonzero(left[lengths] > 0)
        if not len(some):
            return
        own = lengths[some]
        share = 1 - left[own] / size[own]
        now = prices[some] * np.exp(-rate * share)
        value, item, times = _knapsack(own, now, capacity)
        near = np.flatnonzero(now + value[capacity - own] >= (1 - slack) * value[capacity])
        near = near[np.argsort(share[near], kind="stable")]
        moved = 0
        for config in _configurations(own, *_through(own, near, item, times, capacity), len(near)):
            most = max(1, min(int(step * size[j]) // k for j, k in config))
            moved += _take(config, most, copies, left)
        if not moved:
            return


def _configurations(lengths: np.ndarray, row: np.ndarray, of: np.ndarray, k: np.ndarray, n: int) -> list[tuple]:
    """Configurations ((length, times), ...) from the rows of ``_through``."""
    edges = np.searchsorted(row, np.arange(n + 1)).tolist()
    pairs = list(zip(lengths[of].tolist(), k.tolist(), strict=True))
    return [tuple(pairs[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


#: Step sizes of the phases, the relative gap to the bound at which the search ends, and the most rounds of a phase.
PHASES, GAP, ROUNDS = (0.3, 0.1, 0.03, 0.01), 0.002, 400
#: A fractional solution that is further above the bound is not worth rounding; its prices are used all the same.
_LOOSE = 0.05
#: With more lengths than this they are priced in so many groups; within a group a part of the price goes by length.
_MANY, _BY_LENGTH = 256, 0.02
#: With more lengths than this the knapsack goes room by room instead of length by length.
_DENSE = 500


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY, gap: float = GAP) -> tuple[dict[tuple, float], np.ndarray, float]:
    """A fractional solution {configuration: copies} of the configuration program, the best prices, and a lower bound.

    ``lengths`` are different and ascending; the solution covers all counts. No packing has fewer sequences than the bound.
    With more lengths than ``_MANY`` prices are found for neighbouring lengths together, each at the least of them, which
    keeps the bound valid; there is then no solution to round.
    """
    if len(lengths) > _MANY:
        place = np.cumsum(counts * lengths) - counts * lengths  # groups of equal volume
        group = np.unique((place * _MANY // int((counts * lengths).sum())).astype(np.int64), return_inverse=True)[1]
        least_of = lengths[np.searchsorted(group, np.arange(group.max() + 1))]
        _, prices, bound = solve(least_of, np.bincount(group, weights=counts).astype(np.int64), capacity, gap)
        volume = float((lengths * counts).sum()) / capacity
        if volume >= bound:
            return {}, lengths / capacity, volume
        return {}, (1 - _BY_LENGTH) * prices[group] + _BY_LENGTH * lengths / capacity, bound
    rounds = min(ROUNDS, 6_000 // len(lengths))
    best_prices, bound = lengths / capacity, 0.0
    best: dict[tuple, float] = {}
    least = np.inf
    for step in PHASES:
        prices, cover = best_prices.copy(), np.zeros(len(lengths))
        taken: dict[tuple, float] = {}
        total = 0.0
        for _ in range(rounds):
            value, item, times = _knapsack(lengths, prices, capacity)
            lower = float(prices @ counts) / value[capacity]
            if lower > bound:
                bound, best_prices = lower, prices / prices.max()
            through = prices + value[capacity - lengths]
            near = np.flatnonzero(through >= (1 - step / 2) * value[capacity])
            row, of, k = _through(lengths, near, item, times, capacity)
            used = np.bincount(of, weights=k, minlength=len(lengths))
            amount = np.full(len(near), np.inf)  # configurations share a length's pieces, and one may use up its own
            np.minimum.at(amount, row, counts[of] / used[of])
            gain = np.bincount(of, weights=amount[row] * k, minlength=len(lengths)) / counts
            cover += gain
            prices *= np.exp(-step * gain)
            prices /= prices.max()
            total += float(amount.sum())
            for config, x in zip(_configurations(lengths, row, of, k, len(near)), amount.tolist(), strict=True):
                taken[config] = taken.get(config, 0.0) + x
            if cover.min() > 0 and total / cover.min() < least:
                least = total / cover.min()
                best, scaled = taken.copy(), cover.min()
                best = {c: x / scaled for c, x in best.items()}
                if least <= (1 + gap) * bound:
                    return best, best_prices, bound
    return best, best_prices, bound


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best total price within each room, and an item with its number that a best filling of the room ends in (-1: none)."""
    value, item, times = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int32), np.zeros(capacity + 1, np.int32)
    if len(lengths) > _DENSE:  # room by room: one more piece of any length
        price = np.full(capacity + 1, -np.inf)
        price[capacity - lengths] = prices * (1 + 1e-9 * lengths / capacity)  # by length from the longest on; long pieces win ties
        number = np.full(capacity + 1, -1, np.int32)
        number[lengths] = np.arange(len(lengths))
        for room in range(1, capacity + 1):
            total = price[capacity - room:capacity] + value[:room]
            at = int(total.argmax())
            if total[at] > value[room - 1]:
                value[room], item[room], times[room] = total[at], number[room - at], 1
            else:
                value[room], item[room], times[room] = value[room - 1], item[room - 1], times[room - 1]
        return value, item, times
    for i in range(len(lengths) - 1, -1, -1):  # long pieces first: of equal values the one with fewer pieces stays
        length, price = int(lengths[i]), float(prices[i])
        n = 1
        while n * length <= capacity:  # 1, 2, 4, ... pieces at once: any number of them
            more = value[:capacity + 1 - n * length] + n * price
            rooms = np.flatnonzero(more > value[n * length:] * (1 + 1e-12)) + n * length
            value[rooms], item[rooms], times[rooms] = more[rooms - n * length], i, n
            n *= 2
    return value, item, times


def _through(lengths: np.ndarray, near: np.ndarray, item: np.ndarray, times: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Best configurations through some lengths: rows of (number of the configuration, index of a length, how often)."""
    rooms = capacity - lengths[near]
    parts = [(np.arange(len(near)), near, np.ones(len(near), np.int64))]
    rows = np.flatnonzero(item[rooms] >= 0)
    while len(rows):
        own, n = item[rooms[rows]], times[rooms[rows]]
        parts.append((rows, own, n.astype(np.int64)))
        rooms[rows] -= n * lengths[own]
        rows = rows[item[rooms[rows]] >= 0]
    row, of, k = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
    key, place = np.unique(row * len(lengths) + of, return_inverse=True)
    return key // len(lengths), key % len(lengths), np.bincount(place, weights=k).astype(np.int64)


def _rounded(copies: dict, left: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """The configurations with the uncovered pieces put in by best fit, longest first, in groups of equal sequences."""
    rooms: dict[int, list] = defaultdict(list)
    for config, n in copies.items():
        rooms[capacity - sum(j * k for j, k in config)].append((n, list(config)))
    order = sorted(rooms)
    done = []

    def put(room: int, group: tuple) -> None:
        if room not in rooms or not rooms[room]:
            if room not in rooms:
                bisect.insort(order, room)
        rooms[room].append(group)

    for length in np.flatnonzero(left)[::-1].tolist():
        rest = int(left[length])
        while rest:
            at = bisect.bisect_left(order, length)
            if at == len(order):
                put(capacity, (-(-rest // (capacity // length)), []))
                continue
            room = order[at]
            n, config = rooms[room].pop()
            k = min(room // length, rest)
            filled = min(n, rest // k)
            if not rooms[room]:
                del rooms[room], order[at]
            if n > filled:
                put(room, (n - filled, config))
            put(room - k * length, (filled, [*config, (length, k)]))
            rest -= filled * k
    for groups in rooms.values():
        done += [(n, config) for n, config in groups if config]
    return done


def _lookup(plan: list) -> tuple[np.ndarray, ...]:
    """Sorted keys (length, number of the first piece) with that number, first sequence, times in it and offset."""
    taken, rows, sequence = defaultdict(int), [], 0
    for n, config in plan:
        offset = 0
        for length, k in config:
            rows.append(((length << 48) + taken[length], taken[length], sequence, k, offset))
            taken[length] += n * k
            offset += length * k
        sequence += n
    return tuple(np.array(c, np.int64) for c in zip(*sorted(rows), strict=True)) if rows else tuple(np.zeros(0, np.int64) for _ in range(5))
