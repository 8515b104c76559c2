"""Extraction of listed phrases from texts: what occurs, where, and whether a word before it negates it.

Words are runs of letters and digits of any script in lower case. A phrase list that measures small travels to the
tasks, which find all phrases of a text in one pass of an automaton. A longer list is joined with those of the texts'
word sequences that a bit filter of the list lets through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from stratalake.functions.draws import col
from stratalake.operators.joins import attach, broadcast_limit, measured_bytes
from stratalake.sources.shared import checkpointed

#: Words that negate a phrase which begins within ``REACH`` words behind them.
NEGATIONS = ("no", "not", "without", "never", "kein", "keine", "nicht", "ohne", "sin", "nunca", "sans", "pas", "sem", "não")
REACH = 3
#: Largest measured phrase list of an automaton: each worker holds the list and one, together about ten times that size.
AUTOMATON_BYTES = 4 << 20
#: Most bits of the filter of a longer list.
MOST_BITS = 1 << 28
#: Words that a task turns into arrays, and occurrences that it turns into a batch, at a time.
SLICE_WORDS, SLICE_FOUND = 1 << 18, 1 << 14
_BETWEEN = r"[^\p{L}\p{N}]+"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x94D049BB133111EB)


def text_words(text: Column | str) -> Column:
    """The words of a text; none for a NULL text."""
    words = F.filter(F.split(F.lower(col(text)), _BETWEEN), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def extract_phrases(
    texts: DataFrame, key: str, text: str, phrases: DataFrame, category: str = "category", phrase: str = "phrase", *,
    negations: Sequence[str] = NEGATIONS, reach: int = REACH, broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows (key, category, phrase, begin, end, negated): every occurrence of every phrase, overlapping ones included.

    ``phrase`` is given back as its words joined by a space; words are numbered from 0, ``end`` is past the last.
    ``negated``: one of ``negations`` is among the ``reach`` words before. Phrases without a word match nothing, equal
    ones of a category count once. Rows that repeat a key each report their own.
    """
    listed = phrases.select(F.col(category).alias("category"), F.array_join(text_words(phrase), " ").alias("phrase"))
    listed = checkpointed(listed.where("phrase != '' and category is not null").distinct())  # it is measured, then read
    words = texts.select(F.col(key), text_words(text).alias("words"))
    size = measured_bytes(listed)[0]
    if size <= min(broadcast_limit(texts, broadcast_bytes), AUTOMATON_BYTES):
        found = _by_automaton(words, key, listed, negations, reach)
    else:
        found = _by_join(words, key, listed, size, negations, reach)
    return found.select(key, "category", "phrase", "begin", "end", "negated")


def _by_automaton(words: DataFrame, key: str, listed: DataFrame, said: Sequence[str], reach: int) -> DataFrame:
    """Occurrences by one pass over each text."""
    entries = sorted((r["phrase"], r["category"]) for r in listed.collect())  # measured against the limit
    handle = words.sparkSession.sparkContext.broadcast(entries)
    schema = T.StructType([words.schema[key], *T._parse_datatype_string("category string, phrase string, begin long, end long, negated boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        by_phrase: dict[str, list[str]] = {}
        for phrase, category in handle.value:
            by_phrase.setdefault(phrase, []).append(category)
        for phrase, categories in by_phrase.items():
            automaton.add_word(f" {phrase} ", (phrase, categories))
        if by_phrase:
            automaton.make_automaton()

        def made(batch, rows, out):
            columns = [pa.array([x[c] for x in out], kind) for c, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_()))]
            return pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(rows, pa.int64())), *columns], names=schema.names)

        for batch in batches if by_phrase else ():
            rows, out = [], []
            for i, own in enumerate(batch.column("words")):
                own, number, at = own.as_py(), {}, 0
                for n, w in enumerate(own):  # where each word begins
                    number[at] = n
                    at += len(w) + 1
                for end, (phrase, categories) in automaton.iter(f" {' '.join(own)} "):
                    begin = number[end - len(phrase) - 1]
                    negated = any(w in said for w in own[max(begin - reach, 0):begin])
                    for category in categories:
                        rows.append(i)
                        out.append((category, phrase, begin, begin + phrase.count(" ") + 1, negated))
                if len(out) >= SLICE_FOUND:
                    yield made(batch, rows, out)
                    rows, out = [], []
            yield made(batch, rows, out)

    return words.mapInArrow(run, schema)


def _by_join(words: DataFrame, key: str, listed: DataFrame, size: int, said: Sequence[str], reach: int) -> DataFrame:
    """Occurrences by a join of word sequences with the list; sequences that a bit filter of the list does not know stay out.

    The filter has 16 to 32 bits a phrase, up to ``MOST_BITS``: what it lets through by chance, the join drops.
    """
    counts = {r["n"]: r["count"] for r in listed.groupBy(F.size(F.split("phrase", " ")).alias("n")).count().collect()}  # lengths in words
    width = min(max(sum(counts.values()) * 16, 1 << 10).bit_length(), MOST_BITS.bit_length() - 1)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, flat, starts in _slices(batch.column("words")):
                marks = _sequence_marks(_word_marks(flat))
                for n in np.unique(lengths := np.diff(starts)):
                    hashes = marks(int(n))[starts[:-1][lengths == n]]
                    at = np.concatenate([_place(hashes, width, k) for k in range(len(_MIX))])
                    yield pa.RecordBatch.from_arrays([pa.array((at >> 6).astype(np.int64)), pa.array((np.uint64(1) << (at & 63)).view(np.int64))], names=["at", "bits"])

    told = listed.select(F.split("phrase", " ").alias("words")).mapInArrow(slots, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    known = np.zeros(1 << width - 6, np.uint64)
    known[told.column("at").to_numpy()] = told.column("bits").to_numpy().view(np.uint64)
    handle = words.sparkSession.sparkContext.broadcast(known)
    schema = T.StructType([words.schema[key], *T._parse_datatype_string("phrase string, begin long, end long, negated boolean").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = handle.value
        for batch in batches if counts else ():
            for first, flat, starts in _slices(batch.column("words")):
                marks = _sequence_marks(_word_marks(flat))
                ends = np.repeat(starts[1:], np.diff(starts))
                denied = np.concatenate([[0], np.cumsum(pc.is_in(flat, pa.array(said, pa.string())).to_numpy(zero_copy_only=False))])
                for n in counts:
                    hashes = marks(n)
                    begin = np.flatnonzero(ends[:len(hashes)] - np.arange(len(hashes)) >= n)
                    hashes = hashes[begin]
                    for k in range(len(_MIX)):
                        at = _place(hashes, width, k)
                        held = bits[at >> 6] >> (at & 63) & 1 == 1
                        begin, hashes = begin[held], hashes[held]
                    if not len(begin):
                        continue
                    row = np.searchsorted(starts, begin, "right") - 1
                    own = flat.take(pa.array((begin[:, None] + np.arange(n)).ravel()))
                    phrase = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.arange(0, len(own) + 1, n), pa.int32()), own.cast(pa.string())), " ")
                    place = begin - starts[row]
                    negated = denied[begin] > denied[np.maximum(begin - reach, starts[row])]
                    yield pa.RecordBatch.from_arrays([batch.column(key).take(pa.array(first + row)), phrase, pa.array(place), pa.array(place + n), pa.array(negated)],
                                                     names=[key, "phrase", "begin", "end", "negated"])

    placed = words.mapInArrow(run, schema)
    return attach(placed, listed, "phrase", size=size, derived=True)


def _slices(words: pa.ListArray) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Rows in slices of about ``SLICE_WORDS`` words: number of the first row, all words, where each row begins and the last ends."""
    starts = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64))])
    a = 0
    while a < len(words):
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + SLICE_WORDS, "right")) - 1)
        if starts[b] > starts[a]:
            yield a, words.slice(a, b - a).flatten(), starts[a:b + 1] - starts[a]
        a = b


def _word_marks(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word."""
    coded = pc.dictionary_encode(flat)
    return pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False), categorize=False)[coded.indices.to_numpy()]


def _sequence_marks(marks: np.ndarray) -> Callable[[int], np.ndarray]:
    """Hashes of all sequences of n words, for any n, from sums of the words' hashes by place."""
    powers, inverse = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(marks) - 1, x)])) for x in (_BASE, _INVERSE))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(marks * powers)])
    return lambda n: (sums[n:] - sums[:max(len(sums) - n, 0)]) * inverse[:max(len(sums) - n, 0)]


def _place(hashes: np.ndarray, width: int, k: int) -> np.ndarray:
    """The k-th place of each hash among 2 ** width bits."""
    mixed = (hashes ^ hashes >> np.uint64(32)) * np.uint64(_MIX[k])
    return (mixed ^ mixed >> np.uint64(29)) * np.uint64(_MIX[0]) >> np.uint64(64 - width)
