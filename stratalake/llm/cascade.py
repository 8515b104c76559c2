"""Quality rules as a short-circuit cascade: rules that reject most for their cost run first, the rest see what is left.

Each rule rejects a text or lets it pass. On a sample every rule is run on every text, which tells its cost in seconds
a text and the share that it rejects; the rules are then ordered by rejected texts per second. A text that one rule
rejects is not shown to the next. A text is kept if no rule rejects it, whatever the order: the sample decides the time
that the cascade takes and never its verdicts.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Sequence
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, Words, text_batches

#: Words of a window whose repeats count.
WINDOW = 8
#: Texts of each partition that costs and selectivities are estimated on.
SAMPLE = 64
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_CAPITALS = np.zeros(256, bool)
_CAPITALS[65:91] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True
_WHITE = b" \t\n\x0b\x0c\r"


class Texts:
    """The base counts of a batch of texts, and what rules ask of some of them. Arrays have a number per text."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.words = texts, Words(texts)
        self.n_words = np.diff(self.words.first)
        self._at = np.append(self.words.start, len(self.words.buffer))[self.words.first]

    def bytes_in_words(self, table: np.ndarray) -> np.ndarray:
        """Bytes in words that a table of 256 flags names."""
        total = np.concatenate([[0], np.cumsum(table[self.words.buffer], dtype=np.int64)])[self._at]
        return np.diff(total)

    @cached_property
    def word_chars(self) -> np.ndarray:
        first = np.ones(256, bool)
        first[128:192] = first[32] = False  # bytes within a character, and the space after each word
        return self.bytes_in_words(first)

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.bytes_in_words(_SYMBOLS)

    @cached_property
    def _lines(self) -> np.ndarray:
        told = [[x for x in t.split(b"\n") if x.strip(_WHITE)] for t in self.texts]
        return np.array([(len(own), len(own) - len(set(own))) for own in told], np.int64).reshape(-1, 2)

    @property
    def n_lines(self) -> np.ndarray:
        """Lines that hold a word."""
        return self._lines[:, 0]

    @property
    def n_dup_lines(self) -> np.ndarray:
        return self._lines[:, 1]

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words in windows of ``WINDOW`` words that the text holds twice or more, the first included.

        Pairs of words are numbered exactly within their text. A window whose pairs do not all repeat cannot repeat, so
        whole windows are compared only where they do.
        """
        first, ids = self.words.first, self.words.numbered()[0]
        long = np.flatnonzero(self.n_words >= WINDOW)
        covered = np.zeros(len(ids) + 1, np.int64)
        if len(long):
            size = self.n_words[long] - 1  # pairs of each text
            owner = np.repeat(np.arange(len(long)), size)
            begin = np.concatenate([[0], np.cumsum(size)])
            at = np.arange(begin[-1]) - begin[owner] + first[long][owner]
            top = int(ids.max()) + 1
            _, pair, times = np.unique((owner * top + ids[at]) * top + ids[at + 1], return_inverse=True, return_counts=True)
            again = times[pair] > 1
            steps = range(0, WINDOW, 2)
            place = np.arange(len(at) - WINDOW + 2)
            ok = begin[owner[place] + 1] - place >= WINDOW - 1  # the window ends within its text
            for k in steps:
                ok &= again[place + k]
            place = place[ok]
            number = np.zeros(len(place), np.int64)
            for k in steps:
                number = np.unique(number * len(times) + pair[place + k], return_inverse=True)[1]
            repeated = at[place[np.bincount(number)[number] > 1]] if len(place) else place
            np.add.at(covered, repeated, 1)
            np.add.at(covered, repeated + WINDOW, -1)
        total = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
        return np.diff(total[first])

    def base_failed(self) -> np.ndarray:
        return (self.n_words < 20) | (100 * self.n_repeat_words > 30 * self.n_words)


class Rule(NamedTuple):
    """``rejects(texts, rows)`` tells for some rows of a batch, given by number, which are rejected."""

    name: str
    rejects: Callable[[Texts, np.ndarray], np.ndarray]


def _each(count: Callable[[bytes], int]) -> Callable[[Texts, np.ndarray], np.ndarray]:
    """A count of each row's text."""
    return lambda t, rows: np.array([count(t.texts[i]) for i in rows.tolist()], np.int64)


def _word_shares(t: Texts, rows: np.ndarray, count: Callable[[list[bytes]], int]) -> np.ndarray:
    return np.array([count(t.texts[i].split()) for i in rows.tolist()], np.int64)


_capitals = _each(lambda text: len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")))
_exclamations = _each(lambda text: text.count(b"!"))
_ellipses = _each(lambda text: sum(x.rstrip(_WHITE).endswith((b"...", "…".encode())) for x in text.split(b"\n")))
_bullets = _each(lambda text: sum(x.lstrip(_WHITE).startswith((b"- ", b"* ", "•".encode())) for x in text.split(b"\n")))
_wordless = re.compile(rb"[^A-Za-z\x80-\xff]+").fullmatch

#: Shares in per cent: symbols, exclamation marks, words without a letter and the most frequent word of all words; A-Z of all
#: characters in words; repeated lines, lines that end in an ellipsis and lines that begin with a bullet of all lines with a
#: word; two to twelve characters a word.
RULES = (
    Rule("symbols", lambda t, r: 100 * t.n_symbols[r] > 10 * t.n_words[r]),
    Rule("word_length", lambda t, r: (t.word_chars[r] < 2 * t.n_words[r]) | (t.word_chars[r] > 12 * t.n_words[r])),
    Rule("repeated_lines", lambda t, r: 100 * t.n_dup_lines[r] > 50 * t.n_lines[r]),
    Rule("capitals", lambda t, r: 100 * _capitals(t, r) > 30 * t.word_chars[r]),
    Rule("exclamations", lambda t, r: 100 * _exclamations(t, r) > 20 * t.n_words[r]),
    Rule("ellipses", lambda t, r: 100 * _ellipses(t, r) > 30 * t.n_lines[r]),
    Rule("bullets", lambda t, r: 100 * _bullets(t, r) > 90 * t.n_lines[r]),
    Rule("no_letters", lambda t, r: 100 * _word_shares(t, r, lambda w: sum(1 for x in w if _wordless(x))) > 40 * t.n_words[r]),
    Rule("common_word", lambda t, r: 100 * _word_shares(t, r, lambda w: max(Counter(w).values(), default=0)) > 30 * t.n_words[r]))


class Estimate(NamedTuple):
    """What the sample says of a rule: texts seen, seconds a text, share rejected."""

    rule: str
    texts: int
    seconds: float
    rejected: float


def estimates(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> list[Estimate]:
    """Cost and selectivity of each rule on the first ``sample`` texts of every partition that pass the base counts.

    A task reads no further than its sample and returns one row per rule; the driver sees one row per rule in all.
    Rules without a sampled text have cost and share 0.
    """

    def run(batches):
        out = {r.name: [0, 0.0, 0] for r in rules}
        left = sample
        for part, texts in text_batches(batches, text):
            own = Texts(texts[:left])
            left -= len(own.texts)
            rows = np.flatnonzero(~own.base_failed())
            own.word_chars, own.n_symbols, own.n_dup_lines  # noqa: B018  (base counts are no rule's cost)
            for rule in rules:
                began = time.perf_counter()
                gone = rule.rejects(own, rows)
                took = time.perf_counter() - began
                told = out[rule.name]
                told[0], told[1], told[2] = told[0] + len(rows), told[1] + took, told[2] + int(gone.sum())
            if not left:
                break
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out)), pa.array([x[0] for x in out.values()], pa.int64()), pa.array([x[1] for x in out.values()], pa.float64()),
             pa.array([x[2] for x in out.values()], pa.int64())], names=["rule", "n", "seconds", "gone"])

    told = docs.select(text).mapInArrow(run, "rule string, n long, seconds double, gone long").groupBy("rule").agg(
        F.sum("n").alias("n"), F.sum("seconds").alias("seconds"), F.sum("gone").alias("gone"))
    found = {r["rule"]: r for r in told.collect()}  # a row per rule
    out = []
    for rule in rules:
        r = found.get(rule.name)
        n = r["n"] if r else 0
        out.append(Estimate(rule.name, n, r["seconds"] / n if n else 0.0, r["gone"] / n if n else 0.0))
    return out


def ordered(rules: Sequence[Rule], found: Sequence[Estimate]) -> list[Rule]:
    """The rules by rejected texts per second, most first; of rules that reject none the cheapest first."""
    told = {e.rule: e for e in found}

    def rank(rule: Rule) -> tuple[float, float]:
        e = told[rule.name]
        return -e.rejected / max(e.seconds, 1e-9), e.seconds

    return sorted(rules, key=rank)


def judged(docs: DataFrame, rules: Sequence[Rule], id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, rejected_by.

    Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of the whole text; null and empty texts have none.
    ``base_failed``: under 20 words, or over 30 % of them in repeated windows. Texts that pass run through ``rules`` in
    the given order until one rejects; ``rejected_by`` names it (null: none, or the base counts). Rows with equal or
    null ids each get a row; other columns are not read. A task holds about a megabyte of texts, or one longer text.
    """
    name = id

    def run(batches):
        for batch, texts in text_batches(batches, text, BATCH_BYTES):
            own = Texts(texts)
            failed = own.base_failed()
            rows, by = np.flatnonzero(~failed), np.full(len(texts), -1)
            for k, rule in enumerate(rules):
                if not len(rows):
                    break
                gone = rule.rejects(own, rows)
                by[rows[gone]] = k
                rows = rows[~gone]
            names = [rules[k].name if k >= 0 else None for k in by.tolist()]
            numbers = (own.n_words, own.word_chars, own.n_symbols, own.n_dup_lines, own.n_repeat_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name), *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(failed), pa.array(~failed & (by < 0)), pa.array(names, pa.string())],
                names=[name, *_COUNTS, "base_failed", "kept", "rejected_by"])

    extra = ", ".join(f"{c} long" for c in _COUNTS) + ", base_failed boolean, kept boolean, rejected_by string"
    return docs.select(id, text).mapInArrow(run, T.StructType([docs.schema[id], *T._parse_datatype_string(extra).fields]))


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``judged`` with the rules in the order that a sample of ``docs`` suggests."""
    return judged(docs, ordered(rules, estimates(docs, text, rules, sample)), id, text)
