"""Quality classifier: a Bradley-Terry ranking learned from preference pairs, cut at a score quantile.

Every pair of a good and a bad labelled text says that the good one is to score higher; the score is linear in the
features of the text, so the logistic loss of a pair depends on the difference of its features alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_batches

#: About so many labelled rows are used to fit; the sample goes by a hash of the id.
LABELLED = 20_000
PAIRS = 100_000
#: Scores from here on mean label 1.
CUT = 0.7

_GROUPS = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\n\r\x0b\x0c", b".?;:", b",", b"!", b"|",
           b"#$%&*@^~+=<>\\_", b"\n", bytes(range(128, 256)), b"\"'()[]{}/-`", bytes(c for c in range(32) if c not in b" \t\n\r\x0b\x0c"))
_TABLES = np.zeros((len(_GROUPS), 256), bool)
for _k, _g in enumerate(_GROUPS):
    _TABLES[_k, list(_g)] = True
N_FEATURES = len(_GROUPS) + 6


def features(texts: list[bytes]) -> np.ndarray:
    """A row of style features for each text: shares of kinds of characters, marks per word, repeats, length."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts], np.int64)
    place = np.concatenate([[0], np.cumsum(size)])
    counts = np.zeros((len(texts), len(_GROUPS)))
    for k, table in enumerate(_TABLES):
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(table[raw], out=total[1:])
        counts[:, k] = total[place[1:]] - total[place[:-1]]
    out = np.zeros((len(texts), N_FEATURES))
    out[:, :len(_GROUPS)] = counts / np.maximum(size, 1)[:, None]
    for i, text in enumerate(texts):
        words = text.split()
        lines = [x for x in text.split(b"\n") if x.strip()]
        n = max(len(words), 1)
        marked = sum(w[-1] in b"!|#$%&*@^~+=<>" for w in words)
        out[i, len(_GROUPS):] = (
            marked / n, len(set(words)) / n, len(set(lines)) / max(len(lines), 1), np.log1p(len(words)), min(size[i] / n, 50.0) / 10, not words)
    return out


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Ranking:
    """A fitted scorer: weights for standardised features and the score at which label 1 begins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3, quantile: float | None = None):
        """``x``: features, ``y``: labels 0 and 1. ``quantile``: the share of rows below the cut; by default that of label 0."""
        self.mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
        self.scale = (x.std(axis=0) if len(x) else np.ones(N_FEATURES)) + 1e-6
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.weights, self.cut, self.only = np.zeros(self.mean.shape), 0.0, None
        if not len(good) or not len(bad):
            self.only = 0.0 if len(bad) else 1.0
            return
        z = (x - self.mean) / self.scale
        random = np.random.default_rng(7)
        difference = z[random.choice(good, pairs)] - z[random.choice(bad, pairs)]
        for _ in range(30):  # Newton steps on the mean logistic loss
            p = 1 / (1 + np.exp(np.clip(difference @ self.weights, -30, 30)))
            gradient = -difference.T @ p / pairs + penalty * self.weights
            hessian = (difference * (p * (1 - p))[:, None]).T @ difference / pairs + penalty * np.eye(len(gradient))
            step = np.linalg.solve(hessian, gradient)
            self.weights -= step * min(1.0, 3.0 / (np.abs(step).max() + 1e-9))
        scores = np.sort(z @ self.weights)
        at = min(max(round((len(bad) / len(y) if quantile is None else quantile) * len(y)), 1), len(y) - 1)
        self.cut = (scores[at - 1] + scores[at]) / 2

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Scores from 0 to 1; ``CUT`` is where the quantile of the training scores lies."""
        if self.only is not None:
            return np.full(len(texts), self.only)
        s = ((features(texts) - self.mean) / self.scale) @ self.weights - self.cut
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", labelled: int = LABELLED) -> Ranking:
    """The ranking learned from labelled rows that are not held out, about ``labelled`` of them.

    Labels other than 0 and 1 and null ids are passed over. If only one label occurs, all texts score 1 (label 1) or 0
    (label 0); without any label they score 1. Rows that repeat an id and its text count once; where an id has so many
    texts that the sample is over twice ``labelled``, a share of all its rows is taken by their hash.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id)).select(F.col(id).alias("_id"), F.col(label).cast("int").alias("_label"))
    usable = usable.distinct()
    n = usable.count()
    part = min(1.0, labelled / max(n, 1))
    sample = usable.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int(part * (1 << 30)) + 1)
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("text")).join(F.broadcast(sample), "_id")  # about `labelled` pairs of numbers
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = rows.groupBy("_id", "_label", digest.alias("_hash")).agg(F.first("text").alias("text"))
    m = rows.count()
    if m > 2 * labelled:
        rows = rows.where(F.pmod(F.xxhash64("_id", "_hash"), F.lit(1 << 30)) < int(labelled / m * (1 << 30)) + 1)

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("_id").cast(pa.int64()), batch.column("_label"), pa.array(list(features(texts)), pa.list_(pa.float64()))],
                                             names=["id", "label", "x"])

    found = rows.select("_id", "_label", "text").mapInArrow(run, "id long, label int, x array<double>").toPandas()
    found = found.sort_values(["id", "label"], kind="stable")  # the fit does not depend on the order of tasks
    x = np.array(found["x"].tolist()).reshape(-1, N_FEATURES)
    order = np.lexsort((*x.T[::-1], found["label"].to_numpy(), found["id"].to_numpy())) if len(x) else []
    return Ranking(x[order], found["label"].to_numpy()[order])


def scored(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, never null) and ``predicted`` (1 from ``CUT`` on). Null texts count as empty.

    Columns of ``docs`` named like one of these are replaced by it. No rows: an empty result.
    """
    docs = docs.drop("score", "predicted")
    names = docs.columns

    def run(batches):
        for batch, texts in text_batches(batches, text):
            s = ranking.score(texts)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(s), pa.array((s >= CUT).astype(np.int32))],
                                             names=[*names, "score", "predicted"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *T._parse_datatype_string("score double, predicted int").fields]))
