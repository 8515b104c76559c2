"""Exact removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of a text. Its minimiser is the smallest of the numbers of the word n-grams in
it; consecutive windows with the same minimiser travel as one packed string to that minimiser's bucket, where sorting
brings equal windows together. Equal windows have equal minimisers, so a bucket decides its windows alone.

A minimiser that many super-k-mers share (a passage in a third of all texts, a phrase that is everywhere) would fill
one bucket. Exact counts over all texts find those above a share of all super-k-mers, or above a fixed number; their
windows travel singly, to the bucket of the whole window. Repeats within a batch of texts are judged there and then:
they travel without words and to any bucket, so that a window that many texts share reaches its own bucket once a batch.
Rows of a bucket arrive in the order of id and start, so the first to hold a window is its origin, and a task keeps only
rows that held a window first, however many follow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, grams, mixed, plain_names, release_shuffles, stored, text_batches, trim

WINDOW = 20
#: Words of the n-grams that minimisers are taken from.
GRAM = 3
#: A super-k-mer holds at most so many windows.
RUN = 64
#: A minimiser with more than this share of all super-k-mers is dealt by whole windows; at most 1 / SHARE are.
SHARE = 2e-4
#: Super-k-mers below this number in a batch cannot matter to the share: a batch holds some thousands.
_LOCAL = 3
#: No bucket of fewer super-k-mers is dealt by windows, and every bucket of more than the most is.
FLOOR, MOST = 1000, 1_000_000
#: Rows that a task settles at a time.
_CHUNK = 8_000


class Packing:
    """Compresses packed strings by a dictionary learned from a few texts; what it was learned from affects their size alone."""

    def __init__(self, texts: list[bytes], size: int = 16 << 10, piece: int = 180):
        pieces = [t[i:i + piece] for t in texts for i in range(0, len(t), piece)]
        try:
            self.dictionary = zstandard.train_dictionary(size, pieces).as_bytes()
        except zstandard.ZstdError:  # too little to learn from
            self.dictionary = b""

    def _options(self) -> dict:
        return {"dict_data": zstandard.ZstdCompressionDict(self.dictionary)} if self.dictionary else {}

    def packer(self):
        return zstandard.ZstdCompressor(level=1, write_checksum=False, write_dict_id=False, **self._options()).compress

    def unpacker(self):
        return zstandard.ZstdDecompressor(**self._options()).decompress


def _windows(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First words and minimisers of all windows, and the numbers of all words."""
    hashes = w.hashes()
    count = np.maximum(np.diff(w.first) - window + 1, 0)
    place = np.concatenate([[0], np.cumsum(count)])
    first = np.repeat(w.first[:-1] - place[:-1], count) + np.arange(place[-1])
    if not len(first):
        return first, np.zeros(0, np.uint64), hashes
    low = grams(hashes, gram)
    span, have = window - gram + 1, 1
    while have < span:  # the least of `have` n-grams from each place on
        more = min(have, span - have)
        low = np.minimum(low[:len(low) - more], low[more:])
        have += more
    return first, low[first], hashes


def _runs(first: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each super-k-mer."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.ones(len(first), bool)
    new[1:] = (least[1:] != least[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(new)
    within = np.arange(len(first)) - np.repeat(begin, np.diff(np.append(begin, len(first))))
    begin = np.flatnonzero(within % RUN == 0)
    return begin, np.append(begin[1:], len(first)) - 1


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
                   share: float = SHARE) -> DataFrame:
    """Rows (id, tag, begin, end): runs of words that windows cover whose words also start earlier.

    Earlier means a smaller id, or the same id and an earlier start; a null id comes before all others. ``tag`` is a
    hash of the text, so rows that repeat an id with other words keep spans of their own. Words are numbered from 0,
    ``end`` is past the last. Spans of one text may overlap.
    """
    if not 0 < gram <= window:
        raise ValueError("the n-grams must fit the window")
    source = docs.select(F.col(id).cast("long").alias("id"), F.hash(text).alias("tag"), F.col(text).alias("text"))

    def common(batches):
        for _, texts in text_batches(batches, "text"):
            first, least, _ = _windows(Words(texts), window, gram)
            if len(first):
                begin, _ = _runs(first, least)
                value, n = np.unique(least[begin], return_counts=True)
                often = n >= _LOCAL
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(value[often], 0).view(np.int64)), pa.array(np.append(n[often], 0)),
                     pa.array(np.append(np.zeros(often.sum(), np.int64), len(begin)))], names=["least", "n", "rows"])

    counted = source.select("text").mapInArrow(common, "least long, n long, rows long")
    counted = stored(counted.groupBy("least").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")), "minimisers")
    total = counted.agg(F.sum("rows")).first()[0] or 0
    hot = np.array([r[0] for r in counted.where(F.col("n") > max(min(share * total, MOST), FLOOR)).select("least").collect()], np.int64)
    hot = np.sort(hot.view(np.uint64))  # at most 1 / share numbers, or one for each MOST super-k-mers

    packing = Packing([r[0].encode() for r in source.select(F.substring("text", 1, 8000)).where("text is not null").limit(300).collect()])

    def cut(batches):
        pack = packing.packer()
        for batch, texts in text_batches(batches, "text"):
            yield from _super_kmers(batch, texts, window, gram, hot, pack)

    moved = source.mapInArrow(cut, "key long, id long, place long, words binary")
    dealt = moved.repartition("key").sortWithinPartitions("key", "id", "place")

    def settle(batches):
        yield from _settled(batches, window, packing.unpacker())

    return dealt.mapInArrow(settle, "id long, tag int, begin int, end int").withColumnRenamed("id", id)


def _super_kmers(batch: pa.RecordBatch, texts: list[bytes], window: int, gram: int, hot: np.ndarray, pack):
    """Rows for the buckets; one without words is a window that is known to be repeated. ``place`` holds start and tag."""
    w = Words(texts)
    first, least, hashes = _windows(w, window, gram)
    if not len(first):
        return
    owner = np.searchsorted(w.first, first, side="right") - 1
    ids, tags = _ids(batch.column("id")), batch.column("tag").to_numpy()
    apart = np.isin(least, hot) if len(hot) else np.zeros(len(least), bool)
    cold = np.flatnonzero(~apart)
    begin, last = _runs(first[cold], least[cold])
    begin, last = cold[begin], cold[last]
    keys, firsts, counts, known = least[begin], first[begin], last - begin + 1, np.zeros(len(begin), bool)
    if apart.any():
        at = np.flatnonzero(apart)
        number = grams(hashes, window)[first[at]]
        again = _repeats(w, first[at], number, ids[owner[at]], first[at] - w.first[owner[at]], window)
        one = np.ones(len(at), np.int64)
        keys, firsts = np.concatenate([keys, number]), np.concatenate([firsts, first[at]])
        counts, known = np.concatenate([counts, one]), np.concatenate([known, again])
    owner = np.searchsorted(w.first, firsts, side="right") - 1
    view = w.buffer.tobytes()
    spans = zip(w.start[firsts].tolist(), w.end[firsts + counts + window - 2].tolist(), known.tolist(), strict=True)
    packed = [None if k else pack(view[a:b]) for a, b, k in spans]
    place = (firsts - w.first[owner] << 32) + (tags[owner].astype(np.int64) & 0xFFFFFFFF)
    keys[known] = mixed(place[known].view(np.uint64) ^ mixed(ids[owner[known]].view(np.uint64)))  # judged: any bucket will do
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), batch.column("id").take(pa.array(owner)), pa.array(place), pa.array(packed, pa.binary())],
        names=["key", "id", "place", "words"])


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _repeats(w: Words, first: np.ndarray, number: np.ndarray, ids: np.ndarray, start: np.ndarray, window: int) -> np.ndarray:
    """Which windows have the same words as one with a smaller (id, start) among those given."""
    again = np.zeros(len(first), bool)
    order = np.lexsort((start, ids, number))
    ranked = number[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return again
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).astype(np.int8)))
    view, begin, end = w.buffer.tobytes(), w.start, w.end
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):  # runs of equal numbers; words decide
        seen = {}
        for at in order[a:b + 1].tolist():
            words = view[begin[first[at]]:end[first[at] + window - 1]]
            mine = (ids[at], start[at])
            again[at] = seen.setdefault(words, mine) != mine
    return again


def _settled(batches, window: int, unpack):
    """Spans of repeated windows from rows that come sorted by key, id and place.

    Of a key that goes on beyond a chunk the rows that held a window first are kept to judge those that follow.
    """
    held, size, kept = [], 0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < max(_CHUNK, 2 * kept):
            continue
        rows = pa.Table.from_batches(held)
        spans, first = _chunk_spans(rows, kept, window, unpack)
        yield from spans
        first &= rows.column("key").to_numpy() == rows.column("key")[-1].as_py()
        left = rows.filter(pa.array(first)).combine_chunks()
        held, kept = left.to_batches(), left.num_rows
        size = kept
    if held:
        yield from _chunk_spans(pa.Table.from_batches(held), kept, window, unpack)[0]
    trim()


def _chunk_spans(rows: pa.Table, kept: int, window: int, unpack) -> tuple[list[pa.RecordBatch], np.ndarray]:
    """Spans of the rows but the first ``kept``, and which rows hold a window first."""
    rows = rows.combine_chunks()
    known = rows.column("words").is_null().to_numpy()
    ids, place = _ids(rows.column("id").combine_chunks()), rows.column("place").to_numpy()
    start, tags = place >> 32, (place & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
    fresh = np.flatnonzero(~known)
    parts = [(known.nonzero()[0], start[known], start[known])]  # rows, first and last repeated window
    first_here = np.zeros(rows.num_rows, bool)
    if len(fresh):
        w = Words([unpack(x) for x in rows.column("words").take(pa.array(fresh)).to_pylist()])
        count = np.diff(w.first) - window + 1
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        first, owner = np.repeat(w.first[:-1], count) + within, np.repeat(fresh, count)
        number = grams(w.hashes(), window)[first]
        at = start[owner] + within
        again = _repeats(w, first, number, ids[owner], at, window)
        first_here[owner[~again]] = True
        again &= owner >= kept
        if again.any():
            rank = np.flatnonzero(again)
            row, at = owner[rank], at[rank]
            new = np.ones(len(rank), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            begin = np.flatnonzero(new)
            parts.append((row[begin], at[begin], at[np.append(begin[1:], len(at)) - 1]))
    row, low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
    if not len(row):
        return [], first_here
    out = pa.RecordBatch.from_arrays(
        [rows.column("id").take(pa.array(row)).combine_chunks(), pa.array(tags[row]), pa.array(low.astype(np.int32)),
         pa.array((high + window).astype(np.int32))], names=["id", "tag", "begin", "end"])
    return [out], first_here


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM,
          share: float = SHARE) -> DataFrame:
    """``docs`` with ``kept`` (its remaining words joined by one space), ``n_words`` and ``n_removed``.

    Words are runs of bytes other than 0x20 and 0x09-0x0D, unchanged. A word goes if a window covers it whose words also
    start earlier (see ``repeated_spans``); windows are judged on the input. A null text has no words and an empty
    ``kept``. Rows that repeat an id are judged by (id, start) like others, so a full copy under the same id keeps its
    words; one under another id loses them from its 20th word on backwards, that is all covered words. Other columns
    travel along; those named like a result are replaced by it. No rows: an empty result.
    """
    docs = docs.drop("kept", "n_words", "n_removed")
    names, docs = docs.columns, plain_names(docs)
    found = _removed(docs, f"c{names.index(id)}", f"c{names.index(text)}", window, gram, share)
    return found.toDF(*names, "kept", "n_words", "n_removed")


def _removed(docs: DataFrame, id: str, text: str, window: int, gram: int, share: float) -> DataFrame:
    spans = stored(repeated_spans(docs, id, text, window, gram, share), "spans")
    release_shuffles(docs.sparkSession)  # the super-k-mers take more disk than the texts, which are shuffled next
    spans = spans.groupBy(F.col(id).alias("_id"), F.col("tag").alias("_tag")).agg(
        F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_spans"))  # no more than the text has words
    tagged = docs.withColumn("_hash", F.hash(text))
    joined = tagged.join(spans, F.col(id).cast("long").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_tag")), "left")
    columns = docs.columns
    joined = joined.select(*columns, "_spans")

    def remove(batches):
        for batch, texts in text_batches(batches, text):
            kept, total, removed = [], [], []
            for own, value in zip(batch.column("_spans").to_pylist(), texts, strict=True):
                words = value.split()
                total.append(len(words))
                rest, at = [], 0
                for s in own or ():
                    rest += words[at:s["begin"]]
                    at = max(at, s["end"])
                rest += words[at:]
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
                 pa.array(removed, pa.int64())], names=[*columns, "kept", "n_words", "n_removed"])

    more = T._parse_datatype_string("kept string, n_words long, n_removed long").fields
    return joined.mapInArrow(remove, T.StructType([*docs.schema.fields, *more]))
