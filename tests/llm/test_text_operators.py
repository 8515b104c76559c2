"""Substring dedup, packing, decontamination, licences and quality against brute force and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import decontaminate, licenses, packing, quality, substrings
from stratalake.llm.common import Words, grams

RNG = random.Random(5)
VOCABULARY = [f"word{i}" for i in range(400)]
DOCS = "doc_id long, text string, key string, words string, n long"


def prose(n):
    return " ".join(RNG.choices(VOCABULARY, k=n))


def frame(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "k", "w", 1) for i, t in zip(ids or range(len(texts)), texts, strict=True)], DOCS)


# substring dedup

def brute_dedup(rows, window):
    """rows: (id, text), one for each id. Words, removed words and kept text."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            own = tuple(words[k:k + window])
            if own in seen:
                gone[k:k + window] = [True] * window
            seen.add(own)
        out[i] = (len(words), sum(gone), b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode())
    return out


@pytest.fixture(scope="module")
def repeats():
    shared = prose(60)
    texts = [f"{prose(RNG.randrange(40))} {shared}\n\t{prose(RNG.randrange(40))}" for _ in range(40)]
    texts += [texts[3], texts[3] + " tail", None, "", " \n ", "a " * 500, prose(19), prose(20), "é\x85x " * 30, shared[:-1], prose(3000)]
    return texts + [texts[-1][:9000], "a " * 400]


@pytest.mark.parametrize("hot", [False, True])
def test_substring_dedup(spark, repeats, hot, monkeypatch):
    if hot:  # every minimiser that occurs three times in a batch is dealt by windows
        monkeypatch.setattr(substrings, "FLOOR", 2)
    out = substrings.dedup(frame(spark, repeats), share=0.0 if hot else substrings.SHARE).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in out}
    assert got == brute_dedup(list(enumerate(repeats)), 20)
    assert out[0].key == "k" and out[0].words == "w"


def test_substring_dedup_short_windows_and_null_id(spark, repeats):
    ids = [None, *range(1, len(repeats))]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup(frame(spark, repeats, ids), window=5, gram=2).collect()}
    assert got == brute_dedup(list(zip(ids, repeats, strict=True)), 5)


def test_rows_that_repeat_an_id_keep_their_words(spark):
    text, other = prose(30), prose(30)
    got = sorted((r.doc_id, r.n_removed, r.kept) for r in substrings.dedup(frame(spark, [text, text, other, text], [1, 1, 1, 2])).collect())
    assert got == sorted([(1, 0, text), (1, 0, text), (1, 0, other), (2, 30, "")])


def test_words_have_equal_numbers_whatever_their_place(monkeypatch):
    texts = [b"aa bb cc", b"bb", b"", b"cc  aa\x0bbb", b"x" * 3000 + b" aa"]
    numbers = lambda: (lambda w: dict(zip([bytes(w.buffer[a:b]) for a, b in zip(w.start, w.end, strict=True)], w.hashes().tolist(), strict=True)))(Words(texts))
    assert len(set(numbers().values())) == 4
    w = Words(texts)
    assert w.hashes()[[0, 1, 2]].tolist() == w.hashes()[[5, 3, 4]].tolist()
    monkeypatch.setattr("stratalake.llm.common.BATCH_BYTES", 5)
    assert w.hashes()[[0, 1, 2]].tolist() == w.hashes()[[5, 3, 4]].tolist()
    assert grams(w.hashes()[:2], 3).tolist() == []


@pytest.mark.parametrize("chunk", [1, 3, 50])
def test_keys_that_go_on_beyond_a_chunk(monkeypatch, repeats, chunk):
    """Spans do not depend on where chunks of a bucket are cut; every minimiser is dealt by windows and by super-k-mers."""
    texts = [(t or "").encode() for t in repeats]
    batch = pa.RecordBatch.from_arrays([pa.array(list(range(len(texts)))), pa.array([0] * len(texts), pa.int32())], names=["id", "tag"])
    w = Words(texts)
    _, least, _ = substrings._windows(w, 20, 3)
    packing_ = substrings.Packing([])
    for hot in (np.zeros(0, np.uint64), np.unique(least)):
        parts = []
        for i in range(len(texts)):  # every text a batch, so nothing is judged before the buckets
            parts += substrings._super_kmers(batch.slice(i, 1), texts[i:i + 1], 20, 3, hot, packing_.packer())
        rows = pa.Table.from_batches(parts).sort_by([("key", "ascending"), ("id", "ascending"), ("place", "ascending")]).combine_chunks()
        spans = []
        for size in (10**9, chunk):
            monkeypatch.setattr(substrings, "_CHUNK", size)
            found = [tuple(x.values()) for b in substrings._settled(iter(rows.to_batches(max_chunksize=7)), 20, packing_.unpacker()) for x in b.to_pylist()]
            covered = {(i, k) for i, _, a, b in found for k in range(a, b)}
            spans.append(covered)
        assert spans[0] == spans[1] and spans[0]


def test_judged_rows_go_to_any_bucket():
    shared = prose(20).encode()
    texts = [shared] * 300
    batch = pa.RecordBatch.from_arrays([pa.array(list(range(300))), pa.array([0] * 300, pa.int32())], names=["id", "tag"])
    _, least, _ = substrings._windows(Words(texts), 20, 3)
    rows = pa.Table.from_batches(list(substrings._super_kmers(batch, texts, 20, 3, np.unique(least), substrings.Packing([]).packer())))
    assert rows.num_rows == 300 and rows.column("words").null_count == 299
    assert max(Counter(rows.column("key").to_pylist()).values()) == 1


# packing

def test_packing(spark):
    from tokenizers import Tokenizer

    texts = [prose(RNG.choice([1, 5, 300, 900])) for _ in range(60)] + [None, "", "A <|endoftext|> b!! É— it's &&", prose(9000), "x" * 60_000, "same", "same"]
    docs = frame(spark, texts)
    pieces = packing.token_pieces(docs)
    model = Tokenizer.from_file(packing.default_tokenizer())
    whole = {i: model.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    joined = {}
    for r in pieces.orderBy("doc_id", "piece").collect():
        own = joined.setdefault(r.doc_id, [])
        assert r.start == len(own) and r.length == len(r.ids) // 4 <= 4096
        own += np.frombuffer(r.ids, "<u4").tolist()
    assert joined == whole
    packed = packing.pack(pieces).select("doc_id", "piece", "length", "ids", F.crc32("ids").alias("c"), "sequence_id", "offset")
    rows = packed.collect()
    assert len(rows) == pieces.count() and all(r.c == zlib.crc32(r.ids) for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length, bytes(r.ids)))
    for parts in by.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    sizes = np.bincount([r.length for r in rows], minlength=4097)
    assert len(by) <= sum(n for n, _ in packing._rounded({}, sizes, 4096)) + 1  # plain best fit
    for r in packing.sequences(packed).collect():
        parts = sorted(by[r.sequence_id])
        assert bytes(r.ids) == b"".join(p[2] for p in parts) and r.length == len(r.ids) // 4


def lognormal(n, top=4096):
    random_ = np.random.default_rng(n)
    lengths, counts = np.unique(np.minimum(random_.lognormal(6, 1, n).astype(int) + 1, top), return_counts=True)
    return dict(zip(lengths.tolist(), counts.tolist(), strict=True))


HISTOGRAMS = [
    {}, {4096: 3}, {1: 100_000}, {2049: 7, 2048: 2}, {1366: 3000, 1365: 10}, {k: 5 for k in range(1, 4097)}, {2730: 10**9, 1366: 10**9},
    {2100: 10_000, 1024: 10_000}, {2300: 8000, 900: 16_000}, {1500: 1000, 1300: 1000, 1100: 777}, {2048: 5, 1024: 3}, {k: 200 for k in range(1100, 3500, 3)}, lognormal(30_000)]


@pytest.mark.parametrize("histogram", HISTOGRAMS)
def test_plan_uses_every_piece_once_and_is_near_the_bound(histogram):
    plan = packing.plan(histogram)
    used = Counter()
    for n, config in plan:
        assert n > 0 and sum(j * k for j, k in config) <= 4096
        for j, k in config:
            used[j] += n * k
    assert used == Counter(histogram)
    if histogram:
        lengths = np.array(sorted(histogram))
        _, prices, bound = packing.solve(lengths, np.array([histogram[j] for j in lengths.tolist()]))
        assert sum(n for n, _ in plan) <= bound * 1.01 + 1
        assert bound >= sum(j * n for j, n in histogram.items()) / 4096 * (1 - 1e-9)


def test_bound_and_solution_of_the_program():
    """The bound holds for every packing, and fractions cover every count."""
    for histogram, optimum in (({2100: 100, 1024: 100}, 100), ({2300: 80, 900: 160}, 100), ({1366: 30}, 15), ({3000: 7}, 7)):
        lengths = np.array(sorted(histogram))
        shares, prices, bound = packing.solve(lengths, np.array([histogram[j] for j in lengths.tolist()]))
        covered = Counter()
        for config, x in shares.items():
            assert sum(j * k for j, k in config) <= 4096
            for j, k in config:
                covered[j] += x * k
        assert all(covered[j] >= n - 1e-6 for j, n in histogram.items())
        assert bound <= optimum + 1e-6 and sum(shares.values()) <= bound * 1.01


@pytest.mark.parametrize("many", [3, 1000])
def test_knapsack_by_brute_force(monkeypatch, many):
    monkeypatch.setattr(packing, "_DENSE", many)
    random_ = np.random.default_rng(many)
    for _ in range(40):
        lengths = np.sort(random_.choice(np.arange(1, 30), random_.integers(1, 9), replace=False))
        prices, capacity = random_.random(len(lengths)), 40
        value, item, times = packing._knapsack(lengths, prices, capacity)
        want = [0.0]
        for room in range(1, capacity + 1):
            want.append(max([want[room - 1]] + [want[room - j] + p for j, p in zip(lengths.tolist(), prices.tolist(), strict=True) if j <= room]))
        assert value == pytest.approx(want, rel=1e-6)
        near = np.arange(len(lengths))
        row, of, k = packing._through(lengths, near, item, times, capacity)
        for config, j in zip(packing._configurations(lengths, row, of, k, len(near)), near, strict=True):
            assert int(lengths[j]) in dict(config) and sum(a * b for a, b in config) <= capacity
            got = sum(prices[lengths.tolist().index(a)] * b for a, b in config)
            assert got == pytest.approx(prices[j] + want[capacity - int(lengths[j])], rel=1e-6)


def test_ids_where_a_letter_becomes_a_letter_and_a_mark():
    from tokenizers import Tokenizer

    model, ids = Tokenizer.from_file(packing.default_tokenizer()), packing.WordIds(packing.default_tokenizer())
    letters = ["\u0130", "i\u0307", "\u01c4", "\ufb01", "\u212b", "a", "É", "1", ".", "!", "'", "-", " ", "ß", "\u0301", "²", "中"]
    texts = ["\u0130.", "x\u0130..", *["".join(RNG.choices(letters, k=RNG.randrange(1, 8))) for _ in range(3000)]]
    for text, own in zip(texts, ids([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(own, "<u4").tolist() == model.encode(text, add_special_tokens=False).ids, text


def test_packing_keeps_columns_with_its_own_names(spark):
    pieces = spark.createDataFrame([(5, 9, "a", 1), (7, 9, "b", 2)], "length long, offset int, _part string, _nth int")
    with pytest.raises(Exception):  # noqa: B017
        packing.pack(pieces.withColumn("length", F.lit(0).cast("long"))).collect()
    out = packing.pack(pieces)
    assert sorted(out.columns) == ["_nth", "_part", "length", "offset", "sequence_id"]
    assert sorted((r.length, r.offset, r._part, r._nth) for r in out.collect()) in ([(5, 0, "a", 1), (7, 5, "b", 2)], [(5, 7, "a", 1), (7, 0, "b", 2)])


def test_packing_of_an_empty_table_and_wrong_lengths(spark):
    assert packing.pack(packing.token_pieces(frame(spark, []))).count() == 0
    with pytest.raises(Exception, match="lengths must be"):
        packing.pack(spark.createDataFrame([(4097,)], "length long")).count()


# decontamination

def brute_align(a, b):
    best = 0
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b, 1):
            new.append(max(0, row[j - 1] + (2 if x == y else -1), row[j] - 1, new[j - 1] - 1))
        best, row = max(best, *new), new
    return best


def test_alignment():
    for _ in range(200):
        a, b = np.array(RNG.choices(range(6), k=RNG.randrange(1, 12))), np.array(RNG.choices(range(6), k=RNG.randrange(1, 20)))
        score, begin, end = decontaminate.align(a, b)
        assert score == brute_align(a, b)
        assert score == 0 or brute_align(a, b[begin:end]) == score


@pytest.mark.parametrize("block_words", [30, 10_000])
def test_decontamination(spark, block_words):
    items = [prose(30), prose(25), prose(40), "Alpha, beta", "", None, "... !!"]
    edited = items[1].split()
    for k in (4, 11, 17, 21):
        edited[k] = "changed"
    dropped = items[2].split()
    del dropped[10:13]
    texts = [f"{prose(50)}. {items[0].upper()}! {prose(9)}", " ".join(edited), f"{prose(5)} {' '.join(dropped)}", prose(200), items[0][:40], None, "",
             "has ALPHA beta inside", items[0], items[0], prose(30_000) + " " + items[2]]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, texts), benchmark, block_words=block_words)
    rows = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert set(rows) == {(0, 0), (1, 1), (2, 2), (7, 3), (8, 0), (9, 0), (10, 2)}
    assert (rows[0, 0].score, rows[0, 0].begin, rows[0, 0].end) == (1.0, 50, 80)
    assert rows[1, 1].score == pytest.approx((2 * 21 - 4) / 50) and rows[2, 2].score == pytest.approx((2 * 37 - 3) / 80)
    assert (rows[10, 2].begin, rows[10, 2].end) == (30_000, 30_040)


def test_decontamination_of_copies_everywhere(spark):
    item = prose(30)
    texts = [f"{prose(20)} {item} {prose(20)}" for _ in range(300)]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = decontaminate.contaminated(frame(spark, texts), benchmark)
    assert got.where("score = 1").count() == 300
    assert decontaminate.contaminated(frame(spark, []), benchmark).count() == 0
    assert decontaminate.contaminated(frame(spark, texts), benchmark.limit(0)).count() == 0


def test_decontamination_of_repeated_edited_and_partial_copies(spark):
    items = [prose(40), prose(40), prose(30), prose(20)]
    edited, scattered = items[0].split(), items[2].split()
    edited[17] = "changed"
    for k in range(3, 30, 5):
        scattered[k] = "changed"
    copies = [" ".join(edited), " ".join(items[1].split()[:28]), " ".join(scattered), " ".join(items[1].split()[:20])]
    texts = [f"{prose(8)} {copies[k % 4]} {prose(8)}" for k in range(800)] + [f"{prose(8)} {t}" for t in items[:3]] + [prose(60) for _ in range(40)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(frame(spark, texts), benchmark).collect()}
    wanted = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            if len(set(t.split()) & set(item.split())) >= 0.5 * len(set(item.split())):
                score = brute_align(item.split(), t.split()) / (2 * len(item.split()))
                if score >= decontaminate.LEAST_SCORE:
                    wanted[d, i] = score
    assert len(wanted) == 603 and got == pytest.approx(wanted)


def _inserted(words):
    return [x for k, w in enumerate(words) for x in ([w, f"added{k}"] if k % 2 else [w])]


def _replaced(words):
    return [f"other{k}" if k % 5 == 2 else w for k, w in enumerate(words)]


def _dropped(words):
    return [w for k, w in enumerate(words) if k % 6 != 3]


@pytest.mark.parametrize("edit", [_inserted, _replaced, _dropped, lambda w: w[:int(0.65 * len(w))], lambda w: w])
def test_recall_of_edited_copies(spark, edit):
    """Copies with a word added after every second one, a fifth replaced, a sixth dropped, or cut, in many documents each."""
    rng = random.Random(9)
    items = [prose(rng.randrange(24, 60)) for _ in range(20)]
    texts = [f"{prose(30)} {' '.join(edit(items[k % 20].split()))} {prose(30)}" for k in range(400)] + [prose(80) for _ in range(100)]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(frame(spark, texts), benchmark).collect()}
    wanted = set()
    for d, t in enumerate(texts[:400]):
        own = items[d % 20].split()
        if brute_align(own, t.split()) >= 0.6 * 2 * len(own):
            wanted.add((d, d % 20))
    assert len(wanted) >= 300 and len(wanted & got) >= 0.99 * len(wanted)


def test_rare_words_and_pairs_are_seeds():
    items = decontaminate.Items([0, 1], [b"aa bb cc dd", b"aa bb"], 3, {})
    assert sorted(items.keys) == [1, 2] and len(items.keys[1]) == 4 and len(items.seed) == 5
    h = decontaminate.normalised([b"aa bb cc dd"]).hashes()
    common = {1: np.sort(grams(h, 1)[[0, 1]]), 2: np.sort(grams(h, 2)[[0]])}
    items = decontaminate.Items([0], [b"aa bb cc dd"], 3, common)
    assert {k: len(v) for k, v in items.keys.items()} == {1: 2, 2: 1, 3: 1}


# licences

def brute_dice(text, template):
    def bigrams(t):
        words = [w for w in "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in t).split()]
        return Counter(zip(words, words[1:], strict=False))

    a, b = bigrams(text), bigrams(template)
    return 2 * (a & b).total() / (a.total() + b.total())


def plain_words(text):
    return "".join(c.lower() if c.isalnum() or ord(c) > 127 else " " for c in text or "").split()


def brute_passages(text, templates, least):
    """By looking at every passage: the best from each place for each template, then the best ones that do not overlap."""
    words, found = plain_words(text), []
    for t, (name, template) in enumerate([(n, x) for n, own in templates.items() for x in own]):
        b = Counter(zip(plain_words(template), plain_words(template)[1:], strict=False))
        for i in range(len(words)):
            best = (0.0, 0)
            for j in range(i + 2, len(words) + 1):
                a = Counter(zip(words[i:j], words[i + 1:j], strict=False))
                dice = 2 * (a & b).total() / (a.total() + b.total())
                if dice > best[0] + 1e-12:
                    best = (dice, j)
            if best[0] >= least and (words[i], words[i + 1]) in b:
                found.append((-best[0], i, -best[1], t, name))
    out, taken = [], []
    for dice, i, j, _, name in sorted(found):
        j = -j
        if all(j <= x or i >= y for x, y in taken):
            taken.append((i, j))
            out.append((name, pytest.approx(-dice), i, j))
    return out


def test_licence_passages_by_brute_force(spark):
    templates = {"one": ("aa bb cc dd ee ff", "aa bb aa bb gg hh"), "two": ("cc dd ee gg hh aa bb",)}
    texts = [" ".join(RNG.choices(["aa", "bb", "cc", "dd", "ee", "ff", "gg", "hh", "zz", "aa bb", "cc dd ee"], k=RNG.randrange(0, 16))) for _ in range(60)]
    texts += ["aa bb cc dd ee ff. AA bb, cc dd ee ff", "zz aa bb cc dd zz ee ff", None, ""]
    got = {}
    for r in licenses.scan(frame(spark, texts), templates=templates, least=0.7).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.dice, r.begin, r.end))
    for d, text in enumerate(texts):
        want = brute_passages(text, templates, 0.7)
        assert sorted(got.get(d, []), key=lambda x: x[2]) == sorted(want, key=lambda x: x[2])
    assert len(got) > 10


def test_licence_scan(spark):
    mit = licenses.TEMPLATES["MIT"][1]
    words = mit.split()
    wrapped = "\n".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9))
    changed = wrapped.replace("Software", "Program", 3)
    bsd = licenses.TEMPLATES["BSD-2-Clause"][0]
    texts = [f"{prose(40)}\n{wrapped}\n{prose(30)}", changed, "Licensed under CC BY-NC 4.0.", "licensed under the apache license version 2.0", prose(500), None, "",
             "Licensed to you\nby nobody", "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\n" + prose(9),
             f"{prose(250)} {mit} {prose(250)}", f"{prose(100)} Licensed under the Apache License, Version 2.0. {prose(100)}", f"{prose(60)} {bsd}", prose(30_000) + " " + mit]
    got = {}
    for r in licenses.scan(frame(spark, texts)).collect():
        got.setdefault(r.doc_id, []).append((r.license, r.dice, r.begin, r.end))
    assert {d: sorted(x[0] for x in v) for d, v in got.items()} == {
        0: ["MIT"], 1: ["MIT"], 2: ["CC-BY-NC-4.0"], 3: ["Apache-2.0"], 8: ["CC-BY-NC-4.0", "MIT"], 9: ["MIT"], 10: ["Apache-2.0"], 11: ["BSD-2-Clause"], 12: ["MIT"]}
    n = len(plain_words(mit))
    assert got[0][0][1:] == (1.0, 40, 40 + n) and got[9][0][1:] == (1.0, 250, 250 + n) and got[12][0][1:] == (1.0, 30_000, 30_000 + n)
    assert got[1][0][1] >= brute_dice(changed, mit) - 1e-9
    assert licenses.scan(frame(spark, [])).count() == 0
    own = {"mine": ("one two three four five six seven",)}
    assert [r.license for r in licenses.scan(frame(spark, ["x one two three four five six seven y", mit]), templates=own).collect()] == ["mine"]
    with pytest.raises(ValueError):
        licenses.scan(frame(spark, []), least=0.4)


# quality

def test_quality_ranking(spark):
    good = [prose(RNG.randrange(5, 200)).capitalize() + "." for _ in range(300)]
    bad = [" ".join(w.upper() + "!!" for w in prose(RNG.randrange(5, 200)).split()) for _ in range(100)]
    texts = good + bad + [None, "", "x" * 100_000]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(400)] + [(5, 1, 0), (None, 1, 0), (6, None, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    out = quality.scored(docs, quality.fit(docs, labels)).withColumn("held", quality.held_out())
    rows = out.collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held and r.doc_id < 400]
    assert sum(r.predicted == int(r.doc_id < 300) for r in held) >= 0.97 * len(held)
    again = {r.doc_id: r.score for r in quality.scored(docs.repartition(5), quality.fit(docs.repartition(3), labels)).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in rows})


def test_quality_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    sizes, kept = [], quality.Ranking.__init__
    monkeypatch.setattr(quality.Ranking, "__init__", lambda self, x, y: (sizes.append(len(x)), kept(self, x, y))[1])
    texts = [prose(9) if i % 2 else prose(9).upper() for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    once = quality.fit(frame(spark, texts), labels)
    again = quality.fit(frame(spark, texts + [texts[1]] * 500, [*range(40), *[1] * 500]), labels)
    assert sizes[0] == sizes[1] <= 40 and again.weights == pytest.approx(once.weights)
    quality.fit(frame(spark, texts + [f"{texts[1]} {k}" for k in range(500)], [*range(40), *[1] * 500]), labels, labelled=100)
    assert sizes[2] <= 200


def test_ranking_by_definition():
    """The weights are where the mean logistic loss of pairs, with its penalty, has no slope; the cut is the quantile of label 0."""
    random_ = np.random.default_rng(1)
    y = (np.arange(400) % 4 > 0).astype(int)
    x = random_.standard_normal((400, quality.N_FEATURES)) + y[:, None] * random_.standard_normal(quality.N_FEATURES) * 0.4
    r = quality.Ranking(x, y, pairs=5000)
    z = (x - r.mean) / r.scale
    again = np.random.default_rng(7)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    difference = z[again.choice(good, 5000)] - z[again.choice(bad, 5000)]
    loss = lambda w: np.mean(np.log1p(np.exp(-difference @ w))) + 1e-3 / 2 * w @ w
    for k in range(quality.N_FEATURES):
        step = np.zeros(quality.N_FEATURES)
        step[k] = 1e-3
        assert abs(loss(r.weights + step) - loss(r.weights - step)) / 2e-3 < 1e-4
    assert (z @ r.weights < r.cut).sum() == (y == 0).sum()


def test_features_by_definition():
    text = "Ab, c! 12 | ## x_y\nab é\nab é"
    raw = text.encode()
    out = quality.features([raw, b""])
    shares = [sum(c in g for c in raw) / len(raw) for g in quality._GROUPS]
    words = raw.split()
    assert out[0, :len(shares)] == pytest.approx(shares)
    assert out[0, len(shares):] == pytest.approx([sum(w[-1] in b"!|#$%&*@^~+=<>" for w in words) / len(words), len(set(words)) / len(words), 2 / 3,
                                                  np.log1p(len(words)), len(raw) / len(words) / 10, 0])
    assert out[1].tolist() == [0.0] * len(shares) + [0, 0, 0, 0, 0, 1]


@pytest.mark.parametrize(("values", "score"), [([], 1.0), ([1, 1], 1.0), ([0, 0], 0.0)])
def test_quality_without_two_classes(spark, values, score):
    docs = frame(spark, ["a b", "c d", None])
    labels = spark.createDataFrame([(i, v) for i, v in zip((0, 1), values, strict=False)], "doc_id long, quality int")
    assert {r.score for r in quality.scored(docs, quality.fit(docs, labels)).collect()} == {score}
    assert quality.scored(docs.limit(0), quality.fit(docs.limit(0), labels)).count() == 0


def test_digest_of_kept_words(spark):
    row = substrings.dedup(frame(spark, ["a  b\nc"])).select(F.sha2("kept", 256)).first()
    assert row[0] == hashlib.sha256(b"a b c").hexdigest()
