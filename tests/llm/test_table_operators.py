"""Embeddings, archives, urls, sharding and the pipeline against brute force and on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from oracle import compare, duck

import __spark_entry__ as registered
import corpus_pipeline
from stratalake.llm import caps, sharding, simhash, urls, warc
from stratalake.sources.shared import new_folder

RNG = random.Random(11)
FOLDER = "/root/testdata/sf0.001"


def test_queries_with_sql(spark):
    con = duck(FOLDER)
    for name in ("op2_embedding_dedup", "op5_substring_dedup", "op6_warc"):
        assert compare(registered.queries()[name](spark, FOLDER), con, registered.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = [q for q in registered.queries() if q.startswith("op")]
    assert [sum(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in registered.queries()


# embeddings

def brute_links(rows):
    ok = {k: np.array(v, float) for k, (i, v, label) in enumerate(rows)
          if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    near = {k: [j for j in ok if j != k and rows[j][2] == rows[k][2] and len(ok[j]) == len(ok[k])
                and ok[j] @ ok[k] / np.linalg.norm(ok[j]) / np.linalg.norm(ok[k]) >= 0.98] for k in ok}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((i, len(near.get(k, [])), least, i == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [8, 768])
def test_embeddings(spark, block):
    random_ = np.random.default_rng(3)
    rows = []
    for label in (0, 1, None):
        for _ in range(25):
            centre = random_.standard_normal(24)
            for _ in range(RNG.choice([1, 2, 12])):
                rows.append(((centre + 0.13 * random_.standard_normal(24)).tolist(), label))
    rows += [(rows[0][0], 0)] * 5 + [([2 * x for x in rows[1][0]], 0), (None, 0), ([], 0), ([0.0] * 24, 0), ([float("nan")] * 24, 0), ([None] + [1.0] * 23, 0),
             ([float("inf")] + [1.0] * 23, 1), ([1.0, 2.0], 0), ([1.0, 2.0], 0), ([3.0], 0), ([5.0], 0), ([-5.0], 0)]
    rows = [(k, np.float32(v).tolist() if v and None not in v else v, label) for k, (v, label) in enumerate(rows)]
    rows += [(3, rows[3][1], rows[3][2]), (None, rows[4][1], rows[4][2])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, n string, rid int")
    got = caps.linked(frame, block=block).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted((tuple(r)[:3] for r in got), key=str) == sorted((r[:3] for r in brute_links(rows)), key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)


def test_no_embeddings(spark):
    assert caps.linked(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_filters_find_nearly_all_pairs():
    random_ = np.random.default_rng(4)
    x = random_.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = random_.standard_normal((4000, 64))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + math.sqrt(1 - 0.98**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    code = caps.ProductCode(64, 1_000_000)
    lists = [[set() for _ in x], [set() for _ in x]]
    for own, v in zip(lists, (x, y), strict=True):
        for r, f in zip(*code.listed(v), strict=True):
            own[r].add(int(f))
    assert np.mean([bool(a & b) for a, b in zip(*lists, strict=True)]) >= 0.999


# archives

def test_archive_round_trip(spark):
    html = ["<p>é</p>" * 5000, "short", None, "", "x" * 999, "x" * 1000, "x" * 1000, "x" * 1000, "a\r\n\r\nb\r\n\r\n" * 4000, "\r\n\r\n", "short", "tail\r\n", "0\r\n\r\n" * 900]
    pages = spark.createDataFrame([(k, f"http://h/{k}\r\nx", h, "p", "d") for k, h in enumerate(html)], "page_id long, url string, html string, payload string, digest string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.plan_records(pages).repartition(3), folder, segment_bytes=700, chunk_bytes=100, records_a_file=7)
    read = warc.read_archive(spark, folder)
    rows = {int(r.row): r for r in read.collect()}
    names = {r.record_id: r for r in rows.values()}
    assert len(rows) == len(names) == len(html)
    assert {r.target for r in read.select(warc.row_named("refers_to").alias("target")).collect()} == {None, "7"}
    for k, h in enumerate(html):
        r = rows[k]
        assert r.type == ("revisit" if k in (5, 6) else "response")
        if r.type == "revisit":
            assert names[r.refers_to] == rows[7] and r.payload is None and r.digest == rows[7].digest
        else:
            assert bytes(r.payload) == (h or "").encode()


def test_repeated_and_null_ids_come_back(spark):
    long, other = "<p>é</p>" * 9000, "<b>x</b>" * 9000
    rows = [(3, long), (3, long), (3, other), (1, long), (1, long), (None, long), (None, long), (None, "s"), (2, other), (2, None), (2, None), (4, "y" * 1000), (None, "y" * 1000)]
    folder = new_folder(spark, "test-pages")
    pages = spark.createDataFrame([(k, "http://h", h) for k, h in rows], "page_id long, url string, html string")
    pages.repartition(4).write.parquet(f"{folder}/pages.parquet")
    got = registered.queries()["op6_warc"](spark, folder)
    assert got.count() == len(rows)
    largest = {h: max(k for k, x in rows if x == h and k is not None) for h in (long, other, "y" * 1000)}
    want = []
    for k, h in rows:
        body = (h or "").encode()
        again = len(body) >= 1000 and k is not None and k < largest[h]
        want.append((k, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", largest[h] if again else None))
    assert sorted(map(tuple, got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == sorted(want, key=str)


def test_ids_of_any_text(spark):
    pages = spark.createDataFrame([("a:b>é %", "u", "x" * 2000), ("a", "u", "x" * 2000)], "page_id string, url string, html string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.plan_records(pages), folder)
    rows = {r.row: r for r in warc.read_archive(spark, folder).withColumn("target", warc.row_named("refers_to")).collect()}
    assert rows["a"].type == "revisit" and rows["a"].target == "a:b>é %" and rows["a"].refers_to == rows["a:b>é %"].record_id


def test_missing_segment_is_an_error(spark):
    pages = spark.createDataFrame([(1, "http://h", "x" * 5000)], "page_id long, url string, html string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.plan_records(pages), folder, segment_bytes=1000)
    segments = warc.read_segments(spark, folder)
    assert segments.count() == 6
    assert warc.reassembled(segments).count() == 1
    for gone in ("segment = 3", "segment = 1", "total is not null"):
        with pytest.raises(Exception, match="segments of a record are missing"):
            warc.reassembled(segments.where(f"not coalesce({gone}, false)")).collect()


def test_empty_archive(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(warc.plan_records(pages), folder)
    assert warc.read_archive(spark, folder).count() == 0


@pytest.mark.parametrize("body", [b"5\r\nabcd\r\n0\r\n\r\n", b"4\r\nabcd\r\n", b"4\r\nabcd\r\n0\r\n", b"zz\r\n"])
def test_wrong_chunks(body):
    with pytest.raises(ValueError):
        warc.unchunked(body)


def test_chunks_with_extension_and_trailer():
    assert warc.unchunked(b"4;x=1\r\nabcd\r\nA\r\n0123456789\r\n0\r\nTrailer: y\r\n\r\n") == b"abcd0123456789"


# urls

URLS = {
    "http://EXAMPLE.com/en/1": ("example.com", "/en/1", "example.com/en/", "block"),
    "http://www.example.com/en/1?x=/en/": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
    "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/", "allow"),
    "http://myexample.com/en/1": ("myexample.com", "/en/1", "com/", "allow"),
    "http://x.com": ("x.com", "", None, "allow"),
    "http://x.com?/": ("x.com", "", None, "allow"),
    "http://s.net/es/1#f": ("s.net", "/es/1", "net/es/", "block"),
    "http://s.net/en/1://other.net/fr/": ("s.net", "/en/1://other.net/fr/", None, "allow"),
    "no scheme": ("", "", None, "allow"),
    "http://ÀB.net/Fr/": ("Àb.net", "/Fr/", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "x\n://q.net\n/fr/": ("q.net\n", "/fr/", None, "allow"),
    "http://freebets.org/a": ("freebets.org", "/a", None, "block"),
}


def test_urls(spark):
    rows = [(k, u, "<p>example words free green bets better story</p><script>casino</script>", "h", "p") for k, u in enumerate(URLS)]
    rows += [(100 + k, f"http://{w}.org/story/{k}", "<b>green words</b>", "h", "p") for k, w in enumerate(["greenwords", "storywords", "example"] * 20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, path string")
    got = {r.page_id: tuple(r)[1:5] for r in urls.judged(pages).collect()}
    assert [got[k] for k in range(len(URLS))] == list(URLS.values())
    assert {got[100 + k][3] for k in range(60)} == {"allow"}
    assert urls.judged(pages.limit(0)).count() == 0


def brute_split(run, cost, unknown):
    best = {0: 0.0}
    for end in range(1, len(run) + 1):
        best[end] = min([best[end - 1] + unknown] + [best[b] + cost[run[b:end]] for b in range(end) if run[b:end] in cost])
    return best[len(run)]


def test_segmentation():
    counts = {"free": 50, "bet": 20, "bets": 30, "the": 200, "re": 90, "f": 2, "bread": 9, "casino": 30}
    s = urls.Segmenter(sum(counts.values()))
    cost = {w: s.total - math.log(n) for w, n in counts.items()}
    assert s.words("freebets", counts) == ["free", "bets"] and s.words("casinobread", counts) == ["casino", "bread"]
    assert s.words("xqzfreexq", counts) == ["xqz", "free", "xq"] and s.words("", counts) == []
    for _ in range(200):
        run = "".join(RNG.choices("freebtsx", k=RNG.randrange(1, 14)))
        words = s.words(run, {w: n for w, n in counts.items() if w in run})
        assert "".join(words) == run
        assert sum(cost.get(w, s.unknown * len(w)) for w in words) == pytest.approx(brute_split(run, cost, s.unknown))


def test_segments_use_every_word(spark, monkeypatch):
    """Words of any length and any count are in the model, those beyond the prefix too."""
    monkeypatch.setattr(urls, "PREFIX", 4)
    counts = {"free": 50, "bets": 30, "freebet": 400, "hapaxlegomenon": 1, "a": 5, "hapax": 3, "xyz": 1}
    model = spark.createDataFrame(list(counts.items()), "word string, n long")
    runs = ["freebets", "hapaxlegomenon", "ahapaxlegomenonfree", "xyz", "freehapaxlegomeno", "q"]
    got = {r.run: r.words for r in urls.segmented(spark.createDataFrame([(r,) for r in runs], "run string"), model, ("casino", "xyz")).collect()}
    counts |= {"casino": 5, "xyz": 5}  # the middle count
    s = urls.Segmenter(sum(counts.values()))
    assert got == {r: s.words(r, {w: n for w, n in counts.items() if w in r}) for r in runs}
    assert got["hapaxlegomenon"] == ["hapaxlegomenon"] and got["ahapaxlegomenonfree"] == ["a", "hapaxlegomenon", "free"]


def test_all_words_of_the_pages_count(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    want = Counter()
    for r in pages.collect():
        text = re.sub(r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ", r.html or "").lower()
        want.update(re.findall("[a-z]+", text))
    assert {r.word: r.n for r in urls.unigrams(pages).collect()} == dict(want)


def test_bayes_by_definition(spark):
    hosts = [("freebets.org", "/a/b"), ("greenstory.org", "/a"), ("greenstory.org", "/a"), ("casino.net", ""), ("storybets.org", "/b"), ("", "")]
    pages = spark.createDataFrame([(k, f"http://{h}{p}" if h else None, "<p>green story green a b org net free</p>") for k, (h, p) in enumerate(hosts)], "page_id long, url string, html string")
    got = {r.page_id: r.log_odds for r in urls.judged(pages).collect()}
    tokens = [["free", "bets", "org", "/a", "/b"], ["green", "story", "org", "/a"], ["green", "story", "org", "/a"], ["casino", "net"], ["story", "bets", "org", "/b"], []]
    bad = [bool({t.strip("/") for t in own} & set(urls.BLOCK_WORDS)) for own in tokens]
    n = Counter(t for own in tokens for t in own)
    of_bad = Counter(t for own, b in zip(tokens, bad, strict=True) if b for t in own)
    total, all_bad, s = sum(n.values()), sum(of_bad.values()), urls.SMOOTHING

    def odds(t):
        share = lambda own, of: math.log((own + s * n[t] / total) / (of + s))
        return share(of_bad[t], all_bad) - share(n[t] - of_bad[t], total - all_bad)

    prior = math.log(sum(bad) + 0.5) - math.log(len(bad) - sum(bad) + 0.5)
    assert got == pytest.approx({k: prior + sum(odds(t) for t in own) for k, own in enumerate(tokens)})


# sharding

def test_lookup_table_is_even_and_moves_little():
    names = [f"s{k}" for k in range(20)]
    table = sharding.lookup_table(names, 5003)
    assert max(Counter(table.tolist()).values()) - min(Counter(table.tolist()).values()) <= 1
    less = sharding.lookup_table(names[:7] + names[8:], 5003)
    renamed = np.array([k if k < 7 else k + 1 for k in less])
    stays = table != 7
    assert (renamed[stays] != table[stays]).mean() < 0.1
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(wrong, 11)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 10)


def test_lookup_table_by_turns():
    """Each turn the next free slot in the shard's own order."""
    import xxhash

    names, slots = ["a", "b", "c"], 101
    order = {}
    for n in names:
        start, step = xxhash.xxh64_intdigest(n, seed=1) % slots, xxhash.xxh64_intdigest(n, seed=2) % (slots - 1) + 1
        order[n] = [(start + j * step) % slots for j in range(slots)]
    owner = {}
    while len(owner) < slots:
        for k, n in enumerate(names):
            free = [s for s in order[n] if s not in owner]
            if free:
                owner[free[0]] = k
    assert sharding.lookup_table(names, slots).tolist() == [owner[s] for s in range(slots)]


def test_assign_and_write(spark):
    rows = spark.createDataFrame([(None, "x"), (1, "x"), (1, "x"), *((k, "y") for k in range(500))], "doc_id long, key string")
    names = ["a", "b", "c"]
    out = sharding.assign(rows, ["doc_id"], names, 101).collect()
    assert len(out) == 503 and len({r.shard for r in out if r.doc_id == 1}) == 1
    table = sharding.lookup_table(names, 101)
    assert all(r.shard == names[table[r.slot]] for r in out)
    clash = sharding.assign(rows.withColumnRenamed("key", "slot"), ["doc_id", "slot"], names, 101)
    assert clash.columns == ["doc_id", "slot", "shard"] and clash.count() == 503 and clash.where("slot < 0 or slot > 100").count() == 0
    folder = new_folder(spark, "test-shards")
    sharding.write_shards(sharding.assign(rows, ["doc_id"], names, 101), folder)
    assert spark.read.parquet(folder).groupBy("shard").count().collect() and spark.read.parquet(folder).count() == 503


# pipeline

def one_of_each(docs):
    """The smallest id of each component of documents whose fingerprints differ in at most four bits."""
    ids = sorted(docs)
    fp = dict(zip(ids, simhash.simhash([(docs[k].text or "").encode() for k in ids]).tolist(), strict=True))
    out, seen = set(), set()
    for k in ids:
        if k not in seen:
            out.add(k)
            todo = [k]
            seen.add(k)
            while todo:
                a = todo.pop()
                for b in ids:
                    if b not in seen and (fp[a] ^ fp[b]).bit_count() <= 4:
                        seen.add(b)
                        todo.append(b)
    return out


def test_pipeline_stages(spark):
    words = [f"w{i}" for i in range(500)]
    text = lambda n: " ".join(RNG.choices(words, k=n)).capitalize() + "."
    texts = [text(80) for _ in range(120)]
    junk = [" ".join(x.upper() + "!!" for x in t.split()) for t in texts[:40]]
    item, passage = text(30), text(40)
    special = [texts[0], texts[1] + " Extra", f"{text(50)} {passage} {text(50)}", f"{text(50)} {passage} {text(50)}", f"{text(60)} {item} {text(60)}", None, None, text(5000)]
    clashing = ("score", "predicted", "kept", "n_words", "n_removed", "_hash", "_gone", "fp", "length", "id")
    rows = [(k, t, "en", "s", len(t or ""), *[f"{c} {k}" for c in clashing]) for k, t in enumerate(texts + junk + special)]
    folder = new_folder(spark, "test-corpus")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clashing))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k < 120)) for k in range(160)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    read, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, read, folder)
        if name != "packing":
            assert out.columns == docs.columns
            path = new_folder(spark, "test-stage")
            out.write.parquet(path)
            read = spark.read.parquet(path)
            kept.append({r.doc_id: r for r in read.collect()})
            assert all(r[c] == f"{c} {k}" for k, r in kept[-1].items() for c in clashing)
    good, single, cut, clean = kept
    assert set(range(120)) <= set(good) and not set(range(120, 160)) & set(good)
    assert 160 not in single and set(single) == one_of_each(good)
    first, second = cut[162].text, cut[163].text
    assert first == special[2] and passage not in second and cut[163].n_chars == len(second)
    assert 164 in cut and 164 not in clean and {162, 163, 167} <= set(clean)
    assert {r.doc_id for r in out.collect()} == set(clean)
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(whole.select("doc_id", "piece", "length", "ids_crc32").collect()) == sorted(out.select("doc_id", "piece", "length", "ids_crc32").collect())


def test_pipeline_on_empty_tables(spark):
    folder = new_folder(spark, "test-corpus")
    for name, schema in (("documents", "doc_id long, text string, lang string, source string, n_chars long"), ("labels", "doc_id long, quality int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
