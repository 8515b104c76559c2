"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.joins import attach
from stratalake.sources.shared import new_folder

from . import caps, cascade, decontaminate, interactions, licenses, packing, quality, runs, sharding, simhash, substrings, urls, warc
from .common import small_batches, stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``f(spark, folder) -> DataFrame``."""

    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_simhash_dedup")
def op1_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(_table(spark, folder, "documents"))


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document's tokens, with a checksum of its ids."""
    pieces = packing.token_pieces(_table(spark, folder, "documents"))
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


@query("op5_substring_dedup", r"""
    with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
    words as (select doc_id, unnest(w) word, generate_subscripts(w, 1) i from texts),
    windows as (select doc_id, i, word, count(*) over f n, string_agg(word, ' ') over f s from words
                window f as (partition by doc_id order by i rows between current row and 19 following)),
    judged as (select doc_id, i, word, n = 20 and row_number() over (partition by n = 20, s order by doc_id, i) > 1 again from windows),
    marked as (select doc_id, i, word, bool_or(again) over (partition by doc_id order by i rows between 19 preceding and current row) gone from judged),
    kept as (select doc_id, string_agg(word, ' ' order by i) filter (not gone) k, count(*) filter (gone) n from marked group by doc_id)
    select doc_id, cast(len(w) as bigint) n_words, coalesce(n, 0) n_removed, sha256(coalesce(k, '')) kept_sha256
    from texts left join kept using (doc_id)""")
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document and how many of them repeat an earlier passage, with a digest of the rest."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return substrings.dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_warc", r"""
    with p as (select page_id, encode(coalesce(html, '')) b from pages),
    d as (select page_id, octet_length(b) n, sha1(b) s from p),
    r as (select *, case when n >= 1000 then max(page_id) over (partition by s, n) else page_id end last from d)
    select page_id, cast(n as bigint) payload_bytes, s payload_digest,
           case when page_id < last then 'revisit' else 'response' end record_type, case when page_id < last then last end refers_to
    from r""")
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to WARC archives and read back from them."""
    archive = new_folder(spark, "warc")
    warc.write_archive(warc.plan_records(_table(spark, folder, "pages")), archive)
    read = warc.read_archive(spark, archive)
    read = read.select(
        F.col("row").cast("long").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.expr("substring(digest, 6)").alias("payload_digest"), F.col("type").alias("record_type"), warc.row_named("refers_to").cast("long").alias("refers_to"))
    read = stored(read, "records")
    # a revisit's payload is that of the response it refers to
    whole = read.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = attach(read.where("record_type = 'revisit'").drop("payload_bytes"), stored(whole, "lengths"), ["refers_to", "payload_digest"], "left")
    return read.where("record_type = 'response'").unionByName(again).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on the url of every page."""
    return urls.judged(_table(spark, folder, "pages"))


@query("op10_quality_ranking")
def op10_quality_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    ranking = quality.fit(docs, _table(spark, folder, "labels"))
    return quality.scored(docs, ranking).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of benchmark items in the documents."""
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query("op2_embedding_dedup", r"""
    with recursive v as (select vec_id, label, cast(embedding as double[]) e from embeddings
        where label is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
          and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    p as (select a.vec_id u, b.vec_id w from v a join v b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
          where list_cosine_similarity(a.e, b.e) >= 0.98),
    r as (select vec_id u, vec_id c from embeddings union select p.w, r.c from r join p on p.u = r.u),
    c as (select u vec_id, min(c) component_id from r group by u),
    n as (select u vec_id, count(*) n from p group by u)
    select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id kept from c left join n using (vec_id)""")
def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates of every vector."""
    return caps.linked(_table(spark, folder, "embeddings"))


@query("op3_sharding")
def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Slot and shard of every document among 64 shards."""
    docs = _table(spark, folder, "documents").select("doc_id")
    return sharding.assign(docs, ["doc_id"], [f"shard-{k:03d}" for k in range(64)])


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence passages of every document."""
    return licenses.scan(_table(spark, folder, "documents"))


@query("op11_filter_interactions", r"""
    with w as (select doc_id, coalesce(lang, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
    first as (select t, min(doc_id) id from w group by t),
    says as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels group by doc_id),
    fails as (select part, coalesce(good, 0) good, coalesce(toxic, 0) toxic,
        (case when len(w) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
        + (case when 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) then 4 else 0 end)
        + (case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end) + (case when doc_id > first.id then 16 else 0 end) mask
        from w join first using (t) left join says using (doc_id)),
    cells as (select part, mask, count(*) n, sum(good) good, sum(toxic) toxic from fails group by part, mask),
    f(letter, bit) as (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
    orders as (select a.letter || b.letter || c.letter || d.letter || e.letter filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] bits
        from f a, f b, f c, f d, f e where (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
    steps as (select filter_order, step, bits[step] bit, cast(coalesce(list_sum(bits[1:step - 1]), 0) as int) before
        from orders, range(1, 6) s(step)),
    told as (select part, filter_order, step, bit,
        sum(n) filter (mask & (before | bit) = 0) kept, sum(n) filter (mask & before = 0 and mask & bit <> 0) removed,
        sum(n) filter (mask & before <> 0 and mask & bit <> 0) redundant, sum(n) filter (mask = bit) unique_fails,
        sum(good) filter (mask & before = 0 and mask & bit <> 0) good_lost, sum(toxic) filter (mask & before = 0 and mask & bit <> 0) toxic_lost
        from cells cross join steps group by part, filter_order, step, bit)
    select part, filter_order, cast(step as int) step, cast(coalesce(kept, 0) as bigint) kept, cast(coalesce(removed, 0) as bigint) removed,
        cast(coalesce(redundant, 0) as bigint) redundant, cast(coalesce(unique_fails, 0) as bigint) unique_fails,
        cast(coalesce(good_lost, 0) as bigint) good_lost, cast(coalesce(toxic_lost, 0) as bigint) toxic_lost,
        cast(coalesce(sum(removed) over (partition by part, bit), 0) as bigint) shapley from told""")
def op11_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    """What each step of every order of five document filters removes, by language."""
    return interactions.audit_documents(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@query("op12_quality_rules", r"""
    with d as (select doc_id, coalesce(text, '') t from documents),
    w as (select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') w,
          list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from d),
    words as (select doc_id, unnest(w) word, generate_subscripts(w, 1) i from w),
    windows as (select doc_id, i, count(*) over f n, string_agg(word, ' ') over f s from words
                window f as (partition by doc_id order by i rows between current row and 7 following)),
    again as (select doc_id, i, n = 8 and count(*) over (partition by doc_id, n = 8, s) > 1 again from windows),
    marked as (select doc_id, bool_or(again) over (partition by doc_id order by i rows between 7 preceding and current row) m from again),
    repeats as (select doc_id, count(*) filter (m) n_repeat_words from marked group by doc_id),
    base as (select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) word_chars,
          cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
          cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines, coalesce(n_repeat_words, 0) n_repeat_words, len(l) n_lines,
          length(regexp_replace(t, '[^A-Z]', '', 'g')) capitals, length(regexp_replace(t, '[^!]', '', 'g')) marks,
          len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) ellipses,
          len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*(- |\* |•)'))) bullets,
          len(list_filter(w, lambda x: not regexp_matches(x, '[A-Za-z\x{80}-\x{10ffff}]'))) bare,
          coalesce(list_max(map_values(list_histogram(w))), 0) most from w left join repeats using (doc_id)),
    judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words base_failed from base)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not (base_failed or 100 * n_symbols > 10 * n_words or word_chars < 2 * n_words or word_chars > 12 * n_words
             or 100 * n_dup_lines > 50 * n_lines or 100 * capitals > 30 * word_chars or 100 * marks > 20 * n_words or 100 * ellipses > 30 * n_lines
             or 100 * bullets > 90 * n_lines or 100 * bare > 40 * n_words or 100 * most > 30 * n_words) kept
    from judged""")
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether the cascade keeps it."""
    return cascade.cascade(_table(spark, folder, "documents")).drop("rejected_by")


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which are given one, with digests of all runs and of the collapsed words."""
    docs = _table(spark, folder, "documents")
    docs = docs.select("doc_id", runs.periodic_words(F.col("text"), F.col("doc_id")).alias("text"))
    found = runs.collapsed(docs).withColumn("top", runs.longest())
    told = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
