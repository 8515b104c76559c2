"""Registered queries: indexed searches, extraction, a learned class, check digits and tests of association."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import checks
from stratalake.functions import privacy as P
from stratalake.functions.bands import band
from stratalake.operators import extract, learned
from stratalake.operators import statistics as ST
from stratalake.operators.joins import attach
from stratalake.operators.text_search import GramIndex
from stratalake.operators.vector_index import VectorIndex
from stratalake.operators.vectors import centroids, cosine_topk
from stratalake.plans import columns as C
from stratalake.plans import fixed as V
from stratalake.plans import reports as R
from stratalake.plans import sql_parts as S
from stratalake.plans.registry import ORACLES, Tables, query
from stratalake.plans.texts import cosine_topk as _  # noqa: F401  (its SQL is used below)
from stratalake.sources.shared import checkpointed, new_folder

#: Share of the true neighbours that a search of the index must find.
RECALL = 0.95


def _index(t: Tables) -> VectorIndex:
    return VectorIndex.build(t.embeddings, "vec_id", "embedding", new_folder(t.spark, "vector-index"))


@query("vector_index_exact", ORACLES["cosine_topk"])
def vector_index_exact(t: Tables):
    """The centre of each label searched in all cells, from the index as it was stored."""
    index = VectorIndex.open(t.spark, _index(t).path)
    return index.search(centroids(t.embeddings, "label", "embedding"), "label", 5, len(index.centres))


@query("vector_index_recall", """
    SELECT count(*) AS n_queries, true AS reached, true AS reads_less FROM embeddings WHERE vec_id % 20 = 0""")
def vector_index_recall(t: Tables):
    """Every twentieth vector against all, in as many cells as a sample of other queries asks for; recall against brute force."""
    index = _index(t)
    queries = t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query"), "embedding")
    others = t.embeddings.where("vec_id % 20 = 10").select(F.col("vec_id").alias("query"), "embedding")
    probes = index.probes_for(others, "query", 5, target=(1 + RECALL) / 2)
    found = index.search(queries, "query", 5, probes).select("query", "vec_id")
    true = cosine_topk(queries, t.embeddings, "query", "vec_id", "embedding", 5).select("query", "vec_id")
    hits = true.join(found, ["query", "vec_id"], "left_semi").agg(F.count("*").alias("n")).scalar()
    wanted = true.agg(F.count("*").alias("n")).scalar()
    cells = t.spark.range(1).select(F.lit(len(index.centres)).alias("cells"))
    n = queries.agg(F.count("*").alias("n")).scalar()
    return cells.select(n.alias("n_queries"), (hits >= RECALL * wanted).alias("reached"), (F.lit(probes) < F.col("cells")).alias("reads_less"))


def _grams_sql(text: str) -> str:
    bare = f"trim(regexp_replace(lower({text}), '\\s+', ' ', 'g'))"
    return f"list_transform(range(1, length({bare}) + 1), lambda i: substr(' ' || {bare} || ' ', i, 3))"


@query("text_search_misspelt", f"""
    WITH entries AS (SELECT p_name AS text, min(p_partkey) AS key, count(*) AS copies FROM part GROUP BY 1),
    total AS (SELECT count(*) AS n FROM entries),
    counts AS (SELECT key, gram, count(*) AS tf FROM (SELECT key, unnest({_grams_sql('text')}) AS gram FROM entries) GROUP BY 1, 2),
    idf AS (SELECT gram, ln((1 + max(total.n)) / (1 + count(*))) + 1 AS idf FROM counts, total GROUP BY 1),
    posts AS (SELECT key, gram, tf * idf AS w FROM counts JOIN idf USING (gram)),
    lengths AS (SELECT key, sqrt(sum(w * w)) AS length FROM posts GROUP BY 1),
    asked AS (SELECT p_partkey AS q, upper(substr(p_name, 1, 2) || substr(p_name, 4)) AS text FROM part WHERE p_partkey % 20 = 0),
    qcounts AS (SELECT q, gram, count(*) AS tf FROM (SELECT q, unnest({_grams_sql('text')}) AS gram FROM asked) GROUP BY 1, 2),
    qw AS (SELECT q, gram, tf * coalesce(idf, ln(1 + n) + 1) AS w FROM qcounts CROSS JOIN total LEFT JOIN idf USING (gram)),
    qlengths AS (SELECT q, sqrt(sum(w * w)) AS length FROM qw GROUP BY 1),
    scored AS (SELECT q, posts.key, round(sum((posts.w / lengths.length) * (qw.w / qlengths.length)), 6) AS score
      FROM qw JOIN posts USING (gram) JOIN lengths ON lengths.key = posts.key JOIN qlengths USING (q) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, key) AS rank FROM scored)
    SELECT q, key, copies, score, rank FROM ranked JOIN entries USING (key) WHERE rank <= 3""")
def text_search_misspelt(t: Tables):
    """Names of every twentieth part, in capitals and without their third letter, against all names."""
    index = GramIndex.build(t.part, "p_partkey", "p_name", new_folder(t.spark, "gram-index"))
    typed = F.upper(F.concat(F.substring("p_name", 1, 2), F.expr("substring(p_name, 4)")))
    asked = t.part.where("p_partkey % 20 = 0").select(F.col("p_partkey").alias("q"), typed.alias("text"))
    return index.search(asked, "q", "text", 3)


_DOC_WORDS = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')"


def _phrases(t: Tables):
    """What texts begin with: their first two and first three words, and single words that end in -tion, by language."""
    words = t.documents.select("lang", extract.text_words("text").alias("w"))
    first = F.get("w", F.lit(0))
    starts = [F.when(F.size("w") >= n, F.array_join(F.slice("w", 1, n), " ")) for n in (2, 3)] + [F.when(first.like("%tion"), first)]
    return words.select(F.col("lang").alias("category"), F.explode(F.array(*starts)).alias("phrase")).where("phrase is not null").distinct()


_EXTRACT_SQL = f"""
    WITH d AS (SELECT doc_id, lang, {_DOC_WORDS} AS w FROM documents WHERE text IS NOT NULL),
    phrases AS (SELECT DISTINCT lang AS category, phrase FROM (
      SELECT lang, array_to_string(w[1:2], ' ') AS phrase FROM d WHERE len(w) >= 2 UNION ALL
      SELECT lang, array_to_string(w[1:3], ' ') FROM d WHERE len(w) >= 3 UNION ALL
      SELECT lang, w[1] FROM d WHERE w[1] LIKE '%tion')),
    words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
    near AS (SELECT doc_id, i, word, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third, list(word) OVER before AS before FROM words
      WINDOW o AS (PARTITION BY doc_id ORDER BY i), before AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {extract.REACH} PRECEDING AND 1 PRECEDING)),
    grams AS (SELECT doc_id, i, before, 1 AS n, word AS phrase FROM near UNION ALL
      SELECT doc_id, i, before, 2, word || ' ' || second FROM near WHERE second IS NOT NULL UNION ALL
      SELECT doc_id, i, before, 3, word || ' ' || second || ' ' || third FROM near WHERE third IS NOT NULL)
    SELECT doc_id, category, phrase, i - 1 AS begin, i - 1 + n AS "end",
      coalesce(list_has_any(before, {S.strings(extract.NEGATIONS)}), false) AS negated
    FROM grams JOIN phrases USING (phrase)"""


@query("extract_phrases", _EXTRACT_SQL)
def extract_phrases(t: Tables):
    return extract.extract_phrases(t.documents, "doc_id", "text", _phrases(t))


@query("extract_phrases_joined", _EXTRACT_SQL)
def extract_phrases_joined(t: Tables):
    """The form for phrase lists beyond the broadcast limit."""
    return extract.extract_phrases(t.documents, "doc_id", "text", _phrases(t), broadcast_bytes=0)


_CLASS = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'clean' ELSE 'junk' END"


@query("learned_class", f"""
    WITH told AS (SELECT doc_id, {_CLASS} AS class, doc_id % 4 = 0 AS held FROM labels),
    words AS (SELECT doc_id, class, held, unnest({_DOC_WORDS}) AS word FROM told JOIN documents USING (doc_id) WHERE text IS NOT NULL),
    counts AS (SELECT word, class, count(*) AS n FROM words WHERE NOT held GROUP BY 1, 2),
    classes AS (SELECT class, count(*) AS docs FROM told JOIN documents USING (doc_id) WHERE NOT held GROUP BY 1),
    vocabulary AS (SELECT DISTINCT word FROM counts),
    totals AS (SELECT class, docs, (SELECT coalesce(sum(n), 0) FROM counts c WHERE c.class = classes.class) + (SELECT count(*) FROM vocabulary) AS total FROM classes),
    weights AS (SELECT word, class, ln((coalesce(n, 0) + 1.0::DOUBLE) / total::DOUBLE) AS w
      FROM vocabulary CROSS JOIN totals LEFT JOIN counts USING (word, class)),
    scored AS (SELECT doc_id, t.class AS predicted, coalesce(s, 0) + ln(docs / (SELECT sum(docs) FROM classes)::DOUBLE) AS score
      FROM (SELECT doc_id FROM told JOIN documents USING (doc_id) WHERE held) CROSS JOIN totals t
      LEFT JOIN (SELECT words.doc_id, weights.class, sum(w) AS s FROM words JOIN weights USING (word) WHERE held GROUP BY 1, 2) x USING (doc_id, class)),
    best AS (SELECT doc_id, predicted FROM scored QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, predicted) = 1)
    SELECT class, count(*) AS n_held, count(*) FILTER (predicted = class) AS n_right, round(count(*) FILTER (predicted = class) / count(*), 6) AS accuracy
    FROM best JOIN told USING (doc_id) GROUP BY 1""")
def learned_class(t: Tables):
    """Junk, clean and toxic texts told apart by their words; learned on three quarters of the labels, judged on the rest."""
    told = t.labels.select("doc_id", F.expr(_CLASS).alias("class"))
    model = learned.fit_classes(t.documents, told.where("doc_id % 4 != 0"), "doc_id", "text", "class")
    held = told.where("doc_id % 4 = 0")
    texts = t.documents.join(held.select("doc_id"), "doc_id", "left_semi")
    judged = held.join(model.classify(texts, "doc_id", "text"), "doc_id")
    right = F.count_if(F.col("predicted") == F.col("class"))
    return judged.groupBy("class").agg(F.count("*").alias("n_held"), right.alias("n_right"), F.round(right / F.count("*"), 6).alias("accuracy"))


_DIGITS = "list_transform(regexp_extract_all({0}, '[0-9]'), lambda x: x::INTEGER)"


def _tax_digit_sql(d: str, n: int) -> str:
    return f"(CASE WHEN 11 - list_sum(list_transform(range(1, {n + 1}), lambda i: {d}[i] * ({n + 2} - i))) % 11 >= 10 THEN 0 ELSE 11 - list_sum(list_transform(range(1, {n + 1}), lambda i: {d}[i] * ({n + 2} - i))) % 11 END)"


@query("pii_check_digits", f"""
    WITH ids AS (SELECT c_custkey AS k, {S.tax_id('c_custkey')} AS made, {S.health_card('c_custkey')} AS card FROM customer),
    nine AS (SELECT k, made, card, {_DIGITS.format('made')}[1:9] AS d FROM ids),
    ten AS (SELECT *, list_append(d, CAST({_tax_digit_sql('d', 9)} AS INTEGER)) AS e FROM nine),
    whole AS (SELECT *, list_append(e, CAST({_tax_digit_sql('e', 10)} AS INTEGER)) AS f FROM ten),
    long AS (SELECT unnest(regexp_extract_all(text, '{P.IN_TEXT['long_numbers']}')) AS v FROM documents WHERE text IS NOT NULL),
    vals AS (SELECT 'tax_id' AS kind, made AS v FROM whole UNION ALL
      SELECT 'tax_id', array_to_string(f[1:3], '') || '.' || array_to_string(f[4:6], '') || '.' || array_to_string(f[7:9], '') || '-' || array_to_string(f[10:11], '') FROM whole WHERE k % 2 = 0
      UNION ALL SELECT 'health_card', card FROM whole UNION ALL SELECT 'long_number', v FROM long),
    digits AS (SELECT kind, v, {_DIGITS.format('v')} AS d FROM vals),
    judged AS (SELECT kind, CASE kind WHEN 'tax_id' THEN regexp_matches(v, '{P.FORMATS['tax_id']}') WHEN 'health_card' THEN regexp_matches(v, '{P.FORMATS['health_card']}')
        ELSE regexp_matches(v, '^[0-9]{{13,19}}$') END AS shape,
      CASE kind WHEN 'tax_id' THEN len(d) = 11 AND len(list_distinct(d)) > 1 AND d[10] = {_tax_digit_sql('d', 9)} AND d[11] = {_tax_digit_sql('d', 10)}
        WHEN 'health_card' THEN len(d) = 15 AND list_sum(list_transform(range(1, 16), lambda i: d[i] * (16 - i))) % 11 = 0
        ELSE list_sum(list_transform(range(1, len(d) + 1), lambda i: CASE WHEN (len(d) - i) % 2 = 0 THEN d[i]
          WHEN d[i] > 4 THEN 2 * d[i] - 9 ELSE 2 * d[i] END)) % 10 = 0 END AS digit FROM digits)
    SELECT kind, count(*) AS n, count(*) FILTER (shape) AS n_shape, count(*) FILTER (digit) AS n_digit FROM judged GROUP BY 1""")
def pii_check_digits(t: Tables):
    """Generated identifiers, half of the tax ids a second time with right check digits, and long numbers in texts."""
    tax, card = C.tax_id("c_custkey"), C.health_card("c_custkey")
    ids = t.customer.select(F.inline(F.array(
        F.struct(F.lit("tax_id").alias("kind"), tax.alias("v")),
        F.struct(F.lit("tax_id").alias("kind"), F.when(F.col("c_custkey") % 2 == 0, checks.with_tax_digits(tax)).alias("v")),
        F.struct(F.lit("health_card").alias("kind"), card.alias("v"))))).where("v is not null")
    numbers = t.documents.select(F.lit("long_number").alias("kind"), F.explode(F.regexp_extract_all("text", F.lit(P.IN_TEXT["long_numbers"]), F.lit(0))).alias("v"))
    kinds = ("tax_id", "health_card", "long_number")
    shapes = {"long_number": F.col("v").rlike("^[0-9]{13,19}$")} | {k: P.is_valid("v", k) for k in kinds[:2]}

    def by_kind(columns):
        out = F
        for k in kinds:
            out = out.when(F.col("kind") == k, columns[k])
        return out

    return ids.unionAll(numbers).groupBy("kind").agg(
        F.count("*").alias("n"), F.count_if(by_kind(shapes)).alias("n_shape"),
        F.count_if(by_kind({k: checks.VALID[k]("v") for k in kinds})).alias("n_digit"))


_RANKS = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2"


@query("rank_correlation", f"""
    WITH r AS (SELECT {_RANKS.format('l_quantity')} AS a, {_RANKS.format('l_extendedprice')} AS b FROM lineitem)
    SELECT count(*) AS n, round(corr(a, b), 6) AS rank_corr FROM r""")
def rank_correlation(t: Tables):
    return ST.rank_correlation(t.lineitem, "l_quantity", "l_extendedprice")


@query("chi_square", """
    WITH cells AS (SELECT o_orderstatus AS r, o_orderpriority AS c, count(*) AS o FROM orders GROUP BY 1, 2),
    grid AS (SELECT r, c, nr, nc, coalesce(o, 0) AS o, (SELECT sum(o) FROM cells)::DOUBLE AS n
      FROM (SELECT r, sum(o)::DOUBLE AS nr FROM cells GROUP BY 1) CROSS JOIN (SELECT c, sum(o)::DOUBLE AS nc FROM cells GROUP BY 1) LEFT JOIN cells USING (r, c)),
    told AS (SELECT sum(pow(o - nr * nc / n, 2) / (nr * nc / n)) AS x, max(n) AS n, count(DISTINCT r) AS a, count(DISTINCT c) AS b FROM grid)
    SELECT CAST(n AS BIGINT) AS n, round(x, 6) AS chi_square, (a - 1) * (b - 1) AS freedom, round(sqrt(x / n / (least(a, b) - 1)), 6) AS cramers_v FROM told""")
def chi_square(t: Tables):
    return ST.chi_square(t.orders, "o_orderstatus", "o_orderpriority")


@query("wait_sentiment_test", f"""WITH {R._VISITS_SQL}, {R._REVIEWS_SQL},
    scored AS (SELECT tempo_espera_minutos AS w, {R._SCORE_SQL} AS score, CASE WHEN tempo_espera_minutos < 20 THEN '< 20' WHEN tempo_espera_minutos <= 30 THEN '20-30'
        ELSE '> 30' END AS band FROM avaliacoes JOIN (SELECT id_consulta, tempo_espera_minutos FROM consultas) USING (id_consulta)),
    said AS (SELECT *, sign(score) AS mood FROM scored),
    ranks AS (SELECT {_RANKS.format('w')} AS a, {_RANKS.format('score')} AS b FROM said),
    cells AS (SELECT band AS r, mood AS c, count(*) AS o FROM said GROUP BY 1, 2),
    grid AS (SELECT nr, nc, coalesce(o, 0) AS o, (SELECT sum(o) FROM cells)::DOUBLE AS n
      FROM (SELECT r, sum(o)::DOUBLE AS nr FROM cells GROUP BY 1) CROSS JOIN (SELECT c, sum(o)::DOUBLE AS nc FROM cells GROUP BY 1) LEFT JOIN cells USING (r, c))
    SELECT (SELECT count(*) FROM ranks) AS n, (SELECT round(corr(a, b), 6) FROM ranks) AS rank_corr,
      round(sum(pow(o - nr * nc / n, 2) / (nr * nc / n)), 4) AS chi_square FROM grid""")
def wait_sentiment_test(t: Tables):
    """Whether the wait and the sentiment of the reviews go together: by ranks, and by bands of the wait."""
    d = R.demo(t)
    scored = R.H.analyse_reviews(d.reviews).select("id_consulta", "pontos", "sentimento")
    said = checkpointed(attach(scored, d.visits.select("id_consulta", "tempo_espera_minutos"), "id_consulta", derived=True))
    ranks = ST.rank_correlation(said, "tempo_espera_minutos", "pontos")
    bands = ST.chi_square(said.withColumn("faixa", band("tempo_espera_minutos", V.WAIT_BANDS)), "faixa", "sentimento", digits=4)
    return ranks.withColumn("chi_square", bands.select("chi_square").scalar())
