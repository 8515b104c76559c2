"""Registered queries: text scores, tags and classes, personal data, vector search."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import privacy as P
from stratalake.functions.draws import draw
from stratalake.operators import text as X
from stratalake.operators.joins import attach
from stratalake.operators.vectors import centroids, cosine_topk as search
from stratalake.plans import columns as C
from stratalake.plans import sql_parts as S
from stratalake.plans.generated import _EMAIL, customer_email
from stratalake.plans.registry import Tables, query

#: Scores of frequent words of the test documents, over their four languages.
LEXICON = {"with": 1, "for": 1, "this": 2, "pour": 1, "mit": 1, "los": 2, "from": -1, "was": -1, "dans": -2,
           "sich": -1, "las": -1, "that": -1, "für": 2, "être": -1, "está": 1}
CATEGORIES = {"article": ["the", "der", "la", "le", "el"], "link": ["and", "und", "et", "y"],
              "place": ["in", "en", "dans", "auf", "von"], "verb": ["is", "was", "ist", "est", "es", "está", "être"]}
RULES = {"contact": r"[A-Za-z0-9]@[A-Za-z0-9]", "license": r"(?i)licen[sc]e", "secret": r"(?i)(token|key|secret|password) *[=:]",
         "shouting": r"[A-Z]{6,}", "table": r" \| "}


@query("lexicon_score", f"""
    SELECT doc_id, score, {S.polarity('score')} AS polarity FROM ({S.document_scores(LEXICON)})""")
def lexicon_score(t: Tables):
    return X.score_text(t.documents, "text", "doc_id", LEXICON)


@query("lexicon_join", f"""
    SELECT doc_id, score, {S.polarity('score')} AS polarity FROM ({S.document_scores(LEXICON)})""")
def lexicon_join(t: Tables):
    lexicon = t.spark.createDataFrame(list(LEXICON.items()), "word string, score bigint")
    return X.score_text(t.documents, "text", "doc_id", lexicon)


@query("tag_documents", "SELECT doc_id, concat_ws(',', " + ", ".join(
    f"CASE WHEN regexp_matches(text, '{RULES[r]}') THEN '{r}' END" for r in sorted(RULES)) + ") AS tags FROM documents")
def tag_documents(t: Tables):
    return t.documents.select("doc_id", F.array_join(X.tag_text("text", RULES), ",").alias("tags"))


_KEYWORDS = "(VALUES " + ", ".join(f"('{w}', '{c}')" for c, ws in CATEGORIES.items() for w in ws) + ") AS kw(w, category)"


@query("classify_text", f"""
    WITH words AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\\p{{L}}]+')) AS w FROM documents),
    hits AS (SELECT doc_id, category, count(*) AS n FROM words JOIN {_KEYWORDS} USING (w) GROUP BY 1, 2),
    best AS (SELECT doc_id, category, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, category) AS r FROM hits)
    SELECT d.doc_id, coalesce(b.category, 'other') AS category FROM documents d
      LEFT JOIN best b ON b.doc_id = d.doc_id AND b.r = 1""")
def classify_text(t: Tables):
    return t.documents.select("doc_id", X.classify_text("text", CATEGORIES, "other").alias("category"))


@query("score_vs_label", f"""
    WITH j AS (SELECT {S.polarity('score')} AS predicted, CASE WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS actual
      FROM ({S.document_scores(LEXICON)}) JOIN labels USING (doc_id))
    SELECT predicted, actual, count(*) AS n,
      (SELECT round(count(*) FILTER (predicted = actual) / count(*), 6) FROM j) AS accuracy FROM j GROUP BY 1, 2""")
def score_vs_label(t: Tables):
    scored = X.score_text(t.documents, "text", "doc_id", LEXICON)
    judged = attach(scored, t.labels.select("doc_id", "quality"), "doc_id")
    actual = F.when(F.col("quality") == 1, "positive").otherwise("negative")
    return X.score_against_truth(judged, F.col("polarity"), actual)


_MASKED_ID = f"regexp_replace(left({S.tax_id('c_custkey')}, 12), '[0-9]', '*', 'g') || right({S.tax_id('c_custkey')}, 2)"


@query("pii_mask", f"""
    SELECT c_custkey, {_MASKED_ID} AS tax_id, regexp_replace({_EMAIL}, '^(.)[^@]*@', '\\1***@') AS email,
      '(**) *****-' || right({S.phone('c_custkey')}, 4) AS phone, sha256('s1' || CAST(c_custkey AS VARCHAR)) AS pseudonym
    FROM customer""")
def pii_mask(t: Tables):
    register = t.customer.select(
        "c_custkey", C.tax_id("c_custkey").alias("tax_id"), customer_email().alias("email"),
        C.phone("c_custkey").alias("phone"), F.col("c_custkey").alias("pseudonym"))
    return P.mask_columns(register, {
        "tax_id": lambda c: P.keep_last_digits(c, 2), "email": P.mask_email,
        "phone": lambda c: P.keep_last_digits(c, 4), "pseudonym": lambda c: P.pseudonym(c, "s1")})


_SPOILED = "CASE WHEN (c_custkey * 3) % 20 = 0 THEN {0}[:-2] ELSE {0} END"
_KINDS = {"tax_id": S.tax_id("c_custkey"), "health_card": S.health_card("c_custkey"),
          "registry_id": S.registry_id("c_custkey"), "email": _EMAIL, "phone": S.phone("c_custkey")}


@query("pii_validate", "WITH v AS (SELECT " + ", ".join(
    _SPOILED.format(f"({sql})") + f" AS {kind}" for kind, sql in _KINDS.items()) + " FROM customer) " + " UNION ALL ".join(
    f"""SELECT '{k}' AS kind, count(*) AS n, count(*) FILTER (regexp_matches({k}, '{P.FORMATS[k]}')) AS n_valid,
      round(count(*) FILTER (regexp_matches({k}, '{P.FORMATS[k]}')) / count(*), 6) AS valid_share FROM v""" for k in _KINDS))
def pii_validate(t: Tables):
    made = {"tax_id": C.tax_id("c_custkey"), "health_card": C.health_card("c_custkey"),
            "registry_id": C.registry_id("c_custkey"), "email": customer_email(), "phone": C.phone("c_custkey")}
    spoil = draw("c_custkey", 3, 20) == 0
    values = F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"),
                 P.is_valid(F.when(spoil, c.substr(F.lit(1), F.length(c) - 1)).otherwise(c), kind).alias("valid"))
        for kind, c in made.items()
    ]))
    return t.customer.select(values).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("valid").alias("n_valid"),
        F.round(F.try_divide(F.count_if("valid"), F.count(F.lit(1))), 6).alias("valid_share"))


@query("pii_scan", "SELECT doc_id, " + ", ".join(
    f"len(regexp_extract_all(text, '{pattern}')) AS {kind}" for kind, pattern in P.IN_TEXT.items()) + " FROM documents")
def pii_scan(t: Tables):
    return t.documents.select("doc_id", *[P.count_in_text("text", kind).alias(kind) for kind in P.IN_TEXT])


_PLANTED = [S.tax_id("doc_id"), S.health_card("doc_id"), S.registry_id("doc_id"), S.phone("doc_id")]


@query("pii_scan_ids", f"""
    WITH planted AS (SELECT doc_id, coalesce(text, '') || CASE doc_id % 5 {' '.join(
        f"WHEN {i} THEN ' id ' || {sql} || ', end'" for i, sql in enumerate(_PLANTED))} ELSE '' END AS text FROM documents)
    SELECT doc_id, """ + ", ".join(
    f"len(regexp_extract_all(text, '{pattern}')) AS {kind}" for kind, pattern in P.IDS_IN_TEXT.items()) + " FROM planted")
def pii_scan_ids(t: Tables):
    """Documents of which four in five end with one of the generated identifiers."""
    planted = F.lit("")
    for i, made in enumerate((C.tax_id, C.health_card, C.registry_id, C.phone)):
        found = F.concat(F.lit(" id "), made("doc_id"), F.lit(", end"))
        planted = F.when(F.col("doc_id") % 5 == i, found).otherwise(planted)
    texts = t.documents.select("doc_id", F.concat(F.coalesce("text", F.lit("")), planted).alias("text"))
    return texts.select("doc_id", *[P.count_in_text("text", kind).alias(kind) for kind in P.IDS_IN_TEXT])


@query("cosine_topk", """
    WITH cells AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
    means AS (SELECT label, i, avg(x) AS x FROM cells GROUP BY 1, 2),
    q AS (SELECT label, list(x ORDER BY i) AS v FROM means GROUP BY 1),
    pairs AS (SELECT q.label, e.vec_id, round(list_cosine_similarity(q.v, e.embedding::DOUBLE[]), 5) + 0.0 AS cosine
      FROM embeddings e CROSS JOIN q),
    ranked AS (SELECT label, vec_id, cosine, row_number() OVER (PARTITION BY label ORDER BY cosine DESC, vec_id) AS rank FROM pairs)
    SELECT label, vec_id, cosine, rank FROM ranked WHERE rank <= 5""")
def cosine_topk(t: Tables):
    return search(centroids(t.embeddings, "label", "embedding"), t.embeddings, "label", "vec_id", "embedding", 5)
