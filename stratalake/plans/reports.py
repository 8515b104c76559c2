"""Registered queries: the health demo's datasets and reports, built from the keys of the test tables.

Customers become patients, suppliers with nation and region hospitals, part brands per type diagnosis codes,
orders consultations. Consultations and reviews land as CSV files and are read back, as in the demo.
"""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

from pyspark.sql import DataFrame, functions as F

from stratalake.functions.draws import draw, pick
from stratalake.operators.joins import attach
from stratalake.operators.quality import orphan_audit
from stratalake.plans import fixed as V
from stratalake.plans import health as H
from stratalake.plans import sql_parts as S
from stratalake.plans.flagship import gold_by_site
from stratalake.plans.generated import _EMAIL
from stratalake.plans.kpis import sites
from stratalake.plans.quality import GAPS_SQL
from stratalake.plans.registry import Tables, query
from stratalake.plans.sql_parts import AS_OF
from stratalake.sources.lake import Lake
from stratalake.sources.landing import sink_landing
from stratalake.sources.shared import checkpointed, new_folder

_KINDS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def hospitals(t: Tables) -> DataFrame:
    return sites(t).select(
        F.col("s_suppkey").alias("id_hospital"), F.col("s_name").alias("nome_hospital"),
        pick(_KINDS, draw("s_suppkey", 1, 6)).alias("especialidade"), F.col("n_name").alias("cidade"),
        F.col("n_name").alias("estado"), F.col("r_name").alias("regiao"))


def patients(t: Tables) -> DataFrame:
    return H.build_patients(t.customer.select((F.col("c_custkey") + V.FIRST_PATIENT).alias("id_paciente")), AS_OF)


def consultations(t: Tables) -> DataFrame:
    keys = t.orders.select((F.col("o_orderkey") + 1001).alias("id_consulta"))
    weights = t.supplier.select(F.col("s_suppkey").alias("id_hospital"), (draw("s_suppkey", 1, 7) + 1).alias("peso"))
    kinds = t.supplier.select(F.col("s_suppkey").alias("id_hospital"), pick(_KINDS, draw("s_suppkey", 1, 6)).alias("especialidade"))
    codes = t.part.groupBy(F.col("p_type").alias("especialidade"), F.col("p_brand").alias("cid_10")).agg(
        F.min("p_name").alias("diagnostico_descricao"))
    return H.build_consultations(keys, kinds, weights, codes, n_patients=t.customer.count())


class Demo:
    """The demo's layers over the tables of one folder; each table is written when first asked for, then read by all reports.

    Consultations and reviews land as CSV files and are read back. The view holds the patient columns that reports use.
    """

    def __init__(self, t: Tables):
        self._t = t
        name = f"demo_{uuid.uuid4().hex[:8]}"
        self.lake = Lake(t.spark, new_folder(t.spark, name), name).setup()

    @cached_property
    def hospitals(self) -> DataFrame:
        return self.lake.promote(hospitals(self._t), "bronze", "hospitais")

    @cached_property
    def patients(self) -> DataFrame:
        return self.lake.sink_table(patients(self._t), "bronze", "pacientes", H.PATIENTS)

    @cached_property
    def visits(self) -> DataFrame:
        sink_landing(consultations(self._t), self.lake.landing("consultas"))
        return self.lake.promote(H.landed_consultations(self.lake), "bronze", "consultas")

    @cached_property
    def reviews(self) -> DataFrame:
        sink_landing(H.build_reviews(self.visits, None, AS_OF), self.lake.landing("avaliacoes"))
        return self.lake.promote(H.landed_reviews(self.lake), "bronze", "avaliacoes_lidas")

    @cached_property
    def view(self) -> DataFrame:
        people = self.patients.select("id_paciente", "idade", "sexo", "convenio")
        return self.lake.promote(H.view_360(self.visits, people, self.hospitals), "silver", "visao_360")

    @cached_property
    def gold(self) -> DataFrame:
        """The pipelines from the landed files to the gold table."""
        for made in (self.hospitals, self.patients, self.visits, self.reviews):
            made.schema  # noqa: B018  (asking for them writes them)
        H.ingest_consultations(self.lake)
        H.ingest_reviews(self.lake)
        H.build_360(self.lake)
        H.review_consultations(self.lake)
        return H.clinic_kpis(self.lake)


_SOURCES = ("customer", "nation", "orders", "part", "region", "supplier")
_demos: dict[tuple, Demo] = {}


def demo(t: Tables) -> Demo:
    """The layers of a folder, built once for a session; files that were added, removed or rewritten since build them anew."""
    files = t.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([f"{t.folder}/{x}.parquet" for x in _SOURCES])
    state = files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()  # names and sizes, not content
    key = (t.spark.sparkContext.applicationId, t.folder, tuple(state))
    if key not in _demos:
        _demos.clear()  # the layers of one folder at a time
        _demos[key] = Demo(t)
    return _demos[key]


_SIZES = "CAST((SELECT count(*) FROM customer) AS BIGINT)"

_VISITS_SQL = f"""
    slots AS (SELECT list(site ORDER BY site) AS s FROM
      (SELECT s_suppkey AS site, unnest(range(1 + s_suppkey % 7)) FROM supplier)),
    offered AS (SELECT p_type, list(o ORDER BY o.brand) AS options FROM
      (SELECT p_type, {{'brand': p_brand, 'name': min(p_name)}} AS o FROM part GROUP BY p_type, p_brand) GROUP BY p_type),
    located AS (SELECT o_orderkey + 1001 AS k, s[((o_orderkey + 1001) * {V.SITE_MULTIPLIER}) % len(s) + 1] AS site FROM orders, slots),
    described AS (SELECT k, site, {S.status('k')} AS status, options[(k * {V.CODE_MULTIPLIER}) % len(options) + 1] AS code
      FROM located LEFT JOIN offered ON p_type = {S.strings(_KINDS)}[site % 6 + 1]),
    consultas AS (SELECT k AS id_consulta,
      if({S.drawn('k', V.NULL_PATIENT_DRAW)} = 0, NULL, {V.FIRST_PATIENT} + (k * {V.PATIENT_MULTIPLIER}) % {_SIZES}) AS id_paciente,
      site AS id_hospital, {V.FIRST_DOCTOR} + (k * {V.DOCTOR_MULTIPLIER}) % {V.N_DOCTORS} AS id_medico,
      concat({S.strings(V.DOCTOR_TITLES)}[{S.drawn('k', V.DOCTOR_TITLE_DRAW)} + 1],
        {S.strings(H.DOCTOR_FIRST)}[{S.drawn('k', (V.DOCTOR_FIRST_MULTIPLIER, len(H.DOCTOR_FIRST)))} + 1], ' ',
        {S.strings(H.DOCTOR_LAST)}[{S.drawn('k', (V.DOCTOR_LAST_MULTIPLIER, len(H.DOCTOR_LAST)))} + 1]) AS nome_medico,
      {S.licence('k')} AS crm, {S.mode('k')} AS modalidade, status, CAST({S.wait('k')} AS INTEGER) AS tempo_espera_minutos,
      if(status = '{V.FINISHED}', code.brand, NULL) AS cid_10, if(status = '{V.FINISHED}', code.name, NULL) AS diagnostico_descricao,
      {S.procedure('k')} AS procedimento_realizado FROM described)"""

_POOL = {k: [x for kind, _, x in H.review_pool() if kind == k] for k in ("pos", "neg", "neu")}

_REVIEWS_SQL = f"""
    ordered AS (SELECT list(c ORDER BY c.id_consulta) AS rows FROM
      (SELECT c FROM consultas AS c WHERE c.status = '{V.FINISHED}')),
    placed AS (SELECT unnest(rows) AS c, generate_subscripts(rows, 1) AS seq FROM ordered),
    written AS (SELECT c, seq, [{', '.join(S.strings(v) for v in _POOL.values())}][
      list_position({S.strings(_POOL)}, {S.review_class('c.tempo_espera_minutos', 'seq')})] AS texts FROM placed),
    avaliacoes AS (SELECT c.id_consulta AS id_consulta, c.id_paciente AS id_paciente,
      texts[(seq * {V.REVIEW_TEXT_MULTIPLIER}) % len(texts) + 1] AS texto_avaliacao,
      DATE '{AS_OF}' - {S.drawn('c.id_consulta', V.REVIEW_DATE_DRAW)} AS data_avaliacao, {S.channel('c.id_consulta')} AS canal_avaliacao,
      {S.drawn('c.id_consulta', V.ANONYMOUS_DRAW)} < {V.ANONYMOUS_BELOW} AS avaliacao_anonima,
      CAST({S.delay('c.id_consulta')} AS INTEGER) AS tempo_para_avaliar_min FROM written)"""

_PEOPLE_SQL = f"""
    pacientes AS (SELECT *, {S.age_band('idade')} AS faixa_etaria FROM (SELECT k AS id_paciente,
      {S.element(H.FIRST_NAMES, 'k', V.FIRST_NAME_MULTIPLIER)} || ' ' || {S.element(H.LAST_NAMES, 'k', V.LAST_NAME_MULTIPLIER)} AS nome_paciente,
      {S.birth('k')} AS data_nascimento, {S.age('k')} AS idade, {S.sex('k')} AS sexo, {S.marital('k')} AS estado_civil,
      {S.tax_id('k')} AS cpf, {S.health_card('k')} AS cns, {S.registry_id('k')} AS rg,
      {_EMAIL.replace('c_custkey', 'k')} AS email, {S.phone('k')} AS telefone, {S.plan('k')} AS convenio
    FROM (SELECT c_custkey + {V.FIRST_PATIENT} AS k FROM customer)))"""

_VIEW_SQL = f"""WITH {_VISITS_SQL}, {_PEOPLE_SQL},
    visao AS (SELECT c.*, s.s_name AS nome_hospital, {S.strings(_KINDS)}[s.s_suppkey % 6 + 1] AS especialidade,
      n_name AS cidade, n_name AS estado, r_name AS regiao, p.idade, p.sexo, p.convenio, p.faixa_etaria
    FROM consultas c JOIN supplier s ON s.s_suppkey = c.id_hospital JOIN nation ON n_nationkey = s_nationkey
      JOIN region ON r_regionkey = n_regionkey LEFT JOIN pacientes p ON p.id_paciente = c.id_paciente)"""


@query("build_dim_sample", f"WITH {_PEOPLE_SQL} SELECT * EXCLUDE (faixa_etaria) FROM pacientes")
def build_dim_sample(t: Tables):
    return patients(t)


@query("build_fact_sample", f"""
    WITH {_VISITS_SQL} SELECT * FROM consultas""")
def build_fact_sample(t: Tables):
    return consultations(t)


@query("build_review_sample", f"WITH {_VISITS_SQL}, {_REVIEWS_SQL} SELECT * FROM avaliacoes")
def build_review_sample(t: Tables):
    return H.build_reviews(demo(t).visits, None, AS_OF)


@query("visit_references", f"""
    WITH {_VISITS_SQL}, {_PEOPLE_SQL}
    SELECT count(*) AS n_rows, count(*) FILTER (c.id_paciente IS NULL) AS null_rows,
      count(*) FILTER (c.id_paciente IS NOT NULL AND p.id_paciente IS NULL) AS orphan_rows, count(DISTINCT p.id_paciente) AS n_reached
    FROM consultas c LEFT JOIN pacientes p USING (id_paciente)""")
def visit_references(t: Tables):
    """Visits refer to the customers that there are: none to others."""
    visits, people = checkpointed(consultations(t).select("id_paciente")), patients(t).select("id_paciente")
    audit = orphan_audit(visits, "id_paciente", people, "id_paciente").drop("orphan_keys")
    reached = visits.select("id_paciente").distinct().join(people, "id_paciente", "left_semi").agg(F.count("*").alias("n_reached"))
    return audit.withColumn("n_reached", reached.scalar())


@query("report_build", f"""WITH {_VISITS_SQL}, {_REVIEWS_SQL}
    SELECT 'hospitais' AS layer, count(*) AS n FROM supplier UNION ALL SELECT 'pacientes', count(*) FROM customer UNION ALL
    SELECT 'consultas', count(*) FROM consultas UNION ALL SELECT 'avaliacoes', count(*) FROM avaliacoes UNION ALL
    SELECT 'visao', count(*) FROM consultas UNION ALL
    SELECT 'kpis', count(DISTINCT id_hospital) FROM consultas WHERE id_paciente IS NOT NULL AND status <> '{V.CANCELLED}'""")
def report_build(t: Tables):
    """All layers of the demo built from the tables, every time that it is asked for; the reports below read such layers."""
    d = Demo(t)
    layers = {"hospitais": d.hospitals, "pacientes": d.patients, "consultas": d.visits, "avaliacoes": d.reviews, "visao": d.view, "kpis": d.gold}
    counts = [df.agg(F.lit(name).alias("layer"), F.count("*").alias("n")) for name, df in layers.items()]
    return reduce(DataFrame.unionAll, counts)


@query("report_by_hospital", f"""{_VIEW_SQL}
    SELECT id_hospital, nome_hospital, cidade, especialidade, count(id_consulta) AS total_consultas,
      round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio,
      count(*) FILTER (status = 'cancelada') AS cancelamentos, count(DISTINCT id_paciente) AS pacientes_unicos
    FROM visao GROUP BY 1, 2, 3, 4""")
def report_by_hospital(t: Tables):
    return H.report_by_hospital(demo(t).view)


@query("report_by_channel", f"""{_VIEW_SQL}, {_REVIEWS_SQL}
    SELECT canal_avaliacao, cidade, count(*) AS total_avaliacoes, round(avg(tempo_para_avaliar_min), 4) AS avg_tempo_para_avaliar,
      round(count(*) FILTER (avaliacao_anonima) / count(*), 6) AS taxa_anonimato,
      round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio
    FROM avaliacoes JOIN (SELECT id_consulta, cidade, tempo_espera_minutos FROM visao) USING (id_consulta) GROUP BY 1, 2""")
def report_by_channel(t: Tables):
    d = demo(t)
    return H.report_by_channel(d.reviews, d.visits, d.hospitals)


@query("report_by_region_and_code", f"""{_VIEW_SQL}
    SELECT regiao, estado, especialidade, cid_10, diagnostico_descricao, count(id_consulta) AS total_consultas,
      count(DISTINCT id_paciente) AS pacientes_distintos, round(avg(idade), 4) AS idade_media,
      round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio
    FROM visao GROUP BY 1, 2, 3, 4, 5""")
def report_by_region_and_code(t: Tables):
    return H.report_by_region_and_code(demo(t).view)


@query("report_by_doctor", f"""{_VIEW_SQL}
    SELECT id_medico, nome_medico, crm, especialidade, count(id_consulta) AS total_consultas,
      count(*) FILTER (modalidade = 'presencial') AS presenciais,
      count(*) FILTER (modalidade = 'telemedicina') AS telemedicina,
      round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio
    FROM visao GROUP BY 1, 2, 3, 4""")
def report_by_doctor(t: Tables):
    return H.report_by_doctor(demo(t).view)


@query("report_by_demography", f"""{_VIEW_SQL}
    SELECT convenio, sexo, faixa_etaria, regiao, count(DISTINCT id_paciente) AS total_pacientes,
      count(id_consulta) AS total_consultas, count(*) FILTER (status = 'cancelada') AS cancelamentos,
      round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio,
      round(count(*) FILTER (modalidade = 'telemedicina') / count(*), 6) AS taxa_telemedicina
    FROM visao WHERE id_paciente IS NOT NULL GROUP BY 1, 2, 3, 4""")
def report_by_demography(t: Tables):
    return H.report_by_demography(demo(t).view)


@query("report_top_codes", f"""{_VIEW_SQL}
    SELECT especialidade, cid_10, n, rank FROM (SELECT especialidade, cid_10, count(*) AS n,
        row_number() OVER (PARTITION BY especialidade ORDER BY count(*) DESC, cid_10) AS rank
      FROM visao WHERE cid_10 IS NOT NULL GROUP BY 1, 2) WHERE rank <= 3""")
def report_top_codes(t: Tables):
    return H.top_codes(demo(t).view)


_SCORE_SQL = "(" + " + ".join(
    f"{points} * len(list_filter(string_split_regex(lower(texto_avaliacao), '[^\\p{{L}}]+'), lambda w: w = '{word}'))"
    for word, points in H.LEXICON.items()) + ")"


@query("report_wait_and_sentiment", f"""WITH {_VISITS_SQL}, {_REVIEWS_SQL},
    scored AS (SELECT tempo_espera_minutos AS w, {_SCORE_SQL} AS score FROM avaliacoes
      JOIN (SELECT id_consulta, tempo_espera_minutos FROM consultas) USING (id_consulta)),
    counted AS (SELECT CASE WHEN w < 20 THEN '< 20' WHEN w <= 30 THEN '20-30' ELSE '> 30' END AS band, count(*) AS n,
      count(*) FILTER (score > 0) AS n_positive, count(*) FILTER (score < 0) AS n_negative,
      count(*) FILTER (score = 0) AS n_neutral FROM scored GROUP BY 1)
    SELECT *, round(n_positive / n, 6) AS share_positive, round(n_negative / n, 6) AS share_negative,
      round(n_neutral / n, 6) AS share_neutral FROM counted""")
def report_wait_and_sentiment(t: Tables):
    d = demo(t)
    scored = H.analyse_reviews(d.reviews).select("id_consulta", "sentimento")
    return H.wait_and_sentiment(attach(scored, d.visits.select("id_consulta", "tempo_espera_minutos"), "id_consulta", derived=True))


@query("report_clinic", f"""WITH {_VISITS_SQL}, {_REVIEWS_SQL},
    clean AS (SELECT * FROM consultas WHERE id_paciente IS NOT NULL AND status <> '{V.CANCELLED}'),
    volume AS (SELECT id_hospital, count(*) AS total_consultas, round(avg(tempo_espera_minutos), 4) AS tempo_espera_medio
      FROM clean GROUP BY 1),
    mood AS (SELECT id_hospital, count(*) AS total_avaliacoes, round(avg(score), 4) AS sentimento_medio
      FROM (SELECT id_consulta, {_SCORE_SQL} AS score FROM avaliacoes) JOIN clean USING (id_consulta) GROUP BY 1)
    SELECT id_hospital, total_consultas, tempo_espera_medio, s_name AS nome_hospital, n_name AS cidade,
      {S.strings(_KINDS)}[s_suppkey % 6 + 1] AS especialidade, total_avaliacoes, sentimento_medio
    FROM volume JOIN supplier ON s_suppkey = id_hospital JOIN nation ON n_nationkey = s_nationkey
      LEFT JOIN mood USING (id_hospital)""")
def report_clinic(t: Tables):
    """Gold figures of the clean visits, through all pipelines."""
    return demo(t).gold


@query("report_layers", f"""
    WITH bronze AS ({GAPS_SQL}), silver AS (SELECT * FROM bronze WHERE fk IS NOT NULL AND o_orderstatus <> 'P')
    SELECT s_suppkey, count(*) AS n_visits, round(avg(l_quantity), 4) AS mean_wait,
      count(*) FILTER (o_orderstatus = 'P') AS n_cancelled, count(DISTINCT fk) AS n_people, s_name, n_name
    FROM lineitem JOIN silver ON o_orderkey = l_orderkey JOIN supplier ON s_suppkey = l_suppkey
      JOIN nation ON n_nationkey = s_nationkey GROUP BY s_suppkey, s_name, n_name""")
def report_layers(t: Tables):
    """The flagship flow: bronze, silver, view and gold tables."""
    return gold_by_site(t.spark, t.folder)
