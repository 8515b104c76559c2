"""The health demo: generated sources, the five pipelines, the five reports and the review analysis.

Row counts, and the numbers of patients and doctors that visits refer to, are arguments; ids are BIGINT. ``as_of`` stands in for today's date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stratalake.functions.bands import age_band, band
from stratalake.functions.dates import age_years
from stratalake.functions.draws import draw, pick
from stratalake.functions.identifiers import email_address
from stratalake.functions.privacy import keep_last_digits, mask_columns, mask_email, pseudonym
from stratalake.operators import aggregate as agg
from stratalake.operators.generate import id_range, inline, load_static
from stratalake.operators.joins import attach, attach_all
from stratalake.operators.lookup import conditional_lookup, pick_in_group, weighted_draw
from stratalake.operators.quality import silver_clean
from stratalake.operators.sequence import global_seq, top_k_per_group
from stratalake.operators.text import classify_text, lexicon_score, polarity, tag_text
from stratalake.plans import columns as C
from stratalake.plans import fixed as V
from stratalake.sources.contract import Contract, enforce
from stratalake.sources.lake import Lake
from stratalake.sources.landing import scan_by_name, scan_landing, sink_landing

HOSPITALS = Contract.of(*V.HOSPITALS_COLUMNS, comments={"id_hospital": "Primary key"})
PATIENTS = Contract.of(*V.PATIENTS_COLUMNS, comments={"id_paciente": "Primary key", "cpf": "Personal data"})
CONSULTATIONS = Contract.of(*V.CONSULTATIONS_COLUMNS)
REVIEWS = Contract.of(*V.REVIEWS_COLUMNS)

# ---- own pools ---------------------------------------------------------------------------------------

FIRST_NAMES = [
    "Abel", "Adélia", "Bento", "Berta", "Caio", "Cecília", "Dário", "Dora", "Elias", "Elisa",
    "Fábio", "Flora", "Gil", "Gláucia", "Heitor", "Helena", "Ivo", "Inês", "Jonas", "Joyce",
    "Leônidas", "Lígia", "Mário", "Mônica", "Nelson", "Noêmia", "Otávio", "Olívia", "Saulo", "Sônia",
]
LAST_NAMES = [
    "Amaral", "Bastos", "Brandão", "Camargo", "Conceição", "Dantas", "Falcão", "Galvão", "Guimarães", "Leal",
    "Macedo", "Magalhães", "Neves", "Paixão", "Queirós", "Sá", "Teles", "Vasconcelos", "Viana", "Zanetti",
]
DOCTOR_FIRST = FIRST_NAMES[:16]
DOCTOR_LAST = LAST_NAMES[:10]
REGION_STATES = {
    "Norte": ["AM", "PA", "RO", "TO"],
    "Nordeste": ["BA", "CE", "MA", "PE", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MT", "MS"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC", "PR"],
}
SERVICES = {
    "Cardiologia": "coração e pressão arterial", "Ortopedia": "ossos e articulações",
    "Pediatria": "crianças e vacinas", "Endocrinologia": "hormônios e diabetes",
    "Dermatologia": "pele e alergias", "Neurologia": "cérebro e nervos",
    "Oncologia": "tumores e quimioterapia", "Urologia": "rins e bexiga",
    "Oftalmologia": "olhos e visão", "Pneumologia": "pulmões e asma",
    "Psiquiatria": "saúde mental e sono", "Geriatria": "idosos e memória",
    "Hematologia": "sangue e anemia", "Infectologia": "infecções e febre",
    "Nefrologia": "rins e diálise", "Reumatologia": "reumatismo e dor",
    "Gastroenterologia": "estômago e intestino", "Clínica Geral": "consultas e exames de rotina",
}
OPENINGS = {
    "pos": ["Gostei muito", "Tudo excelente", "Equipe gentil", "Recomendo a todos", "Fui bem cuidado"],
    "neg": ["Fiquei frustrado", "Tudo confuso", "Equipe grosseira", "Espera absurda", "Sai decepcionado"],
    "neu": ["Visita normal", "Nada a destacar", "Dentro do previsto", "Consulta comum", "Foi regular"],
}
DETAILS = {
    "pos": ["e a recepção ajudou", "com ótima limpeza", "e o exame saiu na hora", "com preço justo", "sem fila alguma"],
    "neg": ["e a recepção sumiu", "com sala suja", "e o exame atrasou", "com cobrança errada", "e a fila não andava"],
    "neu": ["na data marcada", "com a documentação pedida", "no prédio central"],
}
LEXICON = {
    "gostei": 2, "excelente": 2, "gentil": 1, "recomendo": 2, "cuidado": 1, "justo": 1, "limpeza": 1,
    "frustrado": -2, "confuso": -1, "grosseira": -2, "absurda": -2, "decepcionado": -2, "suja": -1, "errada": -1,
}
PROBLEMS = {
    "billing": r"cobrança|preço", "cleaning": r"suja|limpeza", "queue": r"fila|[Ee]spera",
    "staff": r"grosseira|recepção sumiu", "tests": r"exame atrasou",
}


def review_pool() -> list[tuple[str, int, str]]:
    """(class, position, text): every opening of a class with every detail of it."""
    out = []
    for kind in OPENINGS:
        texts = [f"{o} {d}." for o in OPENINGS[kind] for d in DETAILS[kind]]
        out += [(kind, i, t) for i, t in enumerate(sorted(texts))]
    return out


def diagnosis_pool() -> list[tuple[str, str, str]]:
    """(specialty, code, description): two codes per specialty, three for the first eight."""
    return [
        (name, f"{chr(ord('A') + i)}{10 * (j + 1):02d}", f"Condição {j + 1} de {name.lower()}")
        for i, name in enumerate(sorted(SERVICES))
        for j in range(3 if i < 8 else 2)
    ]


def site_rows(n: int = 140, cities: int = 28) -> list[tuple]:
    """Hospitals by rule: specialty, city and capacity follow from the number."""
    states = [(region, uf) for region, ufs in REGION_STATES.items() for uf in ufs]
    rows = []
    for i in range(1, n + 1):
        specialty = sorted(SERVICES)[i % len(SERVICES)]
        city = i % cities
        region, uf = states[city % len(states)]
        rows.append((
            i, f"Hospital {specialty} {i:03d}", specialty, f"Cidade {city + 1:02d}", f"Rua {7 * i}, {10 * i}",
            f"Bairro {i % 9 + 1}", uf, region, 40 + 20 * (i % 18), 10 + 5 * (i % 18), "24h" if i % 3 else "07h-19h",
            f"Atendimento em {specialty.lower()}: {SERVICES[specialty]}",
        ))
    return rows


# ---- generated sources -------------------------------------------------------------------------------


def build_hospitals(spark: SparkSession, n: int = 140) -> DataFrame:
    return load_static(spark, site_rows(n), HOSPITALS.schema())


def site_weights(hospitals: DataFrame) -> DataFrame:
    """Weight of each hospital by its city: the first cities draw most consultations."""
    city = F.substring("cidade", -2, 2).cast("int")
    return hospitals.select("id_hospital", F.greatest(F.lit(26) - city, F.lit(1)).cast("bigint").alias("peso"))


def build_patients(keys: DataFrame, as_of: str) -> DataFrame:
    """Patients for the keys in ``id_paciente``; one projection, nothing is moved."""
    key = F.col("id_paciente")
    first = pick(sorted(FIRST_NAMES), draw(key, V.FIRST_NAME_MULTIPLIER, len(FIRST_NAMES)))
    last = pick(sorted(LAST_NAMES), draw(key, V.LAST_NAME_MULTIPLIER, len(LAST_NAMES)))
    named = keys.select(key, first.alias("first"), last.alias("last"), C.birth_date(key, as_of).alias("data_nascimento"))
    return named.select(
        key.cast("bigint").alias("id_paciente"),
        F.concat("first", F.lit(" "), "last").alias("nome_paciente"),
        "data_nascimento",
        age_years("data_nascimento", as_of).alias("idade"),
        C.sex(key).alias("sexo"),
        C.marital_status(key).alias("estado_civil"),
        C.tax_id(key).alias("cpf"),
        C.health_card(key).alias("cns"),
        C.registry_id(key).alias("rg"),
        email_address(key, "first", "last", V.EMAIL_DOMAIN).alias("email"),
        C.phone(key).alias("telefone"),
        C.health_plan(key).alias("convenio"),
    )


def build_consultations(
    keys: DataFrame, hospitals: DataFrame, weights: DataFrame, codes: DataFrame, *, n_patients: int = V.N_PATIENTS,
    n_doctors: int = V.N_DOCTORS,
) -> DataFrame:
    """Consultations for the keys in ``id_consulta``, with references to ``n_patients`` patients and ``n_doctors`` doctors.

    ``weights`` has ``id_hospital, peso``; ``codes`` has ``especialidade, cid_10, diagnostico_descricao``.
    """
    key = F.col("id_consulta")
    drawn = weighted_draw(keys.select(key), "id_consulta", V.SITE_MULTIPLIER, weights, "id_hospital", "peso")
    placed = attach(drawn, hospitals.select("id_hospital", "especialidade"), "id_hospital", derived=True)
    coded = pick_in_group(placed, "especialidade", "id_consulta", V.CODE_MULTIPLIER, codes, "cid_10", derived=True)
    finished = C.status(key) == V.FINISHED
    name = F.concat(
        pick(V.DOCTOR_TITLES, draw(key, *V.DOCTOR_TITLE_DRAW)),
        pick(DOCTOR_FIRST, draw(key, V.DOCTOR_FIRST_MULTIPLIER, len(DOCTOR_FIRST))), F.lit(" "),
        pick(DOCTOR_LAST, draw(key, V.DOCTOR_LAST_MULTIPLIER, len(DOCTOR_LAST))))
    return coded.select(
        key.cast("bigint").alias("id_consulta"),
        C.patient_reference(key, n_patients).cast("bigint").alias("id_paciente"),
        F.col("id_hospital").cast("bigint").alias("id_hospital"),
        C.doctor_reference(key, n_doctors).cast("bigint").alias("id_medico"),
        name.alias("nome_medico"),
        C.licence(key).alias("crm"),
        C.mode(key).alias("modalidade"),
        C.status(key).alias("status"),
        C.wait_minutes(key).cast("int").alias("tempo_espera_minutos"),
        F.when(finished, F.col("cid_10")).alias("cid_10"),
        F.when(finished, F.col("diagnostico_descricao")).alias("diagnostico_descricao"),
        C.procedure(key).alias("procedimento_realizado"),
    )


def build_reviews(consultations: DataFrame, n: int | None, as_of: str) -> DataFrame:
    """One review for each of the first ``n`` finished consultations (all if None), classes biased by waiting time."""
    finished = consultations.where(F.col("status") == V.FINISHED).select(
        "id_consulta", "id_paciente", "tempo_espera_minutos")
    numbered = global_seq(finished, "id_consulta", "seq")
    chosen = numbered if n is None else numbered.where(F.col("seq") <= n)
    classed = chosen.withColumn("classe", C.review_class("tempo_espera_minutos", "seq"))
    texts = inline(consultations.sparkSession, ["classe", "idx", "texto_avaliacao"], review_pool())
    written = conditional_lookup(classed, "classe", "seq", V.REVIEW_TEXT_MULTIPLIER, texts, derived=True)
    key = F.col("id_consulta")
    return written.select(
        key.cast("bigint").alias("id_consulta"),
        F.col("id_paciente").cast("bigint").alias("id_paciente"),
        "texto_avaliacao",
        C.review_date(key, as_of).alias("data_avaliacao"),
        C.channel(key).alias("canal_avaliacao"),
        C.anonymous(key).alias("avaliacao_anonima"),
        C.review_delay(key).cast("int").alias("tempo_para_avaliar_min"),
    )


def setup(
    lake: Lake, as_of: str, *, n_patients: int = V.N_PATIENTS, n_doctors: int = V.N_DOCTORS,
    n_consultations: int = 1000, n_reviews: int | None = 500,
) -> Lake:
    """Create the layers, the two base tables and the two landing directories; safe to repeat."""
    spark = lake.setup().spark
    hospitals = lake.sink_table(build_hospitals(spark), "bronze", "hospitais", HOSPITALS, comment="Hospital register")
    people = id_range(spark, V.FIRST_PATIENT, V.FIRST_PATIENT + n_patients - 1, "id_paciente")
    lake.sink_table(build_patients(people, as_of), "bronze", "pacientes", PATIENTS,
                    comment="Patient register, holds personal data")
    codes = inline(spark, ["especialidade", "cid_10", "diagnostico_descricao"], diagnosis_pool())
    visits = id_range(spark, 1001, 1000 + n_consultations, "id_consulta")
    made = build_consultations(visits, hospitals, site_weights(hospitals), codes, n_patients=n_patients, n_doctors=n_doctors)
    sink_landing(made, lake.landing("consultas"))
    landed = landed_consultations(lake)
    sink_landing(build_reviews(landed, n_reviews, as_of), lake.landing("avaliacoes"), order_by="id_consulta")
    return lake


def landed_consultations(lake: Lake) -> DataFrame:
    return scan_landing(lake.spark, lake.landing("consultas"), CONSULTATIONS.schema())


def landed_reviews(lake: Lake) -> DataFrame:
    return scan_landing(lake.spark, lake.landing("avaliacoes"), REVIEWS.schema())


# ---- pipelines ---------------------------------------------------------------------------------------


def _landed_text(lake: Lake, name: str, contract: Contract) -> DataFrame:
    """Landed fields as text, with whole lines kept where they do not fit."""
    return scan_by_name(lake.spark, lake.landing(name), contract, "_linha")


def ingest_consultations(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Pipeline 1: landing -> silver.consultas without NULL patients and cancelled rows; broken rows aside."""
    good, broken = enforce(_landed_text(lake, "consultas", CONSULTATIONS), CONSULTATIONS, "_linha")
    clean = silver_clean(good, "id_paciente", "status", V.CANCELLED)
    clean = clean.withColumn("em_aberto", F.col("status") == V.RUNNING)
    return (lake.promote(clean, "silver", "consultas"), lake.promote(broken, "silver", "consultas_quarentena"))


def ingest_reviews(lake: Lake) -> DataFrame:
    """Pipeline 2: landing -> bronze.avaliacoes; broken rows aside."""
    good, broken = enforce(_landed_text(lake, "avaliacoes", REVIEWS), REVIEWS, "_linha")
    lake.promote(broken, "bronze", "avaliacoes_quarentena")
    return lake.promote(good, "bronze", "avaliacoes")


def view_360(consultations: DataFrame, patients: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Consultations with patient and hospital attributes; a consultation without patient keeps NULLs there."""
    people = patients.withColumn("faixa_etaria", age_band("idade"))
    return attach_all(consultations, [(hospitals, "id_hospital", "inner"), (people, "id_paciente", "left")])


def build_360(lake: Lake) -> DataFrame:
    """Pipeline 3: silver.consultas with both registers -> silver.consultas_360."""
    joined = view_360(lake.table("silver", "consultas"), lake.table("bronze", "pacientes"), lake.table("bronze", "hospitais"))
    return lake.promote(joined, "silver", "consultas_360")


def analyse_reviews(reviews: DataFrame) -> DataFrame:
    """Score, polarity and problem tags of every review text."""
    scored = reviews.withColumn("pontos", lexicon_score("texto_avaliacao", LEXICON))
    return scored.select(
        "*", polarity("pontos").alias("sentimento"), tag_text("texto_avaliacao", PROBLEMS).alias("problemas"))


def review_consultations(lake: Lake) -> DataFrame:
    """Pipeline 4: reviews with scores, joined with their clean consultation -> silver.consultas_avaliadas."""
    # The scored side stays on the left: the right side is measured, and measuring scores would score twice.
    scored = analyse_reviews(lake.table("bronze", "avaliacoes")).drop("id_paciente")
    joined = attach(scored, lake.table("silver", "consultas"), "id_consulta")
    return lake.promote(joined, "silver", "consultas_avaliadas")


def clinic_kpis(lake: Lake) -> DataFrame:
    """Pipeline 5: volume, mean wait and mean score of the clean visits per hospital -> gold.kpis_clinica."""
    volume = agg.kpi(lake.table("silver", "consultas"), ["id_hospital"], {
        "total_consultas": F.count(F.lit(1)), "tempo_espera_medio": agg.mean("tempo_espera_minutos")})
    mood = agg.kpi(lake.table("silver", "consultas_avaliadas"), ["id_hospital"], {
        "total_avaliacoes": F.count(F.lit(1)), "sentimento_medio": agg.mean("pontos")})
    names = lake.table("bronze", "hospitais").select("id_hospital", "nome_hospital", "cidade", "especialidade")
    joined = attach_all(volume, [(names, "id_hospital", "inner"), (mood, "id_hospital", "left")])
    return lake.promote(joined, "gold", "kpis_clinica")


def run_all(lake: Lake, as_of: str, **sizes) -> DataFrame:
    """The whole demo from empty layers to the gold table."""
    setup(lake, as_of, **sizes)
    ingest_consultations(lake)
    ingest_reviews(lake)
    build_360(lake)
    review_consultations(lake)
    return clinic_kpis(lake)


# ---- reports -----------------------------------------------------------------------------------------


def _kept(view: DataFrame, exclude_cancelled: bool) -> DataFrame:
    return view.where(F.col("status") != V.CANCELLED) if exclude_cancelled else view


def report_by_hospital(view: DataFrame, *, exclude_cancelled: bool = False) -> DataFrame:
    """Report 1. Input of the reports is the raw 360 view, so cancellations can be counted."""
    return agg.kpi(_kept(view, exclude_cancelled), ["id_hospital", "nome_hospital", "cidade", "especialidade"], {
        "total_consultas": F.count("id_consulta"),
        "tempo_espera_medio": agg.mean("tempo_espera_minutos"),
        "cancelamentos": F.count_if(F.col("status") == V.CANCELLED),
        "pacientes_unicos": F.countDistinct("id_paciente"),
    })


def report_by_channel(reviews: DataFrame, consultations: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Report 2: reviews per channel and city."""
    placed = attach_all(reviews, [
        (consultations.select("id_consulta", "id_hospital", "tempo_espera_minutos"), "id_consulta", "inner"),
        (hospitals.select("id_hospital", "cidade"), "id_hospital", "inner"),
    ])
    return agg.kpi(placed, ["canal_avaliacao", "cidade"], {
        "total_avaliacoes": F.count("id_consulta"),
        "avg_tempo_para_avaliar": agg.mean("tempo_para_avaliar_min"),
        "taxa_anonimato": agg.ratio(F.col("avaliacao_anonima")),
        "tempo_espera_medio": agg.mean("tempo_espera_minutos"),
    })


def report_by_region_and_code(view: DataFrame, *, exclude_cancelled: bool = False) -> DataFrame:
    """Report 3. Consultations without a code form groups of their own."""
    keys = ["regiao", "estado", "especialidade", "cid_10", "diagnostico_descricao"]
    return agg.kpi(_kept(view, exclude_cancelled), keys, {
        "total_consultas": F.count("id_consulta"),
        "pacientes_distintos": F.countDistinct("id_paciente"),
        "idade_media": agg.mean("idade"),
        "tempo_espera_medio": agg.mean("tempo_espera_minutos"),
    })


def report_by_doctor(view: DataFrame, *, exclude_cancelled: bool = False) -> DataFrame:
    """Report 4. Name and licence vary by visit in this data, so most groups hold one visit."""
    return agg.kpi(_kept(view, exclude_cancelled), ["id_medico", "nome_medico", "crm", "especialidade"], {
        "total_consultas": F.count("id_consulta"),
        "presenciais": F.count_if(F.col("modalidade") == "presencial"),
        "telemedicina": F.count_if(F.col("modalidade") == "telemedicina"),
        "tempo_espera_medio": agg.mean("tempo_espera_minutos"),
    })


def report_by_demography(view: DataFrame, *, exclude_cancelled: bool = False) -> DataFrame:
    """Report 5. Visits without a patient have no place in it."""
    known = _kept(view, exclude_cancelled).where(F.col("id_paciente").isNotNull())
    return agg.kpi(known, ["convenio", "sexo", "faixa_etaria", "regiao"], {
        "total_pacientes": F.countDistinct("id_paciente"),
        "total_consultas": F.count("id_consulta"),
        "cancelamentos": F.count_if(F.col("status") == V.CANCELLED),
        "tempo_espera_medio": agg.mean("tempo_espera_minutos"),
        "taxa_telemedicina": agg.ratio(F.col("modalidade") == "telemedicina"),
    })


def tele_ratio_by_specialty(view: DataFrame) -> DataFrame:
    return agg.kpi(view, ["especialidade"], {"taxa_telemedicina": agg.ratio(F.col("modalidade") == "telemedicina")})


def top_codes(view: DataFrame, k: int = 3) -> DataFrame:
    """Most frequent codes per specialty."""
    counted = view.where(F.col("cid_10").isNotNull()).groupBy("especialidade", "cid_10").agg(F.count(F.lit(1)).alias("n"))
    return top_k_per_group(counted, "especialidade", [F.desc("n"), F.asc("cid_10")], k)


def visits_per_capacity(view: DataFrame, hospitals: DataFrame) -> DataFrame:
    """Visits per bed and per doctor of each hospital."""
    visits = view.groupBy("id_hospital").agg(F.count(F.lit(1)).alias("visitas"))
    by_bed = agg.load_per_capacity(
        visits, hospitals.select("id_hospital", "qtd_leitos", "qtd_medicos"), "id_hospital", "visitas", "qtd_leitos")
    per_doctor = F.round(F.try_divide(F.col("visitas").cast("double"), F.col("qtd_medicos")), 6)
    return by_bed.withColumn("visitas_per_qtd_medicos", per_doctor)


def wait_and_sentiment(reviewed: DataFrame) -> DataFrame:
    """Share of each polarity per waiting band."""
    return agg.crosstab_share(
        reviewed, band("tempo_espera_minutos", V.WAIT_BANDS), "sentimento", ["positive", "negative", "neutral"])


def masked_patients(patients: DataFrame, salt: str) -> DataFrame:
    """The patient register without name, birth date and id; other personal data masked, and a pseudonym that still joins.

    The salt must be a secret: without it the pseudonym of a small id is found by trying all of them.
    """
    if not salt:
        raise ValueError("a salt is needed")
    masked = mask_columns(patients, {
        "cpf": lambda c: keep_last_digits(c, 2), "cns": lambda c: keep_last_digits(c, 3),
        "rg": lambda c: keep_last_digits(c, 1), "email": mask_email, "telefone": lambda c: keep_last_digits(c, 4),
    })
    return masked.withColumn("pseudonimo", pseudonym("id_paciente", salt)).drop("id_paciente", "nome_paciente", "data_nascimento")


def classified_services(hospitals: DataFrame) -> DataFrame:
    """Service class of the free-text description by keyword."""
    keywords = {"criancas": ["vacinas", "pediatria"], "imagem": ["exames"], "internacao": ["quimioterapia", "tumores"]}
    return hospitals.select("id_hospital", classify_text("descricao_servicos", keywords, "geral").alias("classe"))
