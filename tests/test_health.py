"""The health demo: known counts, known traps of the data, pipelines and reports."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import quality as Q
from stratalake.operators.generate import id_range, inline
from stratalake.plans import columns as C
from stratalake.plans import health as H
from stratalake.sources.lake import Lake
from stratalake.sources.shared import new_folder

AS_OF = "2024-02-01"


@pytest.fixture(scope="module")
def lake(spark):
    folder = new_folder(spark, "health")
    made = Lake(spark, folder, f"health{folder[-8:]}")
    H.run_all(made, AS_OF)
    yield made
    made.drop()


@pytest.fixture(scope="module")
def visits(lake):
    return H.landed_consultations(lake).cache()


@pytest.fixture(scope="module")
def view(lake, visits):
    return H.view_360(visits, lake.table("bronze", "pacientes"), lake.table("bronze", "hospitais")).cache()


def counts(df, c):
    return {r[c]: r["count"] for r in df.groupBy(c).count().collect()}


def test_patients(lake):
    people = lake.table("bronze", "pacientes")
    assert sorted(counts(people, "convenio").values()) == [75, 120, 180, 225, 900]
    assert counts(people, "estado_civil") == {"Solteiro(a)": 525, "Casado(a)": 750, "Divorciado(a)": 150, "Viúvo(a)": 75}
    assert counts(people, "sexo") == {"M": 750, "F": 750}
    second = people.where("id_paciente > 600")
    bands = second.select(C.draw("id_paciente", 73, 100).alias("b"))
    got = [bands.where((F.col("b") >= lo) & (F.col("b") < hi)).count() for lo, hi in ((0, 20), (20, 70), (70, 85), (85, 95), (95, 100))]
    assert got == [200, 500, 150, 100, 50] and second.where("idade < 35").count() == 700


def test_consultations(visits):
    assert counts(visits, "status") == {"finalizada": 850, "cancelada": 100, "em_andamento": 50}
    assert counts(visits, "modalidade") == {"presencial": 600, "retorno": 300, "telemedicina": 100}
    got = visits.agg(F.count("*"), F.count_if(F.col("id_paciente").isNull()), F.countDistinct("id_paciente"),
                     F.round(F.avg("tempo_espera_minutos"), 2), F.max("tempo_espera_minutos")).first()
    assert tuple(got) == (1000, 100, 900, 53.01, 114)
    first = {r.id_consulta: r for r in visits.where("id_consulta in (1001, 1010)").collect()}
    assert (first[1001].id_paciente, first[1001].tempo_espera_minutos) == (1132, 102)
    assert (first[1010].id_paciente, first[1010].tempo_espera_minutos) == (None, 30)
    assert visits.where("status = 'finalizada' and cid_10 is null").count() == 0
    assert visits.where("status <> 'finalizada' and cid_10 is not null").count() == 0
    assert visits.where("status = 'em_andamento' and procedimento_realizado is null").count() == 0
    assert visits.where("status = 'cancelada' and (procedimento_realizado is not null or tempo_espera_minutos > 0)").count() == 0


def test_codes_fit_the_specialty(visits, lake):
    pool = inline(lake.spark, ["especialidade", "cid_10", "d"], H.diagnosis_pool())
    assert pool.count() == 44 and pool.select("especialidade").distinct().count() == 18
    coded = visits.where("cid_10 is not null").join(lake.table("bronze", "hospitais"), "id_hospital")
    assert coded.join(pool, ["especialidade", "cid_10"], "left_anti").count() == 0


def test_reviews(lake):
    reviews = H.landed_reviews(lake)
    assert counts(reviews, "canal_avaliacao") == {"App": 175, "WhatsApp": 148, "SMS": 77, "Site": 59, "Quiosque": 41}
    assert counts(reviews, "avaliacao_anonima") == {True: 76, False: 424}
    got = reviews.agg(F.count("*"), F.max("id_consulta"), F.count_if(F.col("id_paciente").isNull())).first()
    assert tuple(got) == (500, 1588, 53)
    assert reviews.agg(F.datediff(F.lit(AS_OF), F.max("data_avaliacao")), F.datediff(F.lit(AS_OF), F.min("data_avaliacao"))).first() == (0, 89)


def test_sentiment_follows_the_wait(lake):
    reviewed = lake.table("silver", "consultas_avaliadas")
    assert counts(reviewed, "sentimento") == {"positive": 107, "negative": 274, "neutral": 66}
    got = {r.band: (r.n_positive, r.n_negative, r.n_neutral) for r in H.wait_and_sentiment(reviewed).collect()}
    assert got == {"< 20": (31, 3, 6), "20-30": (23, 11, 5), "> 30": (53, 260, 55)}


def test_pipelines(lake):
    assert lake.table("silver", "consultas").count() == 810
    assert lake.table("silver", "consultas_quarentena").count() == 0
    assert lake.table("bronze", "avaliacoes").count() == 500
    assert lake.table("silver", "consultas_360").count() == 810
    gold = lake.table("gold", "kpis_clinica")
    assert gold.agg(F.sum("total_consultas"), F.sum("total_avaliacoes")).first() == (810, 447)
    mean = gold.agg(F.round(F.sum(F.col("tempo_espera_medio") * F.col("total_consultas")) / F.sum("total_consultas"), 1)).first()[0]
    assert mean == 59.9  # cancelled visits, whose wait is 0, are not in it


def test_broken_landing_rows_go_to_quarantine(lake, spark):
    other = Lake(spark, new_folder(spark, "broken"), f"broken{lake.name[-6:]}").setup()
    raw = H.landed_consultations(lake).limit(10).selectExpr(
        "id_consulta", "1 as id_paciente", "id_hospital", "id_medico", "nome_medico", "crm", "modalidade", "status",
        "if(id_consulta % 2 = 0, 'soon', '5') as tempo_espera_minutos", "cid_10", "diagnostico_descricao", "procedimento_realizado")
    H.sink_landing(raw, other.landing("consultas"))
    good, broken = H.ingest_consultations(other)
    assert broken.count() == 5 and {tuple(r._reasons) for r in broken.collect()} == {("tempo_espera_minutos is not int",)}
    assert good.count() <= 5
    other.drop()


def test_a_second_run_changes_nothing(lake, rows):
    before = {d: rows(f(lake)) for d, f in (("c", H.landed_consultations), ("r", H.landed_reviews))}
    people = rows(lake.table("bronze", "pacientes"))
    H.setup(lake, AS_OF)
    assert rows(H.landed_consultations(lake)) == before["c"] and rows(H.landed_reviews(lake)) == before["r"]
    assert rows(lake.table("bronze", "pacientes")) == people


def test_reports(lake, view):
    by_hospital = H.report_by_hospital(view)
    assert by_hospital.agg(F.sum("total_consultas"), F.sum("cancelamentos")).first() == (1000, 100)
    assert H.report_by_hospital(view, exclude_cancelled=True).agg(F.sum("total_consultas"), F.sum("cancelamentos")).first() == (900, 0)
    by_channel = H.report_by_channel(H.landed_reviews(lake), H.landed_consultations(lake), lake.table("bronze", "hospitais"))
    assert by_channel.agg(F.sum("total_avaliacoes")).first()[0] == 500
    by_code = H.report_by_region_and_code(view)
    assert by_code.where("cid_10 is null").agg(F.sum("total_consultas")).first()[0] == 150
    demography = H.report_by_demography(view)
    assert demography.agg(F.sum("total_consultas")).first()[0] == 900 and demography.where("convenio is null").count() == 0
    assert H.tele_ratio_by_specialty(view).count() == 18
    assert H.top_codes(view, 1).count() == 18


def test_known_traps_of_the_data(lake, view):
    people = lake.table("bronze", "pacientes")
    assert people.select("cpf").distinct().count() == 1000  # a tax id repeats, so it is no key
    assert Q.audit_unique(people, ["id_paciente"]).count() == 0
    assert H.report_by_doctor(view).count() == 1000  # name and licence vary by visit
    assert Q.audit_fd(view, ["id_medico"], ["nome_medico"]).agg(F.max("n_values")).first()[0] == 4
    assert people.select("nome_paciente").distinct().count() == 60  # not 30 x 20
    assert str(people.where("id_paciente <= 600").agg(F.max("data_nascimento")).first()[0]) == "2013-10-01"


def test_services_and_masking(lake):
    hospitals, people = lake.table("bronze", "hospitais"), lake.table("bronze", "pacientes")
    assert hospitals.count() == 140 and counts(H.classified_services(hospitals), "classe")["criancas"] > 0
    masked = H.masked_patients(people, "secret")
    assert not {"id_paciente", "nome_paciente", "data_nascimento"} & set(masked.columns)
    with pytest.raises(ValueError):
        H.masked_patients(people, "")
    assert masked.where(F.col("cpf").rlike("^[0-9]")).count() == 0 and masked.select("pseudonimo").distinct().count() == 1500
    load = H.visits_per_capacity(H.landed_consultations(lake), hospitals)
    assert load.agg(F.sum("visitas")).first()[0] == 1000


def test_builders_scale_by_keys(spark):
    keys = id_range(spark, 3_000_000_000, 3_000_000_050, "id_paciente")
    assert keys.select(C.tax_id("id_paciente"), C.birth_date("id_paciente", AS_OF)).distinct().count() == 51
