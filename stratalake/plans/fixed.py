"""FIXED VALUES of the health demo data.

Multipliers, moduli, shares, formats and labels below are facts of the data being generated: another value
would give other rows. Names, places, codes and texts are this package's own.
"""

# --- people -------------------------------------------------------------------------------------------
FIRST_NAME_MULTIPLIER = 31
LAST_NAME_MULTIPLIER = 17
UNIFORM_BIRTH_LAST_ID = 600
UNIFORM_BIRTH_START = "1940-01-01"
UNIFORM_BIRTH_DRAW = (73, 27000)
SKEWED_BIRTH_BUCKET = (73, 100)
SKEWED_BIRTH_MULTIPLIER = 41
#: (upper draw, youngest age in days, width in days)
SKEWED_BIRTH_TIERS = [
    (20, 1 * 365, 17 * 365),
    (70, 18 * 365, 17 * 365),
    (85, 35 * 365, 15 * 365),
    (95, 50 * 365, 15 * 365),
    (100, 65 * 365, 20 * 365),
]
SEX_DRAW = (11, 2)
SEXES = ["M", "F"]
MARITAL_DRAW = (19, 100)
MARITAL_SHARES = [("Solteiro(a)", 35), ("Casado(a)", 50), ("Divorciado(a)", 10), ("Viúvo(a)", 5)]
PLAN_DRAW = (13, 100)
PLAN_SHARES = [
    ("SUS", 60),
    ("Unimed", 15),
    ("Bradesco Saúde", 12),
    ("Hapvida NotreDame Intermédica", 8),
    ("Amil", 5),
]
#: Template and (multiplier, modulus, width) per digit group
TAX_ID = ("{}.{}.{}-{}", [(137, 1000, 3), (211, 1000, 3), (313, 1000, 3), (53, 100, 2)])
HEALTH_CARD = ("700 {} {} {}", [(167, 10000, 4), (251, 10000, 4), (379, 1000, 3)])
REGISTRY_ID = ("{}.{}.{}-{}", [(89, 100, 2), (127, 1000, 3), (181, 1000, 3), (7, 10, 1)])
PHONE = ("9{}-{}", [(233, 10000, 4), (317, 10000, 4)])
AREA_CODES = ["11", "11", "11", "21", "21", "31", "41", "51", "61", "71", "81", "85", "62", "92"]
AREA_CODE_MULTIPLIER = 41
EMAIL_DOMAIN = "email.com.br"
#: Letters folded in addresses; letters outside the map pass through unchanged
ACCENTS = ("áéíóúâêôãõçÁÉÍÓÚÂÊÔÃÕÇ", "aeiouaeoaocAEIOUAEOAOC")
#: The same with the further letters of French, German and Spanish
WIDE_ACCENTS = (ACCENTS[0] + "àèìòùäëïöüîûñÀÈÌÒÙÄËÏÖÜÎÛÑ", ACCENTS[1] + "aeiouaeiouiunAEIOUAEIOUIUN")

# --- consultations ------------------------------------------------------------------------------------
NULL_PATIENT_DRAW = (7, 10)
PATIENT_MULTIPLIER = 31
N_PATIENTS = 1500
FIRST_PATIENT = 101
SITE_MULTIPLIER = 17
DOCTOR_MULTIPLIER = 29
N_DOCTORS = 100
FIRST_DOCTOR = 5000
DOCTOR_TITLE_DRAW = (29, 2)
DOCTOR_TITLES = ["Dr. ", "Dra. "]
DOCTOR_FIRST_MULTIPLIER = 29
DOCTOR_LAST_MULTIPLIER = 47
LICENCE_STATES = ["SP", "RJ", "MG", "RS", "PR", "BA", "PE", "CE", "DF", "SC"]
LICENCE_STATE_MULTIPLIER = 29
LICENCE_NUMBER_DRAW = (379, 800000)
LICENCE_NUMBER_START = 100000
MODE_DRAW = (53, 100)
MODE_SHARES = [("presencial", 60), ("retorno", 30), ("telemedicina", 10)]
STATUS_DRAW = (11, 100)
STATUS_SHARES = [("finalizada", 85), ("cancelada", 10), ("em_andamento", 5)]
FINISHED, CANCELLED, RUNNING = "finalizada", "cancelada", "em_andamento"
WAIT_DRAWS = ((23, 90), (19, 30))
CODE_MULTIPLIER = 67
PROCEDURE_DRAW = (83, 10)
PROCEDURE_RETURN = "Consulta de retorno"
PROCEDURE_TELE = "Consulta por telemedicina"
PROCEDURE_SHARES = [
    ("Consulta de rotina", 6),
    ("Exame complementar solicitado", 2),
    ("Procedimento ambulatorial realizado", 2),
]

# --- reviews ------------------------------------------------------------------------------------------
CLASS_DRAW = (7, 100)
#: Shares of positive, negative and neutral reviews by waiting time
CLASS_BY_WAIT = [
    ("<", 20, [("pos", 75), ("neg", 10), ("neu", 15)]),
    ("<=", 30, [("pos", 55), ("neg", 25), ("neu", 20)]),
    (None, None, [("pos", 15), ("neg", 70), ("neu", 15)]),
]
WAIT_BANDS = [("< 20", "<", 20), ("20-30", "<=", 30), ("> 30", None, None)]
REVIEW_TEXT_MULTIPLIER = 13
REVIEW_DATE_DRAW = (19, 90)
CHANNEL_DRAW = (43, 100)
CHANNEL_SHARES = [("App", 35), ("WhatsApp", 30), ("SMS", 15), ("Site", 12), ("Quiosque", 8)]
ANONYMOUS_DRAW = (71, 100)
ANONYMOUS_BELOW = 15
DELAY_BUCKET = (89, 100)
DELAY_MULTIPLIER = 31
#: (upper draw, modulus, offset) in minutes
DELAY_TIERS = [(20, 120, 5), (60, 1320, 120), (90, 5760, 1440), (100, 2880, 7200)]
DELAY_BANDS = [("2h", "<", 2 * 60), ("24h", "<", 24 * 60), ("5d", "<", 5 * 24 * 60), ("7d", None, None)]

# --- table layouts ------------------------------------------------------------------------------------
HOSPITALS_COLUMNS = [
    "id_hospital bigint!", "nome_hospital string!", "especialidade string!", "cidade string!", "endereco string!",
    "bairro string!", "estado string!", "regiao string!", "qtd_leitos int!", "qtd_medicos int!",
    "horario_funcionamento string!", "descricao_servicos string!",
]
PATIENTS_COLUMNS = [
    "id_paciente bigint!", "nome_paciente string!", "data_nascimento date!", "idade int!", "sexo string!",
    "estado_civil string!", "cpf string!", "cns string!", "rg string!", "email string!", "telefone string!",
    "convenio string!",
]
CONSULTATIONS_COLUMNS = [
    "id_consulta bigint!", "id_paciente bigint", "id_hospital bigint!", "id_medico bigint!", "nome_medico string!", "crm string!",
    "modalidade string!", "status string!", "tempo_espera_minutos int!", "cid_10 string",
    "diagnostico_descricao string", "procedimento_realizado string",
]
REVIEWS_COLUMNS = [
    "id_consulta bigint!", "id_paciente bigint", "texto_avaliacao string!", "data_avaliacao date!",
    "canal_avaliacao string!", "avaliacao_anonima boolean!", "tempo_para_avaliar_min int!",
]
