"""Column formulas of the health demo, each a function of the row's key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratalake.functions.dates import days_after, days_before, skewed_birth_date
from stratalake.functions.draws import biased_class, col, draw, null_every, pick, pick_weighted, tiered, two_part_wait
from stratalake.functions.identifiers import digits, formatted_id
from stratalake.plans import fixed as V


def birth_date(key: Column | str, as_of: str) -> Column:
    """Uniform over a fixed span for the first ids, skewed to young ages for the rest."""
    uniform = days_after(V.UNIFORM_BIRTH_START, draw(key, *V.UNIFORM_BIRTH_DRAW))
    skewed = skewed_birth_date(key, as_of, V.SKEWED_BIRTH_BUCKET, V.SKEWED_BIRTH_MULTIPLIER, V.SKEWED_BIRTH_TIERS)
    return F.when(col(key) <= V.UNIFORM_BIRTH_LAST_ID, uniform).otherwise(skewed)


def sex(key: Column | str) -> Column:
    return F.when(draw(key, *V.SEX_DRAW) == 0, V.SEXES[0]).otherwise(V.SEXES[1])


def marital_status(key: Column | str) -> Column:
    return pick_weighted(draw(key, *V.MARITAL_DRAW), V.MARITAL_SHARES)


def health_plan(key: Column | str) -> Column:
    return pick_weighted(draw(key, *V.PLAN_DRAW), V.PLAN_SHARES)


def tax_id(key: Column | str) -> Column:
    return formatted_id(key, *V.TAX_ID)


def health_card(key: Column | str) -> Column:
    return formatted_id(key, *V.HEALTH_CARD)


def registry_id(key: Column | str) -> Column:
    return formatted_id(key, *V.REGISTRY_ID)


def phone(key: Column | str) -> Column:
    area = pick(V.AREA_CODES, draw(key, V.AREA_CODE_MULTIPLIER, len(V.AREA_CODES)))
    return F.concat(F.lit("("), area, F.lit(") "), formatted_id(key, *V.PHONE))


def licence(key: Column | str) -> Column:
    state = pick(V.LICENCE_STATES, draw(key, V.LICENCE_STATE_MULTIPLIER, len(V.LICENCE_STATES)))
    number = draw(key, *V.LICENCE_NUMBER_DRAW) + V.LICENCE_NUMBER_START
    return F.concat(F.lit("CRM/"), state, F.lit(" "), digits(number, 6))


def patient_reference(key: Column | str, n_patients: int = V.N_PATIENTS) -> Column:
    """The id of one of ``n_patients`` patients, or NULL for one consultation in ten."""
    return null_every(key, *V.NULL_PATIENT_DRAW, draw(key, V.PATIENT_MULTIPLIER, n_patients) + V.FIRST_PATIENT)


def doctor_reference(key: Column | str, n_doctors: int = V.N_DOCTORS) -> Column:
    return draw(key, V.DOCTOR_MULTIPLIER, n_doctors) + V.FIRST_DOCTOR


def mode(key: Column | str) -> Column:
    return pick_weighted(draw(key, *V.MODE_DRAW), V.MODE_SHARES)


def status(key: Column | str) -> Column:
    return pick_weighted(draw(key, *V.STATUS_DRAW), V.STATUS_SHARES)


def wait_minutes(key: Column | str) -> Column:
    return two_part_wait(key, *V.WAIT_DRAWS, zero_when=status(key) == V.CANCELLED)


def procedure(key: Column | str) -> Column:
    """Label by status first, then by mode, then by a draw of its own."""
    return (
        F.when(status(key) == V.CANCELLED, F.lit(None).cast("string"))
        .when(mode(key) == "retorno", V.PROCEDURE_RETURN)
        .when(mode(key) == "telemedicina", V.PROCEDURE_TELE)
        .otherwise(pick_weighted(draw(key, *V.PROCEDURE_DRAW), V.PROCEDURE_SHARES))
    )


def review_class(wait: Column | str, position: Column | str) -> Column:
    return biased_class(wait, draw(position, *V.CLASS_DRAW), V.CLASS_BY_WAIT)


def review_date(key: Column | str, as_of: str) -> Column:
    return days_before(as_of, draw(key, *V.REVIEW_DATE_DRAW))


def channel(key: Column | str) -> Column:
    return pick_weighted(draw(key, *V.CHANNEL_DRAW), V.CHANNEL_SHARES)


def anonymous(key: Column | str) -> Column:
    return draw(key, *V.ANONYMOUS_DRAW) < V.ANONYMOUS_BELOW


def review_delay(key: Column | str) -> Column:
    """Minutes until the review, long-tailed: most within a day, the rest over a week."""
    tiers = [(upper, draw(key, V.DELAY_MULTIPLIER, modulus) + offset) for upper, modulus, offset in V.DELAY_TIERS]
    return tiered(draw(key, *V.DELAY_BUCKET), tiers)
