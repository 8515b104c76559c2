"""Check digits of official numbers, by native arithmetic over their digits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from stratalake.functions.draws import col

#: Digits of the numbers that have check digits. Fixed values.
TAX_ID_DIGITS, HEALTH_CARD_DIGITS = 11, 15
#: First digits that a health card can have. Fixed values.
HEALTH_CARD_FIRST = (1, 2, 7, 8, 9)


def digits_of(value: Column | str) -> Column:
    """The decimal digits of a text, in order, as integers; NULL for a NULL text."""
    return F.transform(F.regexp_extract_all(col(value), F.lit("[0-9]"), F.lit(0)), lambda d: d.cast("int"))


def weighted_sum(digits: Column, weights: Sequence[int]) -> Column:
    """Sum of the first digits times the weights; digits beyond them do not count."""
    terms = F.zip_with(F.slice(digits, 1, len(weights)), F.array(*[F.lit(w) for w in weights]), lambda d, w: F.coalesce(d * w, F.lit(0)))
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b)


def _tax_digit(digits: Column, n: int) -> Column:
    """The check digit behind ``n`` digits: modulus 11 with weights n + 1 down to 2."""
    rest = 11 - weighted_sum(digits, range(n + 1, 1, -1)) % 11
    return F.when(rest >= 10, F.lit(0)).otherwise(rest)


def tax_id_valid(value: Column | str) -> Column:
    """Whether both check digits of a tax id are right; eleven equal digits are not valid. Punctuation does not matter."""
    digits = digits_of(value)
    right = (F.get(digits, F.lit(9)) == _tax_digit(digits, 9)) & (F.get(digits, F.lit(10)) == _tax_digit(digits, 10))
    return F.coalesce((F.size(digits) == TAX_ID_DIGITS) & right & (F.size(F.array_distinct(digits)) > 1), F.lit(False))


def health_card_valid(value: Column | str) -> Column:
    """Whether the digits of a health card, weighted 15 down to 1, sum to a multiple of 11."""
    digits = digits_of(value)
    total = weighted_sum(digits, range(HEALTH_CARD_DIGITS, 0, -1))
    return F.coalesce((F.size(digits) == HEALTH_CARD_DIGITS) & F.get(digits, F.lit(0)).isin(*HEALTH_CARD_FIRST) & (total % 11 == 0), F.lit(False))


def luhn_valid(value: Column | str) -> Column:
    """Whether the digits pass the Luhn rule: every second one from the right doubled, its own digits summed, a multiple of 10."""
    digits = F.reverse(digits_of(value))
    points = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0)))
    return F.coalesce((F.size(digits) > 1) & (F.aggregate(points, F.lit(0), lambda a, b: a + b) % 10 == 0), F.lit(False))


def with_tax_digits(value: Column | str) -> Column:
    """A tax id in its usual shape whose check digits follow from the first nine digits of the text; NULL for fewer."""
    digits = digits_of(value)
    one = _tax_digit(digits, 9)
    two = _tax_digit(F.concat(F.slice(digits, 1, 9), F.array(one)), 10)
    groups = [F.array_join(F.transform(F.slice(digits, k, 3), lambda d: d.cast("string")), "") for k in (1, 4, 7)]
    made = F.concat(groups[0], F.lit("."), groups[1], F.lit("."), groups[2], F.lit("-"), one.cast("string"), two.cast("string"))
    return F.when(F.size(digits) >= 9, made)


VALID = {"tax_id": tax_id_valid, "health_card": health_card_valid, "long_number": luhn_valid}
