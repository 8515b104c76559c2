"""Masking and format rules for personal data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.draws import col

#: Shapes of the generated identifiers.
FORMATS = {
    "tax_id": r"^[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}$",
    "health_card": r"^700 [0-9]{4} [0-9]{4} [0-9]{3}$",
    "registry_id": r"^[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9]$",
    "email": r"^[a-z0-9._]+@[a-z0-9]+(\.[a-z0-9]+)+$",
    "phone": r"^\([0-9]{2}\) 9[0-9]{4}-[0-9]{4}$",
}

#: A literal without which a shape cannot occur; looking for it first spares most texts the pattern.
_NEEDED = {"emails": "@", "phones": "+", "ips": ".", "tax_ids": "-", "health_cards": "700 ", "registry_ids": "-", "local_phones": ") 9"}

#: Shapes looked for in free text.
IN_TEXT = {
    "emails": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "phones": r"\+[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "ips": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "long_numbers": r"[0-9]{13,19}",
}

#: The generated identifiers in free text, not as a part of a longer run of digits or letters.
IDS_IN_TEXT = {
    "tax_ids": r"\b[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}\b",
    "health_cards": r"\b700 [0-9]{4} [0-9]{4} [0-9]{3}\b",
    "registry_ids": r"\b[0-9]{2}\.[0-9]{3}\.[0-9]{3}-[0-9]\b",
    "local_phones": r"\([0-9]{2}\) 9[0-9]{4}-[0-9]{4}\b",
}


def keep_last_digits(value: Column | str, keep: int) -> Column:
    """Every digit becomes ``*`` except the last ``keep`` digits; punctuation stays."""
    return F.regexp_replace(col(value), rf"[0-9](?=(?:[^0-9]*[0-9]){{{keep}}})", "*")


def mask_email(value: Column | str) -> Column:
    """First letter and domain stay, the rest of the name becomes ``***``."""
    return F.regexp_replace(col(value), r"^(.)[^@]*@", "$1***@")


def pseudonym(value: Column | str, salt: str = "") -> Column:
    """SHA-256 of the value: equal inputs stay equal, so masked columns still join."""
    return F.sha2(F.concat(F.lit(salt), col(value).cast("string")), 256)


def mask_columns(df: DataFrame, rules: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Replace the listed columns by their masked form in one projection."""
    missing = set(rules) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.select(*[rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in df.columns])


def is_valid(value: Column | str, kind: str) -> Column:
    return col(value).rlike(FORMATS[kind])


def count_in_text(text: Column | str, kind: str) -> Column:
    """Number of non-overlapping matches in the whole text; 0 for a NULL text."""
    matches = F.regexp_count(col(text), F.lit((IN_TEXT | IDS_IN_TEXT)[kind]))
    if kind in _NEEDED:
        matches = F.when(F.contains(col(text), F.lit(_NEEDED[kind])), matches)
    return F.coalesce(matches, F.lit(0)).cast("bigint")
