"""Declared schemas with required columns, checked row by row on the way into a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

REASONS = "_reasons"


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True
    comment: str = ""


@dataclass(frozen=True)
class Contract:
    """Columns a table is declared to have. ``Contract.of("id int!", "note string")``: ``!`` means required."""

    fields: tuple[Field, ...]

    @staticmethod
    def of(*columns: str, comments: dict[str, str] | None = None) -> Contract:
        fields = []
        for c in columns:
            name, kind = c.split(maxsplit=1)
            fields.append(Field(name, kind.rstrip("!").strip(), kind.endswith("!"), (comments or {}).get(name, "")))
        return Contract(tuple(fields))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self) -> T.StructType:
        """The declared schema, with nullability and comments."""
        return T.StructType([
            T.StructField(f.name, T.DataType.fromDDL(f.type), not f.required, {"comment": f.comment} if f.comment else None)
            for f in self.fields
        ])

    def raw_schema(self, corrupt: str | None = None) -> T.StructType:
        """All columns as text, as they lie in a landing file."""
        fields = [T.StructField(f.name, T.StringType()) for f in self.fields]
        if corrupt:
            fields.append(T.StructField(corrupt, T.StringType()))
        return T.StructType(fields)


def _same_type(df: DataFrame, field: Field) -> bool:
    return df.schema[field.name].dataType == T.DataType.fromDDL(field.type)


def typed(df: DataFrame, field: Field) -> Column:
    """The column in its declared type, NULL where the value does not convert."""
    return F.col(field.name) if _same_type(df, field) else F.col(field.name).try_cast(field.type)


def _require_columns(df: DataFrame, contract: Contract) -> None:
    missing = [name for name in contract.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the data: {missing}")


def judged(df: DataFrame, contract: Contract, keep: Sequence[str] = (), corrupt: str | None = None) -> DataFrame:
    """Declared columns in declared types plus ``_reasons``: why the row breaks the contract, empty if it holds.

    One projection, nothing is moved. ``keep`` names further columns to carry along. ``corrupt`` names the
    column in which the reader left lines with too few or too many fields.
    """
    _require_columns(df, contract)
    reasons = [F.when(F.col(corrupt).isNotNull(), F.lit("line does not fit"))] if corrupt else []
    for f in contract.fields:
        given, value = F.col(f.name), typed(df, f)
        if not _same_type(df, f):
            reasons.append(F.when(given.isNotNull() & value.isNull(), F.lit(f"{f.name} is not {f.type}")))
        if f.required:
            reasons.append(F.when(given.isNull(), F.lit(f"{f.name} is null")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    return df.select(*[typed(df, f).alias(f.name) for f in contract.fields], *keep, found.alias(REASONS))


def enforce(df: DataFrame, contract: Contract, corrupt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the contract, typed; and the other rows as given, with ``_reasons``."""
    _require_columns(df, contract)
    given = [*contract.names, corrupt] if corrupt else contract.names
    both = judged(df.withColumn("__raw", F.struct(*given)), contract, ["__raw"], corrupt)
    good = both.where(F.size(REASONS) == 0).select(*contract.names)
    quarantine = both.where(F.size(REASONS) > 0).select("__raw.*", REASONS)
    return good, quarantine


def enforce_strict(df: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows; the job fails on the first row that breaks the contract."""
    both = judged(df, contract)
    message = F.concat(F.lit("contract broken: "), F.array_join(REASONS, "; "))
    held = F.when(F.size(REASONS) == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return both.where(held).select(*contract.names)
