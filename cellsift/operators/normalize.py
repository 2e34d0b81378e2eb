"""Bring a raw table into the form the rules expect. Row-local, streaming-safe."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsift.functions import cells
from cellsift.operators.ranking import row_positions
from cellsift.spec import QualitySpec

# Upper-case headers of raw bank tables and the misspelt domain.
BANK_COLUMNS = {
    "DATE": "date",
    "DOMAIN": "domain",
    "LOCATION": "location",
    "VALUE": "value",
    "TRANSACTION_COUNT": "transaction_count",
}
BANK_SYNONYMS = {"RESTRAUNT": "RESTAURANT"}


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Null for blank text cells, and for NaN, in every column."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if cells.is_text(f.dataType):
            c = cells.blank_to_null(c)
        elif isinstance(f.dataType, cells.FLOAT_TYPES):
            c = cells.nan_to_null(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    """Null for the texts a CSV reader takes for "no value"."""
    return df.select(
        *[
            cells.na_token_to_null(F.col(f"`{f.name}`")).alias(f.name)
            if cells.is_text(f.dataType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by exact name; a target that already exists stays as it is."""
    present = set(df.columns)
    return df.withColumnsRenamed(
        {old: new for old, new in names.items() if old in present and new not in present}
    )


def coerce_types(df: DataFrame, spec: QualitySpec) -> DataFrame:
    """Numeric and date columns of the spec in their type, null where unreadable."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changes = {}
    for name, rule in spec.rules.items():
        if name not in types:
            continue
        if rule.dtype == "numeric":
            changes[name] = cells.to_number(F.col(name), types[name])
        elif rule.dtype == "date":
            changes[name] = cells.to_date(F.col(name), types[name], rule.date_formats)
    return df.withColumns(changes) if changes else df


def canonicalize(
    df: DataFrame,
    upper: Sequence[str] = (),
    trim: Sequence[str] = (),
    synonyms: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    synonyms = synonyms or {}
    changes = {c: cells.canonical_text(F.col(c).cast("string"), synonyms.get(c)) for c in upper}
    changes.update({c: cells.strip(F.col(c).cast("string")) for c in trim})
    changes = {c: e for c, e in changes.items() if c in df.columns}
    return df.withColumns(changes) if changes else df


def calendar_parts(df: DataFrame, column: str = "date") -> DataFrame:
    """Year, month, day and day of week (Monday 0) of a date column."""
    c = F.col(column)
    return df.withColumns(
        {
            "year": F.year(c),
            "month": F.month(c),
            "day": F.dayofmonth(c),
            "day_of_week": F.weekday(c),
        }
    )


def bank_features(df: DataFrame, date_formats: Sequence[str] | None = None) -> DataFrame:
    """Canonical names, texts, types, calendar parts and the average per transaction."""
    df = rename_present(df, BANK_COLUMNS)
    df = canonicalize(df, upper=["domain"], trim=["location"], synonyms={"domain": BANK_SYNONYMS})
    types = {f.name: f.dataType for f in df.schema.fields}
    if "date" in types:
        formats = date_formats or ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")
        df = df.withColumn("date", cells.to_date(F.col("date"), types["date"], formats))
        df = calendar_parts(df, "date")
    numbers = [c for c in ("value", "transaction_count") if c in types]
    if numbers:
        df = df.withColumns({c: cells.to_number(F.col(c), types[c]) for c in numbers})
    if len(numbers) == 2:
        df = df.withColumn(
            "avg_transaction_value", cells.ratio(F.col("value"), F.col("transaction_count"))
        )
    return df


def with_surrogate_key(df: DataFrame, id_column: str, order_by: Sequence[str] = ()) -> DataFrame:
    """``T00000000``-style keys by row position, first column, only if absent."""
    if id_column in df.columns:
        return df
    ranked = row_positions(df, "_position", order_by)
    return ranked.select(
        F.format_string("T%08d", F.col("_position")).alias(id_column), *df.columns
    )


def prepare_bank_table(df: DataFrame, spec: QualitySpec, **kwargs) -> DataFrame:
    """Everything a raw bank table needs before its rules can be checked."""
    return with_surrogate_key(bank_features(blanks_to_null(df), **kwargs), spec.id_column)
