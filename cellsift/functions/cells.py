"""Column expressions for single cells. All stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts a CSV reader takes for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Severity of a finding as a score, and the score bands.
SEVERITY_SCORES = {"low": 0.1, "medium": 0.4, "high": 0.7, "critical": 1.0}
SEVERITY_BANDS = ((1.0, "critical"), (0.5, "high"), (0.2, "medium"))

# Unicode blanks plus the four ASCII separators Java leaves out of \s.
_BLANK = r"\s\x1c-\x1f"
_NON_BLANK_CHAR = rf"(?U)[^{_BLANK}]"
_EDGE_BLANKS = rf"(?U)^[{_BLANK}]+|[{_BLANK}]+$"
_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)\s*$"

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)
FLOAT_TYPES = (T.DoubleType, T.FloatType)


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, TEXT_TYPES)


def is_blank(c: Column) -> Column:
    """True for text without any visible character; null for null."""
    return ~c.rlike(_NON_BLANK_CHAR)


def blank_to_null(c: Column) -> Column:
    return F.when(c.rlike(_NON_BLANK_CHAR), c)


def na_token_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_BLANKS, "")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def finite(c: Column) -> Column:
    """Null for NaN and infinity: one such cell would spoil every mean."""
    return F.when(F.abs(c) < float("inf"), c)


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Double of a cell, null where the cell is no finite number. NaN counts as null."""
    if is_text(dtype):
        return finite(F.when(c.rlike(_NUMBER), c.try_cast("double")))
    if isinstance(dtype, FLOAT_TYPES):
        return finite(c.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def is_missing(c: Column, dtype: T.DataType) -> Column:
    """Never null: true for null, NaN and blank text."""
    # Each check names the cell once: Spark copies the expression behind a
    # derived column to every place that names it when it moves a filter down.
    if is_text(dtype):
        return ~F.coalesce(c.rlike(_NON_BLANK_CHAR), F.lit(False))
    if isinstance(dtype, FLOAT_TYPES):
        return nan_to_null(c).isNull()
    return c.isNull()


def to_date(c: Column, dtype: T.DataType, formats: Iterable[str]) -> Column:
    """Timestamp without zone of a cell, null where no format fits.

    The format ``excel_serial`` reads day numbers of spreadsheets.
    """
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp_ntz")
    text = strip(c.cast("string"))
    parsed = []
    for fmt in formats:
        if fmt == "excel_serial":
            days = F.when(text.rlike(r"^\d{1,6}(\.0*)?$"), text.try_cast("double").cast("int"))
            stamp = F.date_add(F.lit("1899-12-30").cast("date"), days)
        else:
            stamp = F.try_to_timestamp(text, F.lit(fmt))
        parsed.append(stamp.cast("timestamp_ntz"))
    return F.coalesce(*parsed)


def canonical_text(c: Column, synonyms: Mapping[str, str] | None = None) -> Column:
    """Strip, upper-case and replace synonyms; null stays null."""
    text = F.upper(strip(c))
    if not synonyms:
        return text
    pairs = F.create_map(*[F.lit(x) for pair in synonyms.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, text), text)


def ratio(value: Column, count: Column) -> Column:
    """Value per count, null for a count of zero."""
    return F.try_divide(value, count)


def severity_of(score: Column) -> Column:
    """Band of a severity score; a score that cannot be computed is low."""
    out = F.lit("low")
    for floor, name in reversed(SEVERITY_BANDS):
        out = F.when(score >= floor, name).otherwise(out)
    return out


def clamp(c: Column) -> Column:
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)), 4)
