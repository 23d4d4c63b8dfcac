"""Tolerant parsing: missing values, numbers, dates, damaged text.

Functions ending in ``_sql`` take an SQL expression and return one; the others are
their Column forms.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.columns import list_sql, text_sql

# The texts a CSV reader with default settings takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Accepted number and date grammar, and the nanosecond date range.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
INFINITY_PATTERN = r"(?i)^\s*[+-]?inf(inity)?\s*$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
FIRST_DATE = "1677-09-22"
LAST_DATE = "2262-04-11"


def is_floating(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def missing_sql(c: str, kind: T.DataType) -> str:
    """NULL, and NaN where the type has it.  Empty text is data, not missing."""
    return f"({c} IS NULL OR isnan({c}))" if is_floating(kind) else f"({c} IS NULL)"


def blank_sql(c: str) -> str:
    """Missing, empty or only white space."""
    return f"(NOT coalesce(CAST({c} AS STRING), '') RLIKE '(?U)\\\\S')"


def null_tokens_sql(c: str, tokens: tuple[str, ...] = NULL_TOKENS) -> str:
    return f"CASE WHEN {c} NOT IN ({list_sql(tokens)}) THEN {c} END"


def number_sql(c: str, kind: T.DataType) -> str:
    """A double, or NULL where the value is not a number.

    The pattern guards the cast: Spark alone would read ``'1d'`` as 1.0.
    """
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return f"nullif(CAST({c} AS DOUBLE), double('NaN'))"
    text = f"CAST({c} AS STRING)"
    value = f"try_cast(trim({text}) AS DOUBLE)"
    return (
        f"CASE WHEN {text} RLIKE {text_sql(NUMBER_PATTERN)} AND abs({value}) < double('Infinity')"
        f" OR {text} RLIKE {text_sql(INFINITY_PATTERN)} THEN {value} END"
    )


def positive_sql(c: str, kind: T.DataType) -> str:
    """True for numbers above zero, false for everything else including NULL."""
    return f"coalesce({number_sql(c, kind)} > 0, false)"


def date_sql(c: str) -> str:
    """The date written as year-month-day, or NULL."""
    text = f"CAST({c} AS STRING)"
    day = f"try_to_date(CASE WHEN {text} RLIKE {text_sql(DATE_PATTERN)} THEN {text} END, 'yyyy-M-d')"
    return f"CASE WHEN {day} BETWEEN DATE'{FIRST_DATE}' AND DATE'{LAST_DATE}' THEN {day} END"


def valid_date_sql(c: str, kind: T.DataType) -> str:
    """True for calendar dates; columns that already hold dates are always valid."""
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"({c} IS NOT NULL)"
    return f"({date_sql(c)} IS NOT NULL)"


def is_blank(c: str) -> Column:
    return F.expr(blank_sql(c))


def null_tokens_to_null(c: str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    return F.expr(null_tokens_sql(c, tokens))


def to_number(c: str, kind: T.DataType) -> Column:
    return F.expr(number_sql(c, kind))


def is_positive(c: str, kind: T.DataType) -> Column:
    return F.expr(positive_sql(c, kind))


def to_date(c: str) -> Column:
    return F.expr(date_sql(c))


def blank_to_null(col: Column) -> Column:
    """Trimmed text, with blanks as NULL."""
    return F.nullif(F.trim(col), F.lit(""))


def zero_text_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit("0"))


def date_from_key(col: Column) -> Column:
    """``20260513`` as an integer or text to a date; anything else to NULL."""
    return F.try_to_date(col.cast("string"), "yyyyMMdd")


def date_from_text_key(col: Column) -> Column:
    """The same for padded text where blanks mean no date."""
    return F.try_to_date(blank_to_null(col), "yyyyMMdd")


def repair_double_encoding(col: Column) -> Column:
    """Undo UTF-8 text that was once read as Latin-1, leaving all other text alone.

    The pattern comes first: only text that fits Latin-1 may reach ``encode``.
    """
    raw = F.encode(F.when(col.rlike(r"^[\x{00}-\x{FF}]*$"), col), "ISO-8859-1")
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), col)
