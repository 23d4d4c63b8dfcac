"""Naming columns exactly, and quoting names and values in SQL expressions.

Checks, repairs and injections are written as SQL expression text: a rule set turns
into a few hundred expressions, and building each from Column objects costs a call
into the JVM per operator, while text costs one call per expression.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def name_sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def list_sql(values: Iterable[str]) -> str:
    return ", ".join(map(text_sql, values))


def named(name: str) -> Column:
    """The column with exactly this name, dots and spaces included."""
    return F.col(name_sql(name))


def replaced(df: DataFrame, changes: Mapping[str, str]) -> DataFrame:
    """``df`` with some columns replaced or added, given as SQL expressions."""
    kept = [changes.get(c, name_sql(c)) + " AS " + name_sql(c) for c in df.columns]
    added = [sql + " AS " + name_sql(c) for c, sql in changes.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that ``df`` has, in the given order (case-sensitive)."""
    have = set(df.columns)
    return [name for name in names if name in have]


def missing(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [name for name in names if name not in have]


def type_of(df: DataFrame, name: str) -> T.DataType:
    for field in df.schema.fields:
        if field.name == name:
            return field.dataType
    raise KeyError(name)
