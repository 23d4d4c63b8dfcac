"""Filters behind the browsing screens."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.columns import named, present


def facets(
    df: DataFrame,
    choices: Mapping[str, Sequence[str]],
    search: str = "",
    search_column: str = "message",
) -> DataFrame:
    """Rows matching every non-empty choice and, if given, the text without case."""
    for column in present(df, choices):
        if choices[column]:
            df = df.filter(named(column).cast("string").isin(*choices[column]))
    if search and search_column in df.columns:
        df = df.filter(F.contains(F.lower(named(search_column)), F.lit(search.lower())))
    return df


def any_cell(df: DataFrame, term: str, pattern: bool = True) -> DataFrame:
    """Rows where some cell matches, without regard to case."""

    def hit(column: str) -> Column:
        text = named(column).cast("string")
        if pattern:
            return text.rlike("(?i)" + term)
        return F.contains(F.lower(text), F.lit(term.lower()))

    tests = [F.coalesce(hit(c), F.lit(False)) for c in df.columns]
    return df.filter(reduce(Column.__or__, tests))


def drill_down(
    rich: DataFrame,
    sources: Sequence[str],
    flag: str | None = None,
    risks: Sequence[str] = (),
    flag_column: str = "in_registry_flag",
    risk_column: str = "registry_risk_score",
) -> DataFrame:
    """Entities by source, flag and risk; entities without a risk stay in."""
    rows = rich.filter(named("source").isin(*sources))
    if flag is not None:
        rows = rows.filter(named(flag_column) == flag)
    if risks:
        risk = named(risk_column)
        rows = rows.filter(risk.isin(*risks) | risk.isNull())
    return rows


def preview(df: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first rows in a stated order, taken as a distributed top-n."""
    return df.orderBy(*map(named, order)).limit(rows)
