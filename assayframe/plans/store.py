"""Stored tables: their schemas, and loading them from files and lookups."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from assayframe.columns import named, present
from assayframe.functions.parse import repair_double_encoding
from assayframe.operators.lookups import rejoin, split_by_key
from assayframe.plans.coverage import (
    FLAG, IDENTITY_COLUMNS, JOIN_KEY, LINK_COLUMNS, RISK_COLUMNS,
)
from assayframe.plans.entity_base import STORED_COLUMNS
from assayframe.sources.files import cast_columns, load_dataset, project
from assayframe.sources.sinks import replace_rows

REGISTRY_KEY = "registry_key"

# Free-text columns that may hold doubly encoded text, and the types of
# the columns that are not text.
TEXT_COLUMNS = ("name", "contract_category_descriptions")
TYPES = {
    "active_contracts": T.IntegerType(),
    "registry_watchlist_hit_pct": T.DoubleType(),
    "registry_embargo_hit_pct": T.DoubleType(),
    "registry_pep_hit_pct": T.DoubleType(),
    "registry_next_review_date": T.DateType(),
    "registry_ubo_count": T.IntegerType(),
    "registry_si_count": T.IntegerType(),
    "merchants": T.LongType(),
    "active_merchants": T.LongType(),
    "pct_of_source": T.DoubleType(),
    "generated_at": T.TimestampNTZType(),
}


def _schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, TYPES.get(c, T.StringType())) for c in columns])


SOURCE_TABLES = {
    "entity_base": _schema(*STORED_COLUMNS),
    "registry_identity": _schema(REGISTRY_KEY, *IDENTITY_COLUMNS),
    "registry_risk": _schema(REGISTRY_KEY, *RISK_COLUMNS),
    "registry_link": _schema(REGISTRY_KEY, *LINK_COLUMNS),
}
OUTPUT_TABLES = {
    "coverage_flag": _schema(*STORED_COLUMNS, FLAG, "generated_at"),
    "coverage_rich": _schema(
        *STORED_COLUMNS, FLAG, *IDENTITY_COLUMNS, *RISK_COLUMNS, *LINK_COLUMNS, "generated_at"),
    "coverage_summary": _schema(
        "source", FLAG, "merchants", "active_merchants", "pct_of_source", "generated_at"),
}
ALL_TABLES = {**SOURCE_TABLES, **OUTPUT_TABLES}


def mend_text(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    found = present(df, columns)
    return df.withColumns({c: repair_double_encoding(named(c)) for c in found}) if found else df


def load_base(spark: SparkSession, path: str, table: str, append: bool = False) -> int:
    """An entity file into its table; returns the rows written."""
    df = cast_columns(load_dataset(spark, path), {"active_contracts": "Int64"})
    return replace_rows(mend_text(project(df, STORED_COLUMNS)), table, append)


def split_lookup(lookup: DataFrame) -> dict[str, DataFrame]:
    """A combined lookup as identity, risk and link tables with one row per key."""
    keyed = lookup.withColumnRenamed(JOIN_KEY, REGISTRY_KEY)
    parts = {
        name: schema.names for name, schema in SOURCE_TABLES.items() if REGISTRY_KEY in schema.names
    }
    return split_by_key(keyed, REGISTRY_KEY, parts)


def load_lookup(lookup: DataFrame, tables: Mapping[str, str], append: bool = False) -> dict[str, int]:
    """The three parts of a lookup into their tables; returns the rows written."""
    parts = split_lookup(lookup)
    return {name: replace_rows(parts[name], table, append) for name, table in tables.items()}


def join_lookup(identity: DataFrame, risk: DataFrame, links: DataFrame) -> DataFrame:
    """The combined lookup from its three tables, one row per identity row."""
    return rejoin(identity, [risk, links], REGISTRY_KEY).withColumnRenamed(REGISTRY_KEY, JOIN_KEY)
