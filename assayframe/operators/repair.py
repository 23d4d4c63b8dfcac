"""Repairs of text tables in which blank means missing."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.columns import list_sql, name_sql, present, replaced, text_sql
from assayframe.functions.parse import blank_sql, date_sql
from assayframe.operators.rowid import BLOCK_ROWS, ROW_ID, occurrence
from assayframe.session import materialise

# Domains, defaults and placeholder texts of the standard plan.
STANDARD_DOMAINS = {
    "country": ("NL", "BE", "FR", "LU", "ES", "DE", "GB", "AT"),
    "activity_detail_status": (
        "Active in last 12 months", "Inactive >12 months", "Never transacted",
    ),
    "merchant_activity_status": ("Active", "Inactive"),
    "type_of_activity": ("CP", "CNP", "CP+CNP"),
    "contracting_method": ("F2F", "NF2F", "F2F+NF2F"),
    "contract_status": ("Active", "Cancelled", "ActiveBO", "Entered", "Terminated"),
}
STANDARD_DEFAULTS = {
    "country": "NL",
    "activity_detail_status": "Never transacted",
    "merchant_activity_status": "Inactive",
    "type_of_activity": "CP",
    "contracting_method": "F2F",
    "contract_status": "Active",
    "last_trx_date": "2026-05-01",
    "vintage_date": "2024-01-01",
    "legal_form": "UNKNOWN_LEGAL_FORM",
    "mcc": "5999",
    "vat_number": "UNKNOWN_VAT",
    "kvk_number": "UNKNOWN_KVK",
    "active_contracts": "1",
    "contract_category_descriptions": "UNKNOWN_CATEGORY",
}
STANDARD_DATES = ("last_trx_date", "vintage_date")
STANDARD_OPTIONAL = (
    "legal_form", "mcc", "vat_number", "kvk_number",
    "active_contracts", "contract_category_descriptions",
)
ID_PLACEHOLDER = "UNKNOWN_ID_"
NAME_PLACEHOLDER = "UNKNOWN_MERCHANT_"
REPEAT_MARK = "-DEDUP-"


@dataclass(frozen=True)
class RepairPlan:
    """Which columns are repaired and with what."""

    domains: Mapping[str, Sequence[str]] = field(default_factory=lambda: STANDARD_DOMAINS)
    defaults: Mapping[str, str] = field(default_factory=lambda: STANDARD_DEFAULTS)
    dates: Sequence[str] = STANDARD_DATES
    optional: Sequence[str] = STANDARD_OPTIONAL
    source: str = "source"
    id: str = "id"
    name: str = "name"
    key: str = "entity_key"
    row_id: str = ROW_ID
    block_rows: int = BLOCK_ROWS

    @classmethod
    def standard(cls, sources: Sequence[str], default_source: str) -> RepairPlan:
        """The standard plan for entities from the given sources."""
        return cls(
            domains={"source": tuple(sources), **STANDARD_DOMAINS},
            defaults={"source": default_source, **STANDARD_DEFAULTS},
        )

    def keyed(self, df: DataFrame) -> bool:
        return len(present(df, (self.source, self.id, self.key))) == 3

    def key_sql(self) -> str:
        return f"concat({name_sql(self.source)}, ':', {name_sql(self.id)})"


def padded_sql(number: str, width: int) -> str:
    """A number with leading zeros; longer numbers stay whole."""
    return f"lpad({number}, greatest({width}, length({number})), '0')"


def _blank_or(column: str, value: str) -> str:
    c = name_sql(column)
    return f"CASE WHEN {blank_sql(c)} THEN {value} ELSE {c} END"


def default_when_blank(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return replaced(df, {c: _blank_or(c, text_sql(defaults[c])) for c in present(df, defaults)})


def fill_missing(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """Placeholders for blank ids and names, defaults for blank statuses, keys last."""
    number = padded_sql(name_sql(plan.row_id), 6)
    filled = {plan.id: ID_PLACEHOLDER, plan.name: NAME_PLACEHOLDER}
    filled = {c: f"concat({text_sql(mark)}, {number})" for c, mark in filled.items()}
    filled |= {c: text_sql(plan.defaults[c]) for c in plan.domains}
    df = replaced(df, {c: _blank_or(c, filled[c]) for c in present(df, filled)})
    return replaced(df, {plan.key: _blank_or(plan.key, plan.key_sql())}) if plan.keyed(df) else df


def normalise_domains(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """Values outside their domain, blanks included, become the default."""

    def inside(c: str) -> str:
        kept = f"{name_sql(c)} IN ({list_sql(plan.domains[c])})"
        return f"CASE WHEN {kept} THEN {name_sql(c)} ELSE {text_sql(plan.defaults[c])} END"

    return replaced(df, {c: inside(c) for c in present(df, plan.domains)})


def repair_dates_and_optional(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """Unreadable or blank dates and blank optional fields become the default."""

    def dated(c: str) -> str:
        valid = f"{date_sql(name_sql(c))} IS NOT NULL"
        return f"CASE WHEN {valid} THEN {name_sql(c)} ELSE {text_sql(plan.defaults[c])} END"

    changes = {c: dated(c) for c in present(df, plan.dates)}
    changes |= {c: _blank_or(c, text_sql(plan.defaults[c])) for c in present(df, plan.optional)}
    return replaced(df, changes)


def _number_repeats(df: DataFrame, column: str, plan: RepairPlan) -> DataFrame:
    c = name_sql(column)
    suffix = f"concat({c}, {text_sql(REPEAT_MARK)}, {padded_sql('_nth', 3)})"
    numbered = occurrence(df, [column], plan.row_id, "_nth", plan.block_rows)
    return replaced(numbered, {column: f"CASE WHEN _nth > 0 THEN {suffix} ELSE {c} END"}).drop("_nth")


def repeated_keys(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """New id and key of the rows that need one: ``row_id``, ``old_`` and ``new_`` values.

    The old key is the one rebuilt from source and id.

    Second and later occurrences of an id, then of a key, get a numbered suffix; keys
    are rebuilt from source and id in between.  Only the key columns are shuffled, and
    the result, usually a small part of the table, is written so that its true size
    decides how it is joined.
    """
    columns = present(df, (plan.source, plan.id, plan.key))
    narrow = rebuilt_keys(df, plan).select(name_sql(plan.row_id), *map(name_sql, columns))
    pairs = {"id": plan.id, "key": plan.key}
    pairs = {new: c for new, c in pairs.items() if c in columns}
    fixed = replaced(narrow, {f"old_{new}": name_sql(c) for new, c in pairs.items()})  # rebuilt just before
    if plan.id in columns:
        fixed = rebuilt_keys(_number_repeats(fixed, plan.id, plan), plan)
    if plan.key in columns:
        fixed = _number_repeats(fixed, plan.key, plan)
    same = " AND ".join(f"{name_sql(c)} <=> old_{new}" for new, c in pairs.items())
    return materialise(
        fixed.filter(f"NOT ({same})").selectExpr(
            f"{name_sql(plan.row_id)} AS row_id",
            *[f"old_{new}" for new in pairs], *[f"{name_sql(c)} AS new_{new}" for new, c in pairs.items()]),
        "repeats")


def rebuilt_keys(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """Keys from source and id, where the table has all three."""
    return replaced(df, {plan.key: plan.key_sql()}) if plan.keyed(df) else df


def deduplicate_keys(df: DataFrame, plan: RepairPlan) -> DataFrame:
    """Make ids and keys unique, rebuilding the keys of all rows from source and id."""
    pairs = {c: f"coalesce(new_{new}, {name_sql(c)})"
             for new, c in (("id", plan.id), ("key", plan.key)) if c in df.columns}
    if not pairs:
        return df
    changes = repeated_keys(df, plan).select(F.col("row_id").alias(plan.row_id), *[
        f"new_{new}" for new, c in (("id", plan.id), ("key", plan.key)) if c in df.columns])
    joined = rebuilt_keys(df, plan).join(changes, plan.row_id, "left")
    return replaced(joined, pairs).select(*map(name_sql, df.columns))
