"""Defects put into an ordered table on purpose, to try rules out.

Positions are row ids 0..n-1 (see ``with_row_id``).  A defect rewrites one column on
a range of rows; a scenario is an ordered list of defects, so later ones win.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from assayframe.columns import list_sql, name_sql, present, replaced, text_sql
from assayframe.operators.repair import STANDARD_DOMAINS, padded_sql
from assayframe.operators.rowid import ROW_ID

# Valid values to cycle through, invalid values, and number formats.
LEGAL_FORMS = ("BV", "NV", "GMBH", "SARL", "SA", "LTD", "SAS", "SOLE_TRADER")
MCC_CODES = ("5411", "5812", "5999", "5732", "7011", "7999", "4121", "4900")
CATEGORIES = (
    "Retail payments", "Hospitality terminals", "Digital commerce",
    "Travel services", "Public sector", "Mobility services",
)
NAMES = (
    "Northstar Market", "Blue Harbor Cafe", "Atlas Mobility", "Greenline Retail",
    "Pixel Commerce", "Urban Travel Hub", "Nova Pharmacy", "Lumen Services",
)
INVALID = {
    "source": ("LEGACY", "MANUAL_IMPORT", "CSV_EXPORT", "UNKNOWN_SOURCE"),
    "country": ("ZZ", "XX", "EU", "BENELUX"),
    "activity_detail_status": ("Active-ish", "Dormant?", "Recently-ish"),
    "merchant_activity_status": ("Maybe", "Paused", "Pending review"),
    "type_of_activity": ("MAIL_ORDER", "QR_ONLY", "TERMINAL_UNKNOWN", "ECOM_ONLY"),
    "contracting_method": ("REMOTE_UNKNOWN", "API_ONBOARDING", "PARTNER_PORTAL"),
    "contract_status": ("Frozen", "Suspended?", "Archived"),
}
INVALID_DATES = ("2026-99-99", "not-a-date", "31/31/2026", "1900-00-00")
BLANK = ("",)
LAST_TRX = ("2025-01-03", 5, 520)
VINTAGE = ("2021-02-01", 17, 1800)
FIRST_VAT = 800_000_000
FIRST_KVK = 70_000_000


@dataclass(frozen=True)
class Defect:
    """Rows ``start`` to ``stop`` (both included) of ``column`` cycle through ``values``."""

    column: str
    start: int
    stop: int
    values: Sequence[str] = BLANK
    offset: int = 0


@dataclass(frozen=True)
class Scenario:
    name: str
    copies: int = 0                  # copies of every row, each with its own id suffix
    defects: Sequence[Defect] = field(default_factory=tuple)
    repeat_head: int = 0             # first rows appended once more at the end


def cycled_sql(position: str, values: Sequence[str], offset: int | str = 0) -> str:
    place = f"CAST(pmod({position} + {offset}, {len(values)}) AS INT) + 1"
    return f"element_at(array({list_sql(values)}), {place})"


def set_cycled(df: DataFrame, values: Mapping[str, Sequence[str]], offset: int = 0,
               row_id: str = ROW_ID) -> DataFrame:
    return replaced(df, {
        c: cycled_sql(name_sql(row_id), values[c], offset) for c in present(df, values)
    })


def _cases(defects: Sequence[Defect], row: str, where: str = "") -> dict[str, list[str]]:
    """CASE branches per column; the defect listed last comes first and so wins."""
    cases: dict[str, list[str]] = {}
    for d in reversed(defects):
        value = cycled_sql(f"({row} - {d.start})", d.values, d.offset)
        cases.setdefault(d.column, []).append(
            f"WHEN {where}{row} BETWEEN {d.start} AND {d.stop} THEN {value}")
    return cases


def _rewritten(df: DataFrame, cases: Mapping[str, Sequence[str]]) -> DataFrame:
    return replaced(df, {
        c: f"CASE {' '.join(cases[c])} ELSE {name_sql(c)} END" for c in present(df, cases)
    })


def apply_defects(df: DataFrame, defects: Sequence[Defect], row_id: str = ROW_ID) -> DataFrame:
    """All defects as one expression per column; the last defect that covers a row wins."""
    return _rewritten(df, _cases(defects, name_sql(row_id)))


def stepped_date_sql(row: str, first: str, step: int, cycle: int) -> str:
    return f"CAST(date_add(DATE'{first}', CAST(pmod({row} * {step}, {cycle}) AS INT)) AS STRING)"


def valid_baseline(df: DataFrame, sources: Sequence[str], offset: int | str = 0,
                   row_id: str = ROW_ID) -> DataFrame:
    """Overwrite the known columns with varied values that all pass the rules.

    ``offset`` shifts the cycles: a number, or the name of a column that holds it.
    """
    row = name_sql(row_id)
    cycles = {
        "source": tuple(sources),
        **STANDARD_DOMAINS,
        "legal_form": LEGAL_FORMS,
        "mcc": MCC_CODES,
        "contract_category_descriptions": CATEGORIES,
    }
    made = {c: cycled_sql(row, values, offset) for c, values in cycles.items()}
    made |= {
        "last_trx_date": stepped_date_sql(row, *LAST_TRX),
        "vintage_date": stepped_date_sql(row, *VINTAGE),
        "active_contracts": f"CAST(pmod({row}, 5) + 1 AS STRING)",
        "name": f"concat({cycled_sql(row, NAMES, offset)}, ' ', {padded_sql(f'({row} + 1)', 5)})",
        "vat_number": f"concat('VAT', {padded_sql(f'({row} + {FIRST_VAT})', 9)})",
        "kvk_number": padded_sql(f"({row} + {FIRST_KVK})", 8),
    }
    return rekey(replaced(df, {c: made[c] for c in present(df, made)}))


def rekey(df: DataFrame, key: str = "entity_key", where: str = "true") -> DataFrame:
    if len(present(df, ("source", "id", key))) == 3:
        df = replaced(df, {key: f"if({where}, concat(source, ':', id), {key})"})
    return df


def copied_sql(column: str, copy: str) -> str:
    """An id with the suffix of its copy: ``-B01``, ``-B02``…"""
    return f"concat({name_sql(column)}, '-B', {padded_sql(f'CAST({copy} AS STRING)', 2)})"


def replicate(df: DataFrame, copies: int | str, rows: int | str, row_id: str = ROW_ID) -> DataFrame:
    """Each row ``copies`` times with ids suffixed ``-B01``, ``-B02``…, without a shuffle.

    ``rows`` is the table's row count: copy k continues numbering after copy k-1.
    Where ``copies`` (a number or a column) is 0 the row stays as it is.
    """
    copied = df.selectExpr("*", f"explode(sequence(1, greatest({copies}, 1))) AS _copy")
    return rekey(replaced(copied, {
        "id": f"if({copies} > 0, {copied_sql('id', '_copy')}, id)",
        row_id: f"{name_sql(row_id)} + (_copy - 1) * CAST({rows} AS BIGINT)",
    }).drop("_copy"), where=f"{copies} > 0")


def append_head(df: DataFrame, count: int | str, rows: int | str, row_id: str = ROW_ID) -> DataFrame:
    """The first ``count`` rows once more, numbered after the last of ``rows`` rows.

    Rows are doubled where they stand, so the table is read once and not shuffled.
    """
    row = name_sql(row_id)
    others = [name_sql(c) for c in df.columns if c != row_id]
    return df.selectExpr(
        *others,
        f"explode(if({row} < {count}, array({row}, {row} + {rows}), array({row}))) AS {row}",
    ).select(*map(name_sql, df.columns))


def defect_cases(scenarios: Sequence[Scenario], row: str, name: str) -> dict[str, list[str]]:
    """CASE branches per column for rows labelled with their scenario."""
    cases: dict[str, list[str]] = {}
    for s in scenarios:
        for column, branches in _cases(s.defects, row, f"{name} = {text_sql(s.name)} AND ").items():
            cases.setdefault(column, []).extend(branches)
    return cases


def build_scenarios(df: DataFrame, scenarios: Sequence[Scenario], rows: int,
                    row_id: str = ROW_ID, name: str = "scenario") -> DataFrame:
    """All scenarios over the rows of an ordered table of ``rows`` rows, from one scan.

    Every row is emitted once per scenario together with that scenario's settings;
    copies, defects and repeated rows are then row-level expressions.
    """
    row = name_sql(row_id)
    settings = ", ".join(
        f"struct({text_sql(s.name)} AS {name}, {s.copies} AS _copies, {s.repeat_head} AS _head)"
        for s in scenarios)
    made = df.selectExpr("*", f"inline(array({settings}))")
    made = replicate(made, "_copies", rows, row_id)
    made = append_head(_rewritten(made, defect_cases(scenarios, row, name)), "_head", f"{rows}L * greatest(_copies, 1)", row_id)
    return made.drop("_copies", "_head")


def build_scenario(df: DataFrame, scenario: Scenario, rows: int, row_id: str = ROW_ID) -> DataFrame:
    """One scenario over an ordered table of ``rows`` rows."""
    return build_scenarios(df, [scenario], rows, row_id, "_scenario").drop("_scenario")


def _invalid(column: str, start: int, stop: int) -> Defect:
    return Defect(column, start, stop, INVALID[column])


# The standard scenarios and the rows their defects cover.
CONTROL = Scenario("control")
MISSING_CRITICAL = Scenario("missing_critical", defects=(
    Defect("name", 0, 24),
    Defect("country", 25, 49),
    Defect("type_of_activity", 50, 74),
    Defect("contracting_method", 75, 99),
    Defect("contract_status", 100, 124),
))
DUPLICATE_KEYS = Scenario("duplicate_keys", repeat_head=75)
INVALID_DOMAINS = Scenario("invalid_domains", defects=(
    _invalid("source", 0, 24),
    _invalid("country", 25, 49),
    _invalid("activity_detail_status", 50, 74),
    _invalid("merchant_activity_status", 75, 99),
    _invalid("type_of_activity", 100, 124),
    _invalid("contracting_method", 125, 149),
    _invalid("contract_status", 150, 174),
))
INVALID_DATE_VALUES = Scenario("invalid_dates", defects=(
    Defect("last_trx_date", 0, 39, INVALID_DATES),
    Defect("vintage_date", 40, 79, INVALID_DATES, 1),
    Defect("last_trx_date", 80, 119, INVALID_DATES, 2),
    Defect("vintage_date", 120, 159, INVALID_DATES, 3),
))
NULL_BREACH = Scenario("null_threshold_breach", defects=(
    Defect("mcc", 0, 1399),
    Defect("vintage_date", 0, 1199),
    Defect("legal_form", 0, 1899),
    Defect("last_trx_date", 0, 999),
))
LARGE_VOLUME = Scenario("large_volume", copies=5)
MIXED_EXTREME = Scenario("mixed_extreme", copies=3, repeat_head=100, defects=(
    Defect("name", 0, 99),
    _invalid("country", 100, 199),
    _invalid("source", 200, 299),
    Defect("last_trx_date", 300, 399, INVALID_DATES),
    Defect("vintage_date", 400, 499, INVALID_DATES, 1),
    _invalid("type_of_activity", 500, 649),
    _invalid("contracting_method", 650, 799),
    _invalid("contract_status", 800, 899),
    _invalid("activity_detail_status", 900, 999),
    _invalid("merchant_activity_status", 1000, 1099),
    Defect("mcc", 1100, 1499),
    Defect("active_contracts", 0, 10999),
    Defect("legal_form", 0, 11899),
    Defect("vintage_date", 1200, 5199),
))
STANDARD_SCENARIOS = (
    CONTROL, MISSING_CRITICAL, DUPLICATE_KEYS, INVALID_DOMAINS,
    INVALID_DATE_VALUES, NULL_BREACH, LARGE_VOLUME, MIXED_EXTREME,
)
