"""Repairs of text tables and the quality ladder."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from assayframe.catalog.base import Query, table, with_tables
from assayframe.catalog.oracle import quoted, results_sql, scores_sql, valid_date
from assayframe.functions.parse import NULL_TOKENS
from assayframe.operators import repair
from assayframe.operators.repair import RepairPlan
from assayframe.operators.rowid import with_row_id
from assayframe.plans import ladder
from assayframe.plans.entity_base import STORED_COLUMNS
from assayframe.rules import Rules

SOURCES = ("TERMINAL", "PARTNER")
PLAN = RepairPlan.standard(SOURCES, "PARTNER")
COLUMNS = STORED_COLUMNS
# The rules the published scores of such tables are based on: 29 checks.
RULES = Rules(
    required_columns=COLUMNS,
    non_null_columns=("source", "entity_key", "id", "name", "country", "activity_detail_status",
                      "merchant_activity_status", "type_of_activity", "contracting_method",
                      "contract_status"),
    unique_columns=("entity_key", "id"),
    date_columns=("last_trx_date", "vintage_date"),
    allowed_values={c: tuple(v) for c, v in PLAN.domains.items()},
    null_thresholds={"last_trx_date": 0.6, "mcc": 0.5, "vintage_date": 0.4, "legal_form": 0.98,
                     "vat_number": 0.01, "kvk_number": 0.25, "active_contracts": 0.85},
)


def dirty(spark, sf):
    """The dirty entities, numbered in order of position."""
    return with_row_id(table(spark, sf, "dirty_entities"), ["position"], plain_scan=True, keep=True).drop("position")


def _step(name):
    """The table after the named step."""
    repairs = ladder.REPAIRS[: ladder.STEPS.index(name)]
    return lambda spark, sf: reduce(
        lambda df, repair: repair(df, PLAN), repairs, dirty(spark, sf)).select("row_id", *COLUMNS)


def _ladder(spark, sf):
    summary = ladder.ladder_summary(dirty(spark, sf), PLAN, RULES)
    return summary.withColumn("failed_checks", F.array_join("failed_checks", "; "))



def _case(c: str) -> str:
    return f"CASE WHEN TRIM({c}) = '' THEN {quoted(PLAN.defaults[c])} ELSE {c} END"


def _step_sql(changes: dict[str, str], relation: str) -> str:
    return "SELECT row_id, " + ", ".join(
        f"{changes.get(c, c)} AS {c}" for c in COLUMNS) + f" FROM {relation}"


NUMBER = "LPAD(CAST(row_id AS VARCHAR), 6, '0')"
_FILLED = {
    "id": f"CASE WHEN TRIM(id) = '' THEN 'UNKNOWN_ID_' || {NUMBER} ELSE id END",
    "name": f"CASE WHEN TRIM(name) = '' THEN 'UNKNOWN_MERCHANT_' || {NUMBER} ELSE name END",
    **{c: _case(c) for c in PLAN.domains},
}
_IN_DOMAIN = {
    c: f"CASE WHEN {c} IN ({', '.join(map(quoted, PLAN.domains[c]))}) THEN {c} ELSE {quoted(PLAN.defaults[c])} END"
    for c in PLAN.domains
}
_DATED = {
    **{c: f"CASE WHEN {valid_date(c)} THEN {c} ELSE {quoted(PLAN.defaults[c])} END" for c in PLAN.dates},
    **{c: _case(c) for c in PLAN.optional},
}


def _suffixed(c: str) -> str:
    nth = f"(ROW_NUMBER() OVER (PARTITION BY {c} ORDER BY row_id) - 1)"
    return (f"CASE WHEN {nth} > 0 THEN {c} || '-DEDUP-' || CASE WHEN {nth} < 1000 THEN "
            f"LPAD(CAST({nth} AS VARCHAR), 3, '0') ELSE CAST({nth} AS VARCHAR) END ELSE {c} END")


STEP_SQL = (
    "WITH s0 AS (SELECT *, ROW_NUMBER() OVER (ORDER BY position) - 1 AS row_id FROM dirty_entities), "
    f"s1 AS ({_step_sql({'entity_key': '''CASE WHEN TRIM(entity_key) = '' THEN source || ':' || id ELSE entity_key END'''}, '(' + _step_sql(_FILLED, 's0') + ')')}), "
    f"s2 AS ({_step_sql(_IN_DOMAIN, 's1')}), s3 AS ({_step_sql(_DATED, 's2')}), "
    f"s4a AS ({_step_sql({'id': _suffixed('id')}, 's3')}), "
    f"s4b AS ({_step_sql({'''entity_key''': '''source || ':' || id'''}, 's4a')}), "
    f"s4 AS ({_step_sql({'entity_key': _suffixed('entity_key')}, 's4b')}) "
)
_BLANKS = ", ".join(map(quoted, NULL_TOKENS))


def _steps_union() -> str:
    parts = []
    for i, step in enumerate(ladder.STEPS):
        nulled = ", ".join(f"CASE WHEN {c} NOT IN ({_BLANKS}) THEN {c} END AS {c}" for c in COLUMNS)
        parts.append(f"SELECT '{step}' AS step, {nulled} FROM s{i}")
    return " UNION ALL ".join(parts)


_RESULTS = results_sql("steps", RULES, COLUMNS, by="step")
LADDER_SQL = STEP_SQL + f""", steps AS ({_steps_union()}), results AS ({_RESULTS}),
    scored AS ({scores_sql('SELECT * FROM results', 'step')}),
    failed AS (SELECT step, string_agg(check_name || ':' || column_name, '; ' ORDER BY seq) AS failed_checks
      FROM results WHERE status = 'FAIL' GROUP BY step)
    SELECT scored.*, COALESCE(failed_checks, '') AS failed_checks,
      COALESCE(round_even(quality_score - LAG(quality_score) OVER (ORDER BY step), 2), 0) AS score_delta,
      COALESCE(checks_failed - LAG(checks_failed) OVER (ORDER BY step), 0) AS failed_delta
    FROM scored LEFT JOIN failed USING (step)"""


def _columns(relation: str) -> str:
    return STEP_SQL + f"SELECT row_id, {', '.join(COLUMNS)} FROM {relation}"


QUERIES = {
    "repair_missing_fields": Query(_step(ladder.STEPS[1]), with_tables(_columns("s1"), "dirty_entities")),
    "repair_domains": Query(_step(ladder.STEPS[2]), with_tables(_columns("s2"), "dirty_entities")),
    "repair_dates_and_optional": Query(_step(ladder.STEPS[3]), with_tables(_columns("s3"), "dirty_entities")),
    "repair_repeated_keys": Query(_step(ladder.STEPS[4]), with_tables(_columns("s4"), "dirty_entities")),
    "repair_default_when_blank": Query(
        lambda spark, sf: repair.default_when_blank(
            table(spark, sf, "dirty_entities"), {"mcc": "5999", "name": "UNKNOWN", "absent": "x"}).select(
            "position", "mcc", "name"),
        with_tables("""SELECT position, CASE WHEN TRIM(mcc) = '' THEN '5999' ELSE mcc END AS mcc,
          CASE WHEN TRIM(name) = '' THEN 'UNKNOWN' ELSE name END AS name FROM dirty_entities""", "dirty_entities")),
    "ladder_scores": Query(_ladder, with_tables(LADDER_SQL, "dirty_entities")),
}
