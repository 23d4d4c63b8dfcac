"""Defect injection and the score matrix."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import Query, table, with_tables
from assayframe.catalog.oracle import cycled_sql, quoted, results_sql, scores_sql
from assayframe.catalog.repair import COLUMNS, RULES, SOURCES, dirty
from assayframe.functions.parse import NULL_TOKENS
from assayframe.operators import inject
from assayframe.operators.inject import STANDARD_SCENARIOS, Scenario
from assayframe.operators.repair import STANDARD_DOMAINS
from assayframe.operators.rowid import head, with_row_id
from assayframe.plans import matrix

SCENARIOS = STANDARD_SCENARIOS
BY_NAME = {s.name: s for s in SCENARIOS}


def _scenario(name):
    def run(spark, sf):
        df = dirty(spark, sf)
        made = inject.build_scenario(df, BY_NAME[name], df.count())
        return made.select("row_id", *COLUMNS)
    return run


def _all(spark, sf):
    df = dirty(spark, sf)
    return inject.build_scenarios(df, SCENARIOS, df.count())


def _scored(spark, sf):
    df = dirty(spark, sf)
    return matrix.score_scenarios(df, SCENARIOS, df.count(), RULES)


def _valid(spark, sf):
    return inject.valid_baseline(dirty(spark, sf), SOURCES, 1).select("row_id", *COLUMNS)


def _part(spark, sf):
    return with_row_id(table(spark, sf, "part"), ["p_partkey"], plain_scan=True)


def _replicated(spark, sf):
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_id"), F.lit("C").alias("source"),
        F.col("c_custkey").cast("string").alias("id"), F.lit("").alias("entity_key"))
    return inject.replicate(df, 3, df.count())


def _baseline_sql(offset: int, relation: str) -> str:
    cycles = {"source": SOURCES, **STANDARD_DOMAINS, "legal_form": inject.LEGAL_FORMS,
              "mcc": inject.MCC_CODES, "contract_category_descriptions": inject.CATEGORIES}
    made = {c: cycled_sql("row_id", v, offset) for c, v in cycles.items()}
    day = "CAST(CAST(DATE '{}' + CAST((row_id * {}) % {} AS INTEGER) AS DATE) AS VARCHAR)"
    made |= {
        "last_trx_date": day.format(*inject.LAST_TRX),
        "vintage_date": day.format(*inject.VINTAGE),
        "active_contracts": "CAST(row_id % 5 + 1 AS VARCHAR)",
        "name": f"{cycled_sql('row_id', inject.NAMES, offset)} || ' ' || printf('%05d', row_id + 1)",
        "vat_number": f"'VAT' || printf('%09d', row_id + {inject.FIRST_VAT})",
        "kvk_number": f"printf('%08d', row_id + {inject.FIRST_KVK})",
        "entity_key": f"{made['source']} || ':' || id",
    }
    return "SELECT row_id, " + ", ".join(f"{made.get(c, c)} AS {c}" for c in COLUMNS) + f" FROM {relation}"


def scenario_sql(s: Scenario) -> str:
    """The scenario as nested SQL, one defect after the other."""
    sql = f"SELECT row_id, {', '.join(COLUMNS)} FROM s0"
    n = "(SELECT COUNT(*) FROM s0)"
    if s.copies:
        others = ", ".join(c for c in COLUMNS if c not in ("id", "entity_key"))
        suffix = "'-B' || LPAD(CAST(k AS VARCHAR), 2, '0')"
        sql = (f"SELECT row_id + (k - 1) * {n} AS row_id, {others}, id || {suffix} AS id, "
               f"source || ':' || id || {suffix} AS entity_key FROM ({sql}), range(1, {s.copies + 1}) t(k)")
    for d in s.defects:
        value = cycled_sql(f"row_id - {d.start}", d.values, d.offset)
        changed = f"CASE WHEN row_id BETWEEN {d.start} AND {d.stop} THEN {value} ELSE {d.column} END"
        sql = f"SELECT * REPLACE ({changed} AS {d.column}) FROM ({sql})"
    if s.repeat_head:
        total = f"{n} * {max(s.copies, 1)}"
        sql = (f"SELECT * FROM ({sql}) UNION ALL BY NAME SELECT * REPLACE (row_id + {total} AS row_id) "
               f"FROM ({sql}) WHERE row_id < {s.repeat_head}")
    return f"SELECT row_id, {', '.join(COLUMNS)} FROM ({sql})"


_S0 = "WITH s0 AS (SELECT *, ROW_NUMBER() OVER (ORDER BY position) - 1 AS row_id FROM dirty_entities) "


def _one(name):
    return with_tables(_S0 + scenario_sql(BY_NAME[name]), "dirty_entities")


_TOKENS = ", ".join(map(quoted, NULL_TOKENS))
_NULLED = ", ".join(f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END AS {c}" for c in COLUMNS)
_EVERY = " UNION ALL ".join(
    f"SELECT '{s.name}' AS scenario, {_NULLED} FROM ({scenario_sql(s)})" for s in SCENARIOS)
_RESULTS = results_sql("every_row", RULES, COLUMNS, by="scenario")
MATRIX_SQL = _S0 + f""", every_row AS ({_EVERY}), results AS ({_RESULTS})
    {scores_sql('SELECT * FROM results', 'scenario')}"""
MANIFEST_SQL = _S0 + f""", every_row AS ({_EVERY})
    SELECT scenario AS name, COUNT(*) AS "rows", CAST({len(COLUMNS)} AS BIGINT) AS columns FROM every_row GROUP BY scenario"""

QUERIES = {
    "head_rows": Query(
        lambda spark, sf: head(_part(spark, sf), 75),
        "SELECT *, p_partkey AS row_id FROM part WHERE p_partkey < 75"),
    "inject_cycle": Query(
        lambda spark, sf: inject.set_cycled(_part(spark, sf), {"p_type": ("A", "B", "C")}, 2),
        f"""SELECT * REPLACE ({cycled_sql('p_partkey', ('A', 'B', 'C'), 2)} AS p_type), p_partkey AS row_id FROM part"""),
    "inject_cycle_range": Query(
        lambda spark, sf: inject.apply_defects(_part(spark, sf), [
            inject.Defect("p_brand", 10, 150, ("x", "y", "z"), 1), inject.Defect("p_brand", 100, 120, ("w",))]),
        f"""SELECT * REPLACE (CASE WHEN p_partkey BETWEEN 100 AND 120 THEN 'w' WHEN p_partkey BETWEEN 10 AND 150
        THEN {cycled_sql('p_partkey - 10', ('x', 'y', 'z'), 1)} ELSE p_brand END AS p_brand), p_partkey AS row_id FROM part"""),
    "inject_blank": Query(
        lambda spark, sf: inject.apply_defects(_part(spark, sf), [inject.Defect("p_name", 0, 24)]),
        """SELECT * REPLACE (CASE WHEN p_partkey <= 24 THEN '' ELSE p_name END AS p_name), p_partkey AS row_id FROM part"""),
    "inject_dates": Query(
        lambda spark, sf: _part(spark, sf).select(
            "p_partkey", F.expr(inject.stepped_date_sql("row_id", "2025-01-03", 5, 520)).alias("day")),
        """SELECT p_partkey, CAST(CAST(DATE '2025-01-03' + CAST((p_partkey * 5) % 520 AS INTEGER) AS DATE) AS VARCHAR) AS day
        FROM part"""),
    "replicate_rows": Query(_replicated, """
        SELECT c_custkey + (k - 1) * (SELECT COUNT(*) FROM customer) AS row_id, 'C' AS source,
          CAST(c_custkey AS VARCHAR) || '-B0' || k AS id, 'C:' || c_custkey || '-B0' || k AS entity_key
        FROM customer, range(1, 4) t(k)"""),
    "valid_baseline": Query(_valid, with_tables(_S0 + _baseline_sql(1, "s0"), "dirty_entities")),
    "scenario_control": Query(_scenario("control"), _one("control")),
    "scenario_missing_critical": Query(_scenario("missing_critical"), _one("missing_critical")),
    "scenario_duplicate_keys": Query(_scenario("duplicate_keys"), _one("duplicate_keys")),
    "scenario_invalid_domains": Query(_scenario("invalid_domains"), _one("invalid_domains")),
    "scenario_invalid_dates": Query(_scenario("invalid_dates"), _one("invalid_dates")),
    "scenario_null_breach": Query(_scenario("null_threshold_breach"), _one("null_threshold_breach")),
    "scenario_large_volume": Query(_scenario("large_volume"), _one("large_volume")),
    "scenario_mixed_extreme": Query(_scenario("mixed_extreme"), _one("mixed_extreme")),
    "scenario_manifest": Query(
        lambda spark, sf: matrix.manifest(_all(spark, sf)), with_tables(MANIFEST_SQL, "dirty_entities")),
    "scenario_matrix": Query(_scored, with_tables(MATRIX_SQL, "dirty_entities")),
}
