"""Entities against the registry."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assayframe.catalog.base import Query, REPORTING_DATE, table, with_tables
from assayframe.catalog.oracle import report_sql
from assayframe.functions import keys
from assayframe.operators import filters, lookups
from assayframe.operators.frequency import distinct_beside_count
from assayframe.plans import coverage
from assayframe.plans.validate import store_and_validate
from assayframe.rules import Rules
from assayframe.session import materialise, scratch_path
from assayframe.sources.sinks import create_tables, drop_tables

LOAD_DATE = "1997-06-01"
RUN_TS = "2001-06-30 12:00:00"
CUTS = (("source", "merchant_activity_status"), ("source", "contract_status"))
CAUSE_CUTS = (*CUTS, ("source", "onboarded_after_load"), ("contract_status",))


def _base(spark, sf):
    return table(spark, sf, "entities")


def _keys(spark, sf):
    return coverage.registry_keys(table(spark, sf, "registry_rows"), "SYS")


def _flagged(spark, sf):
    return coverage.flagged(_base(spark, sf), _keys(spark, sf))


def _unmatched(spark, sf):
    return coverage.unmatched(_base(spark, sf), _keys(spark, sf))


def _rich(spark, sf, **options):
    return coverage.enriched(
        _base(spark, sf),
        coverage.identity_columns(table(spark, sf, "registry_rows"), "SYS"),
        coverage.risk_columns(table(spark, sf, "registry_risks")),
        coverage.link_counts(table(spark, sf, "registry_links")),
        **options)


def _sample_run(spark, sf):
    """A coverage run against a lookup sampled from the entities, base and lookup stored once.

    The key is stored beside the base: a filter on a derived key would work it out many times.
    Rows are dealt out first, since a small file of many rows is read by a few tasks.
    """
    keyed = materialise(coverage.with_join_key(_base(spark, sf).repartition("entity_key")), "keyed")
    lookup = materialise(_sample_lookup(keyed), "lookup")
    return coverage.run_coverage(keyed.drop(coverage.JOIN_KEY), lookup, RUN_TS)


def _sample_lookup(base):
    """A lookup sampled from the entities themselves, at each source's own rate."""
    picked = keys.in_hash_sample(
        F.col(coverage.JOIN_KEY), F.col("source"), {"TERMINAL": 0.714}, 0.353)
    rows = base.filter(picked).select(
        coverage.JOIN_KEY, F.upper("name").alias("registry_name"),
        F.col("country").alias("registry_country"),
        F.when(F.length("name") > 3, "Low").alias("registry_risk_score"),
        F.length("name").cast("bigint").alias("registry_ubo_count"),
    )
    return lookups.split_by_key(rows, coverage.JOIN_KEY, {"all": rows.columns})["all"]


def _hot(spark, sf):
    """A join where one key holds a third of the left rows and another third has none."""
    left = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("bigint"))
        .when(F.col("o_orderkey") % 3 == 1, F.lit(None)).otherwise(F.col("o_custkey")).alias("key"))
    right = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return lookups.lookup_join(left, right, "key", "left", lookups.find_hot_keys(left, "key"))


def _split(spark, sf):
    parts = lookups.split_by_key(table(spark, sf, "registry_risks"), "key", {
        "risk": ["risk_score", "risk_label", "event_id"], "screening": ["screening_status", "absent"]})
    return lookups.rejoin(parts["risk"], [parts["screening"]], "key")


def _coverage_run(spark, sf, part):
    return getattr(_sample_run(spark, sf), part)


def _stored(spark, sf):
    """Rows written to the output tables of a coverage run, loaded twice."""
    run = _sample_run(spark, sf)
    suffix = uuid.uuid4().hex[:8]
    names = {part: f"coverage_{part}_{suffix}" for part in run._fields}
    schemas = {names[part]: getattr(run, part).schema for part in run._fields}
    create_tables(spark, schemas)
    try:
        coverage.store_coverage(run, names)
        written = coverage.store_coverage(run, names)
        parts = [
            spark.table(names[part]).groupBy().agg(
                F.lit(part).alias("part"), F.count(F.lit(1)).alias("rows"),
                F.max("generated_at").alias("last_run"),
                F.lit(written[part]).cast("bigint").alias("written"))
            for part in run._fields
        ]
        kept = parts[0].unionByName(parts[1]).unionByName(parts[2])
        path = scratch_path(spark, "stored")
        kept.write.parquet(path)
        return spark.read.parquet(path)
    finally:
        drop_tables(spark, schemas)


def _registry_lookup(spark, sf):
    """The combined lookup of the registry tables, one row a key."""
    return coverage.combined_registry(
        coverage.identity_columns(table(spark, sf, "registry_rows"), "SYS"),
        coverage.risk_columns(table(spark, sf, "registry_risks")),
        coverage.link_counts(table(spark, sf, "registry_links")), dedupe=True).drop("_known")


def _registry_run(spark, sf):
    """A coverage run against the registry, its lookup stored before it is used twice."""
    lookup = materialise(_registry_lookup(spark, sf), "lookup")
    return coverage.run_coverage(_base(spark, sf), lookup, RUN_TS), lookup


def _coverage_file(spark, sf, part):
    """One of the four files of a coverage run, read back."""
    run, lookup = _registry_run(spark, sf)
    paths = coverage.write_coverage(run, lookup, scratch_path(spark, "coverage"))
    return spark.read.parquet(paths[part])


def _coverage_summary_file(spark, sf):
    """The ordered summary, numbered as its lines stand in the file."""
    run, lookup = _registry_run(spark, sf)
    paths = coverage.write_coverage(run, lookup, scratch_path(spark, "coverage"))
    return spark.read.schema(run.summary.schema).csv(paths["summary"], header=True).withColumn(
        "line", F.monotonically_increasing_id())


def _coverage_validated(spark, sf):
    """The enriched table of a run, stored and validated in one pass."""
    run, _ = _registry_run(spark, sf)
    name = f"coverage_rich_{uuid.uuid4().hex[:8]}"
    create_tables(spark, {name: run.rich.schema})
    try:
        return store_and_validate(run.rich, name, RICH_RULES, RUN_TS).report
    finally:
        drop_tables(spark, {name: run.rich.schema})


RICH_RULES = Rules(
    required_columns=("id", "source", coverage.FLAG, "registry_risk_score", "not_there"),
    non_null_columns=("id", "name", "registry_risk_score"),
    unique_columns=("id", "registry_kvk"),
    positive_numeric_columns=("total_msv_12m_eur", "registry_ubo_count"),
    allowed_values={coverage.FLAG: ("Y", "N"), "registry_risk_score": ("Low", "Medium", "High")},
    null_thresholds={"registry_vat": 0.5, "country": 0.0},
)
RICH_COLUMNS = ("id", "source", "name", "country", "total_msv_12m_eur", *coverage.IDENTITY_COLUMNS,
                *coverage.RISK_COLUMNS, *coverage.LINK_COLUMNS, coverage.FLAG)
KEY_SQL = """CASE WHEN regexp_matches(id, '[0-9]') THEN
  'P_M' || LPAD(regexp_replace(id, '[^0-9]', '', 'g'), 13, '0') END"""
CURRENT = "valid_to LIKE '%9999%' AND system_flag LIKE 'SYS%' AND key LIKE 'P\\_M%' ESCAPE '\\'"
KNOWN = f"SELECT DISTINCT key FROM registry_rows WHERE {CURRENT}"
FLAGGED = f"""SELECT e.*, CASE WHEN r.key IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry_flag
  FROM (SELECT *, {KEY_SQL} AS jk FROM entities) e LEFT JOIN ({KNOWN}) r ON e.jk = r.key"""
UNMATCHED = f"SELECT * FROM ({FLAGGED}) WHERE in_registry_flag = 'N'"
# Ties of the version are settled by the other columns in table order.
LATEST = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY key ORDER BY valid_from DESC NULLS LAST,
  event_id DESC) AS rn FROM registry_risks WHERE valid_to LIKE '%9999%') WHERE rn = 1"""
LINKS = """SELECT key, COUNT(CASE WHEN TRIM(link_type) = 'BO' THEN 1 END) AS ubo,
  COUNT(CASE WHEN TRIM(link_type) = 'SI' THEN 1 END) AS si FROM registry_links
  WHERE valid_to LIKE '%9999%' GROUP BY key"""
RICH = f"""SELECT e.* EXCLUDE (jk), CASE WHEN g.key IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry_flag,
    CASE WHEN r.risk_score IS NOT NULL THEN 'Y' ELSE 'N' END AS has_risk_flag,
    TRIM(g.name) AS registry_name, TRIM(g.street) AS registry_street, TRIM(g.postal_code) AS registry_postal_code,
    TRIM(g.city) AS registry_city, TRIM(g.mcc) AS registry_mcc, TRIM(g.country) AS registry_country,
    TRIM(g.legal_form) AS registry_legal_form, NULLIF(TRIM(g.kvk), '') AS registry_kvk,
    NULLIF(TRIM(g.duns_id), '') AS registry_duns_id, NULLIF(TRIM(g.vat), '') AS registry_vat,
    TRIM(r.risk_score) AS registry_risk_score, TRIM(r.risk_label) AS registry_risk_label,
    TRIM(r.risk_original) AS registry_risk_original, NULLIF(TRIM(r.risk_manual), '') AS registry_risk_manual,
    NULLIF(TRIM(r.risk_inherited), '') AS registry_risk_inherited,
    TRIM(r.screening_status) AS registry_screening_status, TRIM(r.screening_pstatus) AS registry_screening_pstatus,
    NULLIF(r.watchlist_hit_pct, '0') AS registry_watchlist_hit_pct,
    NULLIF(TRIM(r.watchlist_list), '') AS registry_watchlist_list,
    NULLIF(r.embargo_hit_pct, '0') AS registry_embargo_hit_pct, NULLIF(r.pep_hit_pct, '0') AS registry_pep_hit_pct,
    CAST(try_strptime(NULLIF(TRIM(r.next_review), ''), '%Y%m%d') AS DATE) AS registry_next_review_date,
    NULLIF(TRIM(r.risk_comment), '') AS registry_risk_comment, l.ubo AS registry_ubo_count, l.si AS registry_si_count
  FROM (SELECT *, {KEY_SQL} AS jk FROM entities) e
    LEFT JOIN (SELECT * FROM registry_rows WHERE {CURRENT}) g ON e.jk = g.key
    LEFT JOIN ({LATEST}) r ON e.jk = r.key LEFT JOIN ({LINKS}) l ON e.jk = l.key"""
# A run takes its flag from the lookup's keys and that of the enriched table from the risk score.
LOOKUP_KEYS = f"""SELECT key FROM registry_rows WHERE {CURRENT} UNION SELECT key FROM ({LATEST})
  UNION SELECT key FROM ({LINKS})"""
RUN_FLAG = f"""SELECT e.* EXCLUDE (jk), CASE WHEN r.key IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry_flag
  FROM (SELECT *, {KEY_SQL} AS jk FROM entities) e LEFT JOIN ({LOOKUP_KEYS}) r ON e.jk = r.key"""
RUN_RICH = f"""SELECT * EXCLUDE (in_registry_flag, has_risk_flag), has_risk_flag AS in_registry_flag,
  CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at FROM ({RICH})"""
ALL = ("entities", "registry_rows", "registry_risks", "registry_links")
SAMPLE = f"""SELECT jk, UPPER(name) AS registry_name, country AS registry_country,
    CASE WHEN LENGTH(name) > 3 THEN 'Low' END AS registry_risk_score, LENGTH(name) AS registry_ubo_count
  FROM (SELECT *, {KEY_SQL} AS jk FROM entities)
  WHERE ('0x' || substr(sha1(jk), 1, 16))::UBIGINT % 1000 < CASE WHEN source = 'TERMINAL' THEN 714 ELSE 353 END"""
SAMPLE_KEYS = f"SELECT DISTINCT jk AS key FROM ({SAMPLE})"
SAMPLE_FLAG = f"""SELECT e.* EXCLUDE (jk), CASE WHEN r.key IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry_flag
  FROM (SELECT *, {KEY_SQL} AS jk FROM entities) e LEFT JOIN ({SAMPLE_KEYS}) r ON e.jk = r.key"""


def _summary_sql(flagged: str) -> str:
    return f"""SELECT source, in_registry_flag, COUNT(id) AS merchants,
      COUNT(CASE WHEN merchant_activity_status = 'Active' THEN 1 END) AS active_merchants,
      round_even(COUNT(id)::DOUBLE / SUM(COUNT(id)) OVER (PARTITION BY source) * 100, 2) AS pct_of_source
    FROM ({flagged}) GROUP BY source, in_registry_flag"""


def _cut(i: int, relation: str, columns: str, keep: dict[str, str], measures: str) -> str:
    picked = ", ".join(f"{keep.get(c, 'NULL')} AS {c}" for c in columns.split())
    return f"SELECT {i} AS cut, {picked}, {measures} FROM {relation} GROUP BY {', '.join(keep.values())}"


_CAUSE_COLUMNS = "source merchant_activity_status contract_status onboarded_after_load"
_CAUSE_MEASURES = """COUNT(*) AS merchants, COUNT(CASE WHEN merchant_activity_status = 'Active' THEN 1 END) AS active_merchants,
  SUM(total_msv_12m_eur)::DECIMAL(30,2) AS total_msv_12m_eur"""


def _causes_sql() -> str:
    relation = f"""(SELECT *, CASE WHEN vintage_date > DATE '{LOAD_DATE}' THEN 'Yes' ELSE 'No / Unknown' END
      AS onboarded_after_load FROM ({UNMATCHED}))"""
    return " UNION ALL ".join(
        _cut(i, relation, _CAUSE_COLUMNS, {c: c for c in cut}, _CAUSE_MEASURES)
        for i, cut in enumerate(CAUSE_CUTS))


def _coverage_sql() -> str:
    return " UNION ALL ".join(
        _cut(i, f"({FLAGGED})", "source merchant_activity_status in_registry_flag contract_status",
             {c: c for c in (*cut, "in_registry_flag")},
             "COUNT(*) AS merchants, SUM(total_msv_12m_eur)::DECIMAL(30,2) AS msv_12m_eur")
        for i, cut in enumerate(CUTS))


QUERIES = {
    "registry_lookup": Query(
        lambda spark, sf: coverage.entity_lookup(table(spark, sf, "registry_rows"), "SYS"),
        with_tables(f"""SELECT key AS registry_key, TRIM(name) AS registry_name, TRIM(legal_form) AS registry_legal_form,
          CASE WHEN UPPER(legal_form) LIKE '%BESLOTEN VENNOOTSCHAP%' THEN 'Besloten Vennootschap (BV)'
          WHEN UPPER(legal_form) LIKE '%EENMANSZAAK%' THEN 'Eenmanszaak'
          WHEN UPPER(legal_form) LIKE '%VENNOOTSCHAP ONDER FIRMA%' THEN 'Vennootschap onder firma (VOF)'
          WHEN UPPER(legal_form) LIKE '%COMMANDITAIRE%' THEN 'Commanditaire Vennootschap (CV)'
          WHEN UPPER(legal_form) LIKE '%STICHTING%' THEN 'Stichting'
          WHEN UPPER(legal_form) LIKE '%VERENIGING%' THEN 'Vereniging'
          WHEN UPPER(legal_form) LIKE '%PUBLIEKRECHTELIJK%' THEN 'Publiekrechtelijk'
          ELSE TRIM(legal_form) END AS registry_legal_form_normalized,
          TRIM(mcc) AS registry_mcc, TRIM(country) AS registry_country,
          NULLIF(TRIM(registry_number), '') AS registry_number, TRIM(customer_type) AS registry_customer_type
        FROM registry_rows WHERE {CURRENT}""", "registry_rows")),
    "registry_person_links": Query(
        lambda spark, sf: coverage.person_links(table(spark, sf, "registry_links")),
        with_tables("""SELECT DISTINCT key AS entity_registry_key, person_key, link_type AS relationship_type
        FROM registry_links""", "registry_links")),
    "registry_link_types": Query(
        lambda spark, sf: distinct_beside_count(
            coverage.person_links(table(spark, sf, "registry_links")),
            "relationship_type", "entity_registry_key"),
        with_tables("""SELECT link_type AS relationship_type, COUNT(*) AS "count", COUNT(DISTINCT key) AS distinct_count
        FROM (SELECT DISTINCT key, person_key, link_type FROM registry_links) GROUP BY link_type""", "registry_links")),
    "registry_link_counts": Query(
        lambda spark, sf: coverage.link_counts(table(spark, sf, "registry_links")),
        with_tables(f"SELECT key AS join_key, ubo AS registry_ubo_count, si AS registry_si_count FROM ({LINKS})",
                    "registry_links")),
    "registry_latest_risk": Query(
        lambda spark, sf: coverage.risk_lookup(table(spark, sf, "registry_risks")),
        with_tables(f"""SELECT key AS risk_key, risk_score AS risk_final, risk_original, risk_manual, risk_inherited,
          screening_pstatus || COALESCE(' — ' || screening_status, '') AS risk_screening_status FROM ({LATEST})""",
                    "registry_risks")),
    "match_flag": Query(
        _flagged, with_tables(f"SELECT * EXCLUDE (jk) FROM ({FLAGGED})", "entities", "registry_rows")),
    "unmatched": Query(
        _unmatched, with_tables(f"SELECT * EXCLUDE (jk, in_registry_flag) FROM ({UNMATCHED})",
                                "entities", "registry_rows")),
    "match_summary": Query(
        lambda spark, sf: coverage.match_summary(_flagged(spark, sf)),
        with_tables(_summary_sql(FLAGGED), "entities", "registry_rows")),
    "match_volume": Query(
        lambda spark, sf: coverage.match_volume(_flagged(spark, sf)),
        with_tables(f"""SELECT source, in_registry_flag, COUNT(*) AS merchants,
          SUM(total_msv_12m_eur)::DECIMAL(30,2) AS total_msv_12m_eur,
          COUNT(CASE WHEN merchant_activity_status = 'Active' THEN 1 END) AS active_merchants
        FROM ({FLAGGED}) GROUP BY source, in_registry_flag""", "entities", "registry_rows")),
    "match_rates": Query(
        lambda spark, sf: coverage.match_rates(_base(spark, sf), _keys(spark, sf)),
        with_tables(f"""SELECT source, COUNT(CASE WHEN in_registry_flag = 'Y' THEN 1 END) AS matched, COUNT(*) AS total,
          round_even(COUNT(CASE WHEN in_registry_flag = 'Y' THEN 1 END)::DOUBLE / COUNT(*) * 100, 2) AS pct
        FROM ({FLAGGED}) GROUP BY source""", "entities", "registry_rows")),
    "match_by_dims": Query(
        lambda spark, sf: coverage.coverage_by(
            _flagged(spark, sf), [(*cut, coverage.FLAG) for cut in CUTS]),
        with_tables(_coverage_sql(), "entities", "registry_rows")),
    "unmatched_root_causes": Query(
        lambda spark, sf: coverage.root_causes(_unmatched(spark, sf), LOAD_DATE, CAUSE_CUTS),
        with_tables(_causes_sql(), "entities", "registry_rows")),
    "enriched_base": Query(_rich, with_tables(RICH, *ALL)),
    "enriched_base_one_identity": Query(
        lambda spark, sf: _rich(spark, sf, dedupe=True), with_tables(RICH, *ALL)),
    "risk_overview": Query(
        lambda spark, sf: coverage.risk_distribution(_rich(spark, sf)),
        with_tables(f"""SELECT registry_risk_score AS risk, COUNT(*) AS merchants FROM ({RICH})
        WHERE in_registry_flag = 'Y' AND registry_risk_score IS NOT NULL GROUP BY 1""", *ALL)),
    "coverage_scalars": Query(
        lambda spark, sf: coverage.coverage_scalars(_rich(spark, sf), REPORTING_DATE),
        with_tables(f"""SELECT COUNT(*) AS total, COUNT(CASE WHEN in_registry_flag = 'Y' THEN 1 END) AS matched,
          COUNT(CASE WHEN in_registry_flag = 'N' THEN 1 END) AS unmatched,
          round_even(COUNT(CASE WHEN in_registry_flag = 'Y' THEN 1 END)::DOUBLE / COUNT(*) * 100, 1) AS pct_matched,
          COUNT(registry_risk_score) AS enriched,
          COUNT(CASE WHEN in_registry_flag = 'Y' AND registry_risk_score IN ('High', 'VeryHigh') THEN 1 END) AS high_risk,
          COUNT(CASE WHEN in_registry_flag = 'Y' THEN registry_watchlist_hit_pct END) AS watchlist_hits,
          COUNT(CASE WHEN registry_next_review_date < DATE '{REPORTING_DATE}' THEN 1 END) AS reviews_overdue
        FROM ({RICH})""", *ALL)),
    "watchlist_top": Query(
        lambda spark, sf: coverage.top_watchlist(_rich(spark, sf)),
        with_tables(f"""SELECT id, name, country, registry_risk_score, registry_watchlist_list,
          CAST(registry_watchlist_hit_pct AS DOUBLE) AS registry_watchlist_hit_pct FROM ({RICH})
        WHERE in_registry_flag = 'Y' AND registry_watchlist_hit_pct IS NOT NULL
        ORDER BY CAST(registry_watchlist_hit_pct AS DOUBLE) DESC, id LIMIT 10""", *ALL)),
    "drill_down": Query(
        lambda spark, sf: filters.drill_down(
            _rich(spark, sf), ["TERMINAL", "PARTNER"], "Y", ["High", "Low"]),
        with_tables(f"""SELECT * FROM ({RICH}) WHERE in_registry_flag = 'Y' AND source IN ('TERMINAL', 'PARTNER')
        AND (registry_risk_score IN ('High', 'Low') OR registry_risk_score IS NULL)""", *ALL)),
    "matched_sample": Query(
        lambda spark, sf: coverage.matched_sample(_flagged(spark, sf)),
        with_tables(f"""SELECT * EXCLUDE (jk) FROM ({FLAGGED}) WHERE in_registry_flag = 'Y'
        ORDER BY source, id LIMIT 5""", "entities", "registry_rows")),
    "hot_key_join": Query(_hot, """SELECT o_orderkey, key, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7
          WHEN o_orderkey % 3 = 1 THEN NULL ELSE o_custkey END AS key FROM orders)
        LEFT JOIN customer ON key = c_custkey"""),
    "split_and_rejoin": Query(_split, with_tables("""
        SELECT key, risk_score, risk_label, event_id, screening_status FROM
          (SELECT key, risk_score, risk_label, event_id, ROW_NUMBER() OVER (
            PARTITION BY key ORDER BY risk_score, risk_label, event_id) AS rn FROM registry_risks)
          LEFT JOIN (SELECT key, CASE WHEN COUNT(*) = COUNT(screening_status) THEN MIN(screening_status) END AS screening_status
            FROM registry_risks GROUP BY key) USING (key) WHERE rn = 1""", "registry_risks")),
    "coverage_run_flag": Query(
        lambda spark, sf: _coverage_run(spark, sf, "flag"),
        with_tables(f"SELECT *, CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at FROM ({SAMPLE_FLAG})", "entities")),
    "coverage_run_enriched": Query(
        lambda spark, sf: _coverage_run(spark, sf, "rich"),
        with_tables(f"""SELECT e.* EXCLUDE (jk), s.* EXCLUDE (jk),
          CASE WHEN s.registry_risk_score IS NOT NULL THEN 'Y' ELSE 'N' END AS in_registry_flag,
          CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at
        FROM (SELECT *, {KEY_SQL} AS jk FROM entities) e LEFT JOIN
          (SELECT * FROM ({SAMPLE}) QUALIFY ROW_NUMBER() OVER (PARTITION BY jk ORDER BY registry_name) = 1) s
          ON e.jk = s.jk""", "entities")),
    "coverage_run_summary": Query(
        lambda spark, sf: _coverage_run(spark, sf, "summary"),
        with_tables(f"""SELECT *, CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at FROM ({_summary_sql(SAMPLE_FLAG)})""",
                    "entities")),
    "coverage_file_flag": Query(
        lambda spark, sf: _coverage_file(spark, sf, "flag"),
        with_tables(f"SELECT *, CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at FROM ({RUN_FLAG})", *ALL)),
    "coverage_file_enriched": Query(
        lambda spark, sf: _coverage_file(spark, sf, "rich"), with_tables(RUN_RICH, *ALL)),
    "coverage_file_lookup": Query(
        lambda spark, sf: _coverage_file(spark, sf, "lookup").select(
            coverage.JOIN_KEY, "registry_name", "registry_risk_score", "registry_ubo_count"),
        with_tables(f"""SELECT k.key AS join_key, TRIM(g.name) AS registry_name,
          TRIM(r.risk_score) AS registry_risk_score, l.ubo AS registry_ubo_count
        FROM ({LOOKUP_KEYS}) k LEFT JOIN (SELECT * FROM registry_rows WHERE {CURRENT}) g ON k.key = g.key
          LEFT JOIN ({LATEST}) r ON k.key = r.key LEFT JOIN ({LINKS}) l ON k.key = l.key""", *ALL)),
    "coverage_file_summary": Query(_coverage_summary_file, with_tables(
        f"""SELECT *, CAST('{RUN_TS}' AS TIMESTAMP) AS generated_at,
          ROW_NUMBER() OVER (ORDER BY source, in_registry_flag) - 1 AS line FROM ({_summary_sql(RUN_FLAG)})""", *ALL)),
    "coverage_validated": Query(_coverage_validated, with_tables(
        f"WITH rich AS ({RUN_RICH}) " + report_sql("rich", RICH_RULES, RICH_COLUMNS), *ALL)),
    "coverage_tables_replaced": Query(_stored, with_tables(f"""
        SELECT 'flag' AS part, COUNT(*) AS "rows", CAST('{RUN_TS}' AS TIMESTAMP) AS last_run, COUNT(*) AS written FROM entities
        UNION ALL SELECT 'rich', COUNT(*), CAST('{RUN_TS}' AS TIMESTAMP), COUNT(*) FROM entities
        UNION ALL SELECT 'summary', COUNT(*), CAST('{RUN_TS}' AS TIMESTAMP), COUNT(*) FROM ({_summary_sql(SAMPLE_FLAG)})""",
                                                          "entities")),
}
