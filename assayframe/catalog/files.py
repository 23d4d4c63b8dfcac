"""Sources, sinks, run history and the stream, over files written from the tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from assayframe.catalog.base import Query, table, with_tables
from assayframe.catalog.oracle import report_sql, results_sql, scores_sql
from assayframe.catalog.quality import CUSTOMER_COLUMNS, CUSTOMER_RULES, ORDER_COLUMNS, ORDER_RULES
from assayframe.catalog.coverage import CURRENT, LATEST, LINKS
from assayframe.catalog.repair import (
    _BLANKS, _RESULTS, _steps_union, COLUMNS, LADDER_SQL, PLAN, RULES, STEP_SQL, dirty,
)
from assayframe.catalog.stress import MATRIX_SQL, SCENARIOS
from assayframe.operators import inject
from assayframe.operators.checks import run_checks
from assayframe.operators.report import build_report, build_summary, scores
from assayframe.plans import coverage, history, ladder, matrix, store
from assayframe.plans.validate import validate_source
from assayframe.rules import Config, DatasetSettings, Rules
from assayframe.session import materialise, scratch_path
from assayframe.sources import files, sinks
from assayframe.streaming.revalidate import batch_history, revalidate

RUN_TS = ("2001-06-28 10:00:00", "2001-06-29 10:00:00", "2001-06-30 10:00:00")
ORDER_DTYPES = {"order_number": "Int64", "total": "float64", "customer_id": "str", "absent": "str"}


def _orders_csv(spark, sf):
    path = scratch_path(spark, "orders") + ".csv"
    sinks.write_csv(table(spark, sf, "dirty_orders"), path)
    return path


def _csv_load(spark, sf):
    return files.load_dataset(spark, _orders_csv(spark, sf), ORDER_DTYPES)


def _csv_text(spark, sf):
    return files.load_text(spark, _orders_csv(spark, sf))


def _csv_validate(spark, sf):
    path = _orders_csv(spark, sf)
    config = Config(DatasetSettings(input_path=path, dtypes=ORDER_DTYPES), ORDER_RULES)
    return validate_source(spark, config).report


def _scenario_files(spark, sf):
    """One CSV per order priority, every other one with its columns reversed, scored by file in one run."""
    root = scratch_path(spark, "scenarios")
    df = table(spark, sf, "dirty_orders")
    for i, priority in enumerate(PRIORITIES):
        own = F.col("priority") == priority if priority else F.col("priority").isNull()
        columns = df.columns[::-1] if i % 2 else df.columns
        sinks.write_csv(df.filter(own).select(*columns), f"{root}/{priority or 'none'}.csv")
    loaded = files.load_scenarios(spark, root)
    return scores(run_checks(loaded, FILE_RULES, by=["scenario"]), by=["scenario"])


# The fixed values of an order's priority, and orders without one.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None)
FILE_RULES = Rules(
    required_columns=("order_id", "amount"),
    non_null_columns=("order_id", "customer_id", "amount"),
    unique_columns=("order_id",),
    positive_numeric_columns=("amount", "total"),
    date_columns=("order_date",),
    null_thresholds={"status": 0.04},
)


def _table_loop(spark, sf):
    """Store a table, then validate it by name."""
    name = f"customers_{uuid.uuid4().hex[:8]}"
    sinks.overwrite_table(table(spark, sf, "customer"), name)
    try:
        run = validate_source(spark, Config(checks=CUSTOMER_RULES), table=name)
        return build_report(materialise(run.results.coalesce(1), "loop"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _append_rows(spark, sf):
    """A table filled, replaced and appended to: rows written and rows kept."""
    name = f"parts_{uuid.uuid4().hex[:8]}"
    df = table(spark, sf, "part")
    sinks.create_tables(spark, {name: df.schema})
    try:
        sinks.replace_rows(df, name)
        replaced = sinks.replace_rows(df, name)
        appended = sinks.replace_rows(df, name, append=True)
        return materialise(spark.table(name).groupBy("p_type").agg(
            F.count(F.lit(1)).alias("kept"),
            F.lit(replaced).cast("bigint").alias("replaced"),
            F.lit(appended).cast("bigint").alias("appended")), "rows")
    finally:
        sinks.drop_tables(spark, {name: df.schema})


def _publish(spark, sf):
    """Three published runs over ever stricter rules."""
    root = scratch_path(spark, "runs")
    df = table(spark, sf, "customer")
    for i, stamp in enumerate(RUN_TS):
        rules = RUN_RULES[i]
        results = materialise(run_checks(df, rules).coalesce(1), "results")
        summary = build_summary(results, f"sql://customer-{i}", stamp)
        sinks.publish_run(results, summary, root, f"run-{i}")
    return root


RUN_RULES = (
    Rules(non_null_columns=CUSTOMER_COLUMNS),
    Rules(non_null_columns=CUSTOMER_COLUMNS, unique_columns=("c_nationkey",)),
    CUSTOMER_RULES,
)


def _runs(spark, sf):
    return history.find_runs(spark, _publish(spark, sf))


def _published(spark, sf):
    runs = history.published_runs(spark, _publish(spark, sf))
    return runs.withColumn("failed_checks", F.array_join(F.transform(
        "failed_checks", lambda c: F.concat_ws(":", c["check_name"], c["column_name"])), "; "))


def _write_ladder(spark, sf):
    root = scratch_path(spark, "ladder")
    df = dirty(spark, sf)
    ladder.write_ladder(ladder.ladder_frames(df, PLAN), ladder.ladder_summary(df, PLAN, RULES), root)
    return root


def _ladder_files(spark, sf):
    """Ladder steps written as CSV, read back by file and scored again."""
    loaded = files.load_scenarios(spark, _write_ladder(spark, sf) + "/steps", "step")
    return scores(run_checks(loaded, RULES, by=["step"]), by=["step"])


def _ladder_summary_file(spark, sf):
    """The ladder summary read back from its CSV with tolerant numbers."""
    stored = files.load_text(spark, _write_ladder(spark, sf) + "/ladder_summary.csv")
    return history.ladder_scores(stored).select(
        "step", "quality_score", "checks_failed", "checks_passed", "score_delta", "failed_delta", "failed_checks")


def _matrix_file(spark, sf):
    """The score matrix read back from its JSON."""
    root = scratch_path(spark, "matrix")
    df = dirty(spark, sf)
    made = matrix.score_scenarios(df, SCENARIOS, df.count(), RULES)
    matrix.write_matrix(made, root)
    return spark.read.schema(made.schema).json(f"{root}/matrix_summary.json")


def _stored_base(spark, sf):
    """Entities with damaged names written as CSV, loaded twice into their table."""
    damaged = F.decode(F.encode(F.concat(F.col("name"), F.lit(" Coöperatie")), "UTF-8"), "ISO-8859-1")
    path = scratch_path(spark, "base") + ".csv"
    sinks.write_csv(table(spark, sf, "dirty_entities").withColumn("name", damaged), path)
    name = f"entity_base_{uuid.uuid4().hex[:8]}"
    schemas = {name: store.SOURCE_TABLES["entity_base"]}
    sinks.create_tables(spark, schemas)
    try:
        store.load_base(spark, path, name)
        written = store.load_base(spark, path, name)
        return materialise(spark.table(name).withColumn("written", F.lit(written).cast("bigint")), "base")
    finally:
        sinks.drop_tables(spark, schemas)


def _stored_lookup(spark, sf):
    """A combined lookup split into its three tables and joined again."""
    lookup = coverage.combined_registry(
        coverage.identity_columns(table(spark, sf, "registry_rows"), "SYS"),
        coverage.risk_columns(table(spark, sf, "registry_risks")),
        coverage.link_counts(table(spark, sf, "registry_links"))).drop("_known")
    suffix = uuid.uuid4().hex[:8]
    names = {n: f"{n}_{suffix}" for n in ("registry_identity", "registry_risk", "registry_link")}
    schemas = {names[n]: store.SOURCE_TABLES[n] for n in names}
    sinks.create_tables(spark, schemas)
    try:
        store.load_lookup(lookup, names)
        return materialise(store.join_lookup(*[spark.table(t) for t in names.values()]), "lookup")
    finally:
        sinks.drop_tables(spark, schemas)


def _stream(spark, sf):
    """Orders arriving as one file per batch; the scored batches summed up."""
    root = scratch_path(spark, "stream")
    df = table(spark, sf, "dirty_orders").select("order_id", "amount", "order_date", "priority")
    df.repartition(3).write.parquet(f"{root}/in")
    query = revalidate(
        spark, f"{root}/in", df.schema, STREAM_RULES, f"{root}/history", f"{root}/checkpoint",
        files_per_batch=1)
    query.awaitTermination()
    return batch_history(spark, f"{root}/history").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("row_count"),
        F.sum("checks_total").alias("checks_total"), F.max("checks_failed").alias("checks_failed"))


STREAM_RULES = Rules(non_null_columns=("order_id",), positive_numeric_columns=("amount",),
                     date_columns=("order_date",), null_thresholds={"priority": 0.5})

_TOKENS = "('', 'nan')"


def _nulled(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({_BLANKS}) THEN {c} END AS {c}"


LOOKUP_COLUMNS = (*coverage.IDENTITY_COLUMNS, *coverage.RISK_COLUMNS, *coverage.LINK_COLUMNS)
LOOKUP_SQL = """
    TRIM(g.name) AS registry_name, TRIM(g.street) AS registry_street, TRIM(g.postal_code) AS registry_postal_code,
    TRIM(g.city) AS registry_city, TRIM(g.mcc) AS registry_mcc, TRIM(g.country) AS registry_country,
    TRIM(g.legal_form) AS registry_legal_form, NULLIF(TRIM(g.kvk), '') AS registry_kvk,
    NULLIF(TRIM(g.duns_id), '') AS registry_duns_id, NULLIF(TRIM(g.vat), '') AS registry_vat,
    TRIM(r.risk_score) AS registry_risk_score, TRIM(r.risk_label) AS registry_risk_label,
    TRIM(r.risk_original) AS registry_risk_original, NULLIF(TRIM(r.risk_manual), '') AS registry_risk_manual,
    NULLIF(TRIM(r.risk_inherited), '') AS registry_risk_inherited,
    TRIM(r.screening_status) AS registry_screening_status, TRIM(r.screening_pstatus) AS registry_screening_pstatus,
    CAST(NULLIF(r.watchlist_hit_pct, '0') AS DOUBLE) AS registry_watchlist_hit_pct,
    NULLIF(TRIM(r.watchlist_list), '') AS registry_watchlist_list,
    CAST(NULLIF(r.embargo_hit_pct, '0') AS DOUBLE) AS registry_embargo_hit_pct,
    CAST(NULLIF(r.pep_hit_pct, '0') AS DOUBLE) AS registry_pep_hit_pct,
    CAST(try_strptime(NULLIF(TRIM(r.next_review), ''), '%Y%m%d') AS DATE) AS registry_next_review_date,
    NULLIF(TRIM(r.risk_comment), '') AS registry_risk_comment,
    CAST(l.ubo AS INTEGER) AS registry_ubo_count, CAST(l.si AS INTEGER) AS registry_si_count"""


def _run_sql(i: int) -> str:
    results = results_sql("customer", RUN_RULES[i], CUSTOMER_COLUMNS)
    return f"""SELECT 'run-{i}' AS run, CAST('{RUN_TS[i]}' AS TIMESTAMP) AS run_at, 'sql://customer-{i}' AS input_file,
      MAX(row_count) AS row_count, COUNT(*) AS checks_total, COUNT(CASE WHEN status = 'PASS' THEN 1 END) AS checks_passed,
      COUNT(CASE WHEN status <> 'PASS' THEN 1 END) AS checks_failed,
      round_even(COUNT(CASE WHEN status = 'PASS' THEN 1 END) * 100.0 / COUNT(*), 2) AS quality_score,
      COALESCE(string_agg(check_name || ':' || column_name, '; ' ORDER BY seq) FILTER (WHERE status <> 'PASS'), '') AS failed_checks
    FROM ({results})"""


RUNS_SQL = " UNION ALL ".join(_run_sql(i) for i in range(3))
_NUMBERS = "row_count, checks_total, checks_passed, checks_failed, quality_score"

QUERIES = {
    "csv_typed_scan": Query(_csv_load, with_tables(f"""
        SELECT order_id, customer_id, CASE WHEN amount NOT IN {_TOKENS} THEN amount END AS amount, order_date,
          status, priority, order_number, total FROM dirty_orders""", "dirty_orders")),
    "csv_text_scan": Query(_csv_text, with_tables("""
        SELECT COALESCE(order_id, '') AS order_id, COALESCE(customer_id, '') AS customer_id,
          COALESCE(amount, '') AS amount, COALESCE(order_date, '') AS order_date, COALESCE(status, '') AS status,
          COALESCE(priority, '') AS priority, CAST(order_number AS VARCHAR) AS order_number,
          CAST(total AS VARCHAR) AS total FROM dirty_orders""", "dirty_orders")),
    "csv_validate": Query(_csv_validate, with_tables(
        "WITH nulled AS (SELECT * REPLACE (CASE WHEN amount NOT IN ('', 'nan') THEN amount END AS amount) FROM dirty_orders) "
        + report_sql("nulled", ORDER_RULES, ORDER_COLUMNS), "dirty_orders")),
    "csv_scenario_files": Query(_scenario_files, with_tables(
        f"""WITH nulled AS (SELECT * REPLACE (CASE WHEN amount NOT IN ('', 'nan') THEN amount END AS amount),
          COALESCE(priority, 'none') AS scenario FROM dirty_orders)
        {scores_sql(results_sql('nulled', FILE_RULES, ORDER_COLUMNS, by='scenario'), 'scenario')}""", "dirty_orders")),
    "table_validate": Query(_table_loop, report_sql("customer", CUSTOMER_RULES, CUSTOMER_COLUMNS)),
    "table_replace_append": Query(_append_rows, """
        SELECT p_type, COUNT(*) * 2 AS kept, (SELECT COUNT(*) FROM part) AS replaced,
          (SELECT COUNT(*) FROM part) AS appended FROM part GROUP BY p_type"""),
    "report_file": Query(
        lambda spark, sf: history.run_report(spark, _publish(spark, sf), "run-2"),
        report_sql("customer", CUSTOMER_RULES, CUSTOMER_COLUMNS)),
    "run_history": Query(_runs, f"""
        SELECT run AS run_id, run_at AS generated_at, input_file, {_NUMBERS} FROM ({RUNS_SQL})"""),
    "published_runs": Query(_published, f"""
        SELECT run AS run_id, run_at AS generated_at_utc, input_file, {_NUMBERS}, failed_checks FROM ({RUNS_SQL})"""),
    "run_inventory": Query(
        lambda spark, sf: history.inventory(_runs(spark, sf), "Europe/Amsterdam"), f"""
        SELECT run AS run_id, run || ' | ' || strftime(run_at + INTERVAL 2 HOUR, '%d %b %Y %H:%M') AS label,
          quality_score, checks_failed, strftime(run_at + INTERVAL 2 HOUR, '%d %b %Y %H:%M') AS generated_local
        FROM ({RUNS_SQL})"""),
    "run_trend": Query(
        lambda spark, sf: history.trend(_runs(spark, sf)), f"""
        SELECT run AS run_id, run_at AS generated_at, quality_score, checks_failed, checks_passed,
          COALESCE(round_even(quality_score - LAG(quality_score) OVER (ORDER BY run_at), 2), 0) AS score_delta,
          COALESCE(checks_failed - LAG(checks_failed) OVER (ORDER BY run_at), 0) AS failed_delta FROM ({RUNS_SQL})"""),
    "last_run": Query(
        lambda spark, sf: history.last_run(_runs(spark, sf)), f"SELECT MAX(run_at) AS last_run FROM ({RUNS_SQL})"),
    "ladder_files": Query(_ladder_files, with_tables(
        STEP_SQL + f""", steps AS ({_steps_union()}), results AS ({_RESULTS})
        {scores_sql('SELECT * FROM results', 'step')}""", "dirty_entities")),
    "ladder_summary_file": Query(_ladder_summary_file, with_tables(f"""
        SELECT step, quality_score, CAST(checks_failed AS DOUBLE) AS checks_failed, CAST(checks_passed AS DOUBLE) AS checks_passed,
          CAST(score_delta AS DOUBLE) AS score_delta, CAST(failed_delta AS DOUBLE) AS failed_delta, failed_checks
        FROM ({LADDER_SQL})""", "dirty_entities")),
    "matrix_file": Query(_matrix_file, with_tables(MATRIX_SQL, "dirty_entities")),
    "stored_base": Query(_stored_base, with_tables(f"""
        SELECT {", ".join(_nulled(c) for c in COLUMNS if c not in ("name", "active_contracts"))},
          name || ' Coöperatie' AS name, CAST(NULL AS INTEGER) AS active_contracts,
          (SELECT COUNT(*) FROM dirty_entities) AS written FROM dirty_entities""", "dirty_entities")),
    "stored_lookup": Query(_stored_lookup, with_tables(f"""
        SELECT k AS join_key, {", ".join(LOOKUP_COLUMNS)} FROM (
          SELECT COALESCE(g.key, r.key, l.key) AS k, {LOOKUP_SQL}
          FROM (SELECT * FROM registry_rows WHERE {CURRENT}) g FULL JOIN ({LATEST}) r ON g.key = r.key
            FULL JOIN ({LINKS}) l ON COALESCE(g.key, r.key) = l.key)""",
        "registry_rows", "registry_risks", "registry_links")),
    "stream_revalidation": Query(_stream, with_tables("""
        SELECT CAST(3 AS BIGINT) AS batches, COUNT(*) AS row_count, CAST(15 AS BIGINT) AS checks_total,
          CAST(3 AS BIGINT) AS checks_failed FROM dirty_orders""", "dirty_orders")),
}
