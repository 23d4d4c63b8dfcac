"""Checks, reports, scores and what to do about them."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import Query, table, with_tables
from assayframe.catalog.oracle import REPORT, report_sql, results_sql, scores_sql
from assayframe.operators import checks, report
from assayframe.plans.validate import validate_frame
from assayframe.rules import Rules

ORDER_COLUMNS = ("order_id", "customer_id", "amount", "order_date", "status", "priority",
                 "order_number", "total")
ORDER_RULES = Rules(
    required_columns=("order_id", "customer_id", "amount", "order_date", "status", "currency", "region"),
    non_null_columns=("order_id", "customer_id", "order_number", "currency"),
    unique_columns=("order_id", "order_number"),
    positive_numeric_columns=("amount", "total"),
    date_columns=("order_date",),
    allowed_values={"status": ("P", "F", "O"), "priority": ("1-URGENT", "2-HIGH", "3-MEDIUM")},
    null_thresholds={"customer_id": 0.02, "priority": 0.1, "status": 0.05, "order_date": 0.04},
)
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
CUSTOMER_RULES = Rules(
    required_columns=CUSTOMER_COLUMNS,
    non_null_columns=CUSTOMER_COLUMNS,
    unique_columns=("c_custkey", "c_name", "c_nationkey"),
    positive_numeric_columns=("c_acctbal",),
    allowed_values={
        "c_mktsegment": ("BUILDING", "MACHINERY", "HOUSEHOLD"),
        "c_nationkey": ("0", "1", "2", "3"),
    },
    null_thresholds={"c_acctbal": 0.0},
)
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
DOCUMENT_RULES = Rules(
    required_columns=(*DOCUMENT_COLUMNS, "title"),
    non_null_columns=DOCUMENT_COLUMNS,
    unique_columns=("doc_id", "text"),
    positive_numeric_columns=("n_chars",),
    allowed_values={"lang": ("en", "fr", "de")},
    null_thresholds={"text": 0.0},
)
LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
# As many checks as the published throughput figures are based on.
LINE_RULES = Rules(
    required_columns=LINE_COLUMNS,
    non_null_columns=LINE_COLUMNS[:10],
    unique_columns=("l_orderkey", "l_partkey"),
    positive_numeric_columns=("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"),
    date_columns=("l_shipdate",),
    allowed_values={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O"),
                    "l_linenumber": ("1", "2", "3", "4")},
    null_thresholds={"l_orderkey": 0.01, "l_partkey": 0.25, "l_suppkey": 0.4, "l_tax": 0.5,
                     "l_discount": 0.6, "l_quantity": 0.85, "l_shipdate": 0.98},
)

ORDER_RESULTS = results_sql("dirty_orders", ORDER_RULES, ORDER_COLUMNS)



def _results(spark, sf):
    return checks.run_checks(table(spark, sf, "dirty_orders"), ORDER_RULES)


def _report(name, rules):
    return lambda spark, sf: report.build_report(checks.run_checks(table(spark, sf, name), rules))


def _one(check, *args):
    return lambda spark, sf: report.build_report(check(table(spark, sf, "dirty_orders"), *args))


def _one_sql(**rule):
    sql = results_sql("dirty_orders", Rules(**rule), ORDER_COLUMNS)
    keep = "seq >= 0" if "required_columns" in rule else "seq > 0"
    return with_tables(f"SELECT {REPORT} FROM ({sql}) WHERE {keep}", "dirty_orders")


def _summary(spark, sf):
    made = validate_frame(table(spark, sf, "dirty_orders"), ORDER_RULES, "sql://dirty_orders",
                          "2001-06-30 12:00:00").summary
    return made.withColumn("failed_checks", F.array_join(F.transform(
        "failed_checks", lambda c: F.concat_ws(":", c["check_name"], c["column_name"])), "; "))


def _by_priority(spark, sf):
    df = table(spark, sf, "dirty_orders")
    return report.scores(checks.run_checks(df, BY_PRIORITY, by=["priority"]), by=["priority"])


BY_PRIORITY = Rules(
    non_null_columns=("order_id", "customer_id"),
    unique_columns=("order_id", "customer_id"),
    positive_numeric_columns=("amount",),
    date_columns=("order_date",),
    null_thresholds={"customer_id": 0.025},
)

_FAILED = f"(SELECT * FROM ({ORDER_RESULTS}) WHERE status = 'FAIL')"
_ACTION_CASE = "CASE check_name " + " ".join(
    f"WHEN '{name}' THEN '{text}'" for name, text in report.ACTIONS.items()) + " END"

QUERIES = {
    "dq_report_orders": Query(
        _report("dirty_orders", ORDER_RULES),
        with_tables(report_sql("dirty_orders", ORDER_RULES, ORDER_COLUMNS), "dirty_orders")),
    "dq_report_customer": Query(
        _report("customer", CUSTOMER_RULES), report_sql("customer", CUSTOMER_RULES, CUSTOMER_COLUMNS)),
    "dq_report_documents": Query(
        _report("documents", DOCUMENT_RULES), report_sql("documents", DOCUMENT_RULES, DOCUMENT_COLUMNS)),
    "dq_report_lineitem": Query(
        _report("lineitem", LINE_RULES),
        report_sql("lineitem", LINE_RULES, LINE_COLUMNS, dates=("l_shipdate",))),
    "dq_summary": Query(_summary, with_tables(f"""
        SELECT CAST('2001-06-30 12:00:00' AS TIMESTAMP) AS generated_at_utc,
          'sql://dirty_orders' AS input_file, MAX(row_count) AS row_count, COUNT(*) AS checks_total,
          COUNT(CASE WHEN status = 'PASS' THEN 1 END) AS checks_passed,
          COUNT(CASE WHEN status <> 'PASS' THEN 1 END) AS checks_failed,
          round_even(COUNT(CASE WHEN status = 'PASS' THEN 1 END) * 100.0 / COUNT(*), 2) AS quality_score,
          string_agg(check_name || ':' || column_name, '; ' ORDER BY seq) FILTER (WHERE status <> 'PASS') AS failed_checks
        FROM ({ORDER_RESULTS})""", "dirty_orders")),
    "dq_scores_by_group": Query(_by_priority, with_tables(
        scores_sql(results_sql("dirty_orders", BY_PRIORITY, ORDER_COLUMNS, by="priority"), "priority"),
        "dirty_orders")),
    "dq_severity_summary": Query(
        lambda spark, sf: report.severity_summary(_results(spark, sf)),
        with_tables(f'SELECT status, severity, COUNT(*) AS "count" FROM ({ORDER_RESULTS}) GROUP BY status, severity',
                    "dirty_orders")),
    "dq_pass_fail_split": Query(
        lambda spark, sf: report.pass_fail_split(_results(spark, sf)),
        with_tables(f'SELECT status, COUNT(*) AS "count" FROM ({ORDER_RESULTS}) GROUP BY status', "dirty_orders")),
    "dq_remediation_plan": Query(
        lambda spark, sf: report.remediation_plan(report.build_report(_results(spark, sf))),
        with_tables(f"""
        SELECT {REPORT}, CASE severity WHEN 'critical' THEN 0 WHEN 'warning' THEN 1 ELSE 2 END AS priority,
          {_ACTION_CASE} AS recommended_action FROM {_FAILED}""", "dirty_orders")),
    "dq_failed_rows_ranked": Query(
        lambda spark, sf: report.failed_rows_by_control(_results(spark, sf)),
        with_tables(f"""SELECT check_name || ' | ' || column_name AS label, severity, failed_rows, message
        FROM {_FAILED}""", "dirty_orders")),
    "check_required": Query(
        _one(checks.check_required, ("order_id", "currency", "region")),
        _one_sql(required_columns=("order_id", "currency", "region"))),
    "check_non_null": Query(
        _one(checks.check_non_null, ("order_id", "customer_id", "total", "absent")),
        _one_sql(non_null_columns=("order_id", "customer_id", "total", "absent"))),
    "check_unique": Query(
        _one(checks.check_unique, ("order_id", "customer_id", "order_number", "total")),
        _one_sql(unique_columns=("order_id", "customer_id", "order_number", "total"))),
    "check_unique_text": Query(
        lambda spark, sf: report.build_report(checks.check_unique(table(spark, sf, "documents"), ["text"])),
        f"""SELECT {REPORT} FROM ({results_sql('documents', Rules(unique_columns=('text',)), DOCUMENT_COLUMNS)})
        WHERE seq > 0"""),
    "check_positive": Query(
        _one(checks.check_positive, ("amount", "total", "status")),
        _one_sql(positive_numeric_columns=("amount", "total", "status"))),
    "check_date": Query(
        _one(checks.check_dates, ("order_date", "status")), _one_sql(date_columns=("order_date", "status"))),
    "check_domain": Query(
        _one(checks.check_allowed, {"status": ("P", "F", "O"), "order_number": ("1", "2")}),
        _one_sql(allowed_values={"status": ("P", "F", "O"), "order_number": ("1", "2")})),
    "check_null_ratio": Query(
        _one(checks.check_null_ratio, {"priority": 0.05, "status": 0.5, "total": 0.0}),
        _one_sql(null_thresholds={"priority": 0.05, "status": 0.5, "total": 0.0})),
}
