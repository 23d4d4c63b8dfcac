"""Filters, projections, sorts and set operations."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import CUTOFF_KEY, Query, REPORTING_DATE, table, with_tables
from assayframe.columns import missing, present
from assayframe.functions import dates
from assayframe.functions.parse import is_blank
from assayframe.operators import filters
from assayframe.operators.checks import run_checks
from assayframe.operators.report import build_report
from assayframe.catalog.quality import ORDER_RESULTS, ORDER_RULES
from assayframe.catalog.oracle import REPORT
from assayframe.plans.entity_base import code_list, current
from assayframe.sources.files import columns_with_prefix, project, rename

RISK_RANK = {"5-LOW": 0, "4-NOT SPECIFIED": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}


def _report(spark, sf):
    return build_report(run_checks(table(spark, sf, "dirty_orders"), ORDER_RULES))


def _columns_found(spark, sf):
    """Required columns that exist and that do not, with the rows they were looked for in."""
    df = table(spark, sf, "dirty_orders")
    wanted = ("order_id", "status", "currency", "region")
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(", ".join(present(df, wanted))).alias("present"),
        F.lit(", ".join(missing(df, wanted))).alias("missing"))


QUERIES = {
    "filter_code": Query(
        lambda spark, sf: table(spark, sf, "partner_transactions").filter(F.col("clearing_state") == 41),
        with_tables("SELECT * FROM partner_transactions WHERE clearing_state = 41", "partner_transactions")),
    "filter_recent": Query(
        lambda spark, sf: table(spark, sf, "pos_payments").filter(
            (F.col("date_key") >= dates.cutoff_key(REPORTING_DATE)) & (F.col("currency") != "-1")),
        with_tables(f"SELECT * FROM pos_payments WHERE date_key >= {CUTOFF_KEY} AND currency <> '-1'",
                    "pos_payments")),
    "filter_current_rows": Query(
        lambda spark, sf: current(table(spark, sf, "partner_companies")),
        with_tables("SELECT * FROM partner_companies WHERE valid_until IS NULL", "partner_companies")),
    "filter_not_null": Query(
        lambda spark, sf: table(spark, sf, "dirty_orders").filter(F.col("customer_id").isNotNull()).select(
            "order_number", "customer_id"),
        with_tables("SELECT order_number, customer_id FROM dirty_orders WHERE customer_id IS NOT NULL",
                    "dirty_orders")),
    "filter_like_and_prefix": Query(
        lambda spark, sf: table(spark, sf, "registry_rows").filter(
            F.col("valid_to").like("%9999%") & F.col("system_flag").like("SYS%")
            & F.col("key").startswith("P_M")).select("key", "valid_to", "system_flag"),
        with_tables("""SELECT key, valid_to, system_flag FROM registry_rows WHERE valid_to LIKE '%9999%'
        AND system_flag LIKE 'SYS%' AND regexp_matches(key, '^P_M')""", "registry_rows")),
    "filter_sentinels": Query(
        lambda spark, sf: table(spark, sf, "partner_companies").filter(
            ~F.col("company_code").isin("-1", "-2", "-3", "-4", "-5")).select("company_key", "company_code"),
        with_tables("""SELECT company_key, company_code FROM partner_companies
        WHERE company_code NOT IN ('-1', '-2', '-3', '-4', '-5')""", "partner_companies")),
    "filter_in_list": Query(
        lambda spark, sf: table(spark, sf, "orders").filter(
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority"),
        """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""),
    "filter_after_date": Query(
        lambda spark, sf: table(spark, sf, "entities").filter(
            F.col("vintage_date") > dates.as_date("1997-03-29")).select("entity_key", "vintage_date"),
        with_tables("SELECT entity_key, vintage_date FROM entities WHERE vintage_date > DATE '1997-03-29'",
                    "entities")),
    "filter_blank": Query(
        lambda spark, sf: table(spark, sf, "dirty_entities").filter(
            is_blank("name") | is_blank("entity_key")).select("position", "name", "entity_key"),
        with_tables("""SELECT position, name, entity_key FROM dirty_entities
        WHERE TRIM(name) = '' OR TRIM(entity_key) = ''""", "dirty_entities")),
    "facet_filter": Query(
        lambda spark, sf: filters.facets(
            _report(spark, sf),
            {"status": ["FAIL"], "severity": ["critical", "warning"], "check_name": [], "absent": ["x"]},
            search="CONTAINS"),
        with_tables(f"""SELECT {REPORT} FROM ({ORDER_RESULTS}) WHERE status = 'FAIL'
        AND severity IN ('critical', 'warning') AND LOWER(message) LIKE '%contains%'""", "dirty_orders")),
    "any_cell_search": Query(
        lambda spark, sf: filters.any_cell(table(spark, sf, "part"), "brand#1[0-2]$|RED"),
        """SELECT * FROM part WHERE regexp_matches(CAST(p_partkey AS VARCHAR), '(?i)brand#1[0-2]$|RED')
        OR regexp_matches(p_name, '(?i)brand#1[0-2]$|RED') OR regexp_matches(p_brand, '(?i)brand#1[0-2]$|RED')
        OR regexp_matches(p_type, '(?i)brand#1[0-2]$|RED')"""),
    "any_cell_text": Query(
        lambda spark, sf: filters.any_cell(table(spark, sf, "documents"), "$", pattern=False).select("doc_id"),
        """SELECT doc_id FROM documents WHERE LOWER(text) LIKE '%$%' OR LOWER(lang) LIKE '%$%'
        OR LOWER(source) LIKE '%$%'"""),
    "preview_rows": Query(
        lambda spark, sf: filters.preview(table(spark, sf, "orders"), ["o_orderkey"], 20),
        "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20"),
    "project_rename": Query(
        lambda spark, sf: rename(table(spark, sf, "customer"), {"id": "c_custkey", "name": "c_name"}),
        "SELECT c_custkey AS id, c_name AS name FROM customer"),
    "project_present": Query(
        lambda spark, sf: project(table(spark, sf, "customer"), ["c_name", "vat_number", "c_custkey"]),
        "SELECT c_name, c_custkey FROM customer"),
    "project_literals": Query(
        lambda spark, sf: table(spark, sf, "supplier").select(
            F.lit("PARTNER").alias("source"), "s_suppkey", F.lit(None).cast("string").alias("legal_form"),
            F.lit(None).cast("int").alias("active_contracts")),
        """SELECT 'PARTNER' AS source, s_suppkey, CAST(NULL AS VARCHAR) AS legal_form,
          CAST(NULL AS INTEGER) AS active_contracts FROM supplier"""),
    "project_replace_drop": Query(
        lambda spark, sf: table(spark, sf, "customer").withColumn("c_name", F.lower("c_name")).withColumn(
            "is_debtor", F.col("c_acctbal") < 0).drop("c_mktsegment").withColumnRenamed("c_custkey", "id"),
        """SELECT c_custkey AS id, LOWER(c_name) AS c_name, c_nationkey, c_acctbal, c_acctbal < 0 AS is_debtor
        FROM customer"""),
    "project_prefix": Query(
        lambda spark, sf: (lambda df: df.select("event_id", *columns_with_prefix(df, "risk_")))(
            table(spark, sf, "registry_risks")),
        with_tables("""SELECT event_id, risk_score, risk_label, risk_original, risk_manual, risk_inherited, risk_comment
        FROM registry_risks""", "registry_risks")),
    "columns_found": Query(
        _columns_found,
        with_tables("""SELECT COUNT(*) AS "rows", 'order_id, status' AS present, 'currency, region' AS missing
        FROM dirty_orders""", "dirty_orders")),
    "code_list": Query(
        lambda spark, sf: code_list(table(spark, sf, "reference_codes"), "ContStatus"),
        with_tables("""SELECT code, institution, description FROM reference_codes
        WHERE code_type = 'ContStatus'""", "reference_codes")),
    "top_orders": Query(
        lambda spark, sf: table(spark, sf, "orders").orderBy(
            F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10).select("o_orderkey", "o_totalprice"),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "union_sources": Query(
        lambda spark, sf: table(spark, sf, "customer").select(
            F.lit("C").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).unionByName(
            table(spark, sf, "supplier").select(
                F.col("s_name").alias("name"), F.lit("S").alias("kind"), F.col("s_suppkey").alias("id"))),
        """SELECT 'C' AS kind, c_custkey AS id, c_name AS name FROM customer
        UNION ALL SELECT 'S', s_suppkey, s_name FROM supplier"""),
}
