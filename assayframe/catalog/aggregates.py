"""Aggregations, windows and severity order."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import CUTOFF_KEY, Query, REPORTING_DATE, table, with_tables
from assayframe.functions import classes
from assayframe.functions.text import map_value
from assayframe.operators import frequency
from assayframe.operators.rowid import mark_repeats, occurrence, with_row_id
from assayframe.plans import entity_base

PRIORITY_RANK = {"5-LOW": 0, "4-NOT SPECIFIED": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}


def _payments(spark, sf):
    return table(spark, sf, "pos_payments").filter(F.col("currency") != "-1")


def _activity(spark, sf):
    return entity_base.activity(
        _payments(spark, sf), "contract_key", REPORTING_DATE, service="service_type")


_ACTIVITY_SQL = f"""
    SELECT contract_key,
      COUNT(CASE WHEN date_key >= {CUTOFF_KEY} THEN 1 END) AS trx_count_12m,
      CAST(SUM(CASE WHEN date_key >= {CUTOFF_KEY} THEN CAST(amount AS DECIMAL(20,2)) END) AS DECIMAL(20,2)) AS total_msv_12m_eur,
      CAST(MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN amount END) AS DECIMAL(20,2)) AS max_trx_amount_12m_eur,
      MIN(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS first_trx_key_12m,
      MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS recent_trx_key_12m,
      MAX(date_key) AS last_trx_key
    FROM pos_payments WHERE currency <> '-1' GROUP BY contract_key"""


def _step_change(spark, sf):
    """Change of order volume from year to year, a summary of a handful of rows."""
    yearly = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("double").alias("volume"),
        F.count(F.lit(1)).alias("orders"))
    return frequency.step_change(yearly, "year", {"volume": "volume_delta", "orders": "orders_delta"})


def _ranked(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    rank = map_value(F.col("o_orderpriority"), PRIORITY_RANK, 9)
    return counts.withColumn("severity", rank).orderBy("severity")


QUERIES = {
    "activity_metrics": Query(
        lambda spark, sf: _activity(spark, sf).withColumn(
            "service_types", F.array_join("service_types", ",")),
        with_tables(f"""WITH a AS ({_ACTIVITY_SQL}), s AS (
            SELECT contract_key, string_agg(DISTINCT service_type, ',' ORDER BY service_type) AS service_types
            FROM pos_payments WHERE currency <> '-1' AND date_key >= {CUTOFF_KEY} GROUP BY contract_key)
          SELECT a.*, COALESCE(s.service_types, '') AS service_types FROM a LEFT JOIN s USING (contract_key)""",
                    "pos_payments")),
    "last_activity": Query(
        lambda spark, sf: _activity(spark, sf).select("contract_key", "last_trx_key"),
        with_tables("""SELECT contract_key, MAX(date_key) AS last_trx_key FROM pos_payments
        WHERE currency <> '-1' GROUP BY contract_key""", "pos_payments")),
    "activity_class": Query(
        lambda spark, sf: _activity(spark, sf).select(
            "contract_key", classes.activity_detail(F.col("trx_count_12m")).alias("detail"),
            classes.activity_status(F.col("trx_count_12m")).alias("status")),
        with_tables(f"""SELECT contract_key,
          CASE WHEN trx_count_12m > 0 THEN 'Active in last 12 months' ELSE 'No transactions in last 12 months' END AS detail,
          CASE WHEN trx_count_12m > 0 THEN 'Active' ELSE 'Inactive' END AS status FROM ({_ACTIVITY_SQL})""",
                    "pos_payments")),
    "activity_through_accounts": Query(
        lambda spark, sf: entity_base.activity_through(
            table(spark, sf, "partner_transactions").filter(F.col("clearing_state") == 41),
            entity_base.current(table(spark, sf, "partner_accounts")),
            "account_key", "company_key", REPORTING_DATE),
        with_tables(f"""SELECT s.company_key,
          COUNT(CASE WHEN date_key >= {CUTOFF_KEY} THEN 1 END) AS trx_count_12m,
          CAST(SUM(CASE WHEN date_key >= {CUTOFF_KEY} THEN CAST(amount AS DECIMAL(20,2)) END) AS DECIMAL(20,2)) AS total_msv_12m_eur,
          CAST(MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN amount END) AS DECIMAL(20,2)) AS max_trx_amount_12m_eur,
          MIN(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS first_trx_key_12m,
          MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS recent_trx_key_12m,
          MAX(date_key) AS last_trx_key
        FROM partner_transactions f JOIN partner_accounts s ON f.account_key = s.account_key
        WHERE clearing_state = 41 AND s.valid_until IS NULL GROUP BY s.company_key""",
                    "partner_transactions", "partner_accounts")),
    "active_contracts": Query(
        lambda spark, sf: entity_base.active_contracts(
            table(spark, sf, "partner_contracts"), table(spark, sf, "reference_codes")),
        with_tables("""SELECT partner_id, COUNT(*) AS active_contracts FROM partner_contracts c
        JOIN reference_codes r ON CAST(c.status AS VARCHAR) = r.code AND c.institution = r.institution
        WHERE r.code_type = 'ContStatus' AND r.code = '1' GROUP BY partner_id""",
                    "partner_contracts", "reference_codes")),
    "category_text": Query(
        lambda spark, sf: frequency.category_text(table(spark, sf, "part"), "p_brand", "p_type"),
        """SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS p_type FROM part GROUP BY p_brand"""),
    "channel_class": Query(
        lambda spark, sf: entity_base.contract_categories(table(spark, sf, "partner_categories")).select(
            "company_key", "contract_category_descriptions",
            classes.activity_channel(F.col("contract_categories")).alias("type_of_activity"),
            classes.contracting_channel(F.col("contract_categories")).alias("contracting_method")),
        with_tables("""SELECT company_key,
          string_agg(DISTINCT category_description, ', ' ORDER BY category_description) AS contract_category_descriptions,
          CASE WHEN MAX(CASE WHEN category IN (1, 9) THEN 1 ELSE 0 END) = 1
                AND MAX(CASE WHEN category IN (8, 10) THEN 1 ELSE 0 END) = 1 THEN 'CP+CNP'
               WHEN MAX(CASE WHEN category IN (1, 9) THEN 1 ELSE 0 END) = 1 THEN 'CP'
               WHEN MAX(CASE WHEN category IN (8, 10) THEN 1 ELSE 0 END) = 1 THEN 'CNP' ELSE 'Unknown' END AS type_of_activity,
          CASE WHEN MAX(CASE WHEN category IN (1, 9) THEN 1 ELSE 0 END) = 1
                AND MAX(CASE WHEN category IN (8, 10) THEN 1 ELSE 0 END) = 1 THEN 'F2F+NF2F'
               WHEN MAX(CASE WHEN category IN (1, 9) THEN 1 ELSE 0 END) = 1 THEN 'F2F'
               WHEN MAX(CASE WHEN category IN (8, 10) THEN 1 ELSE 0 END) = 1 THEN 'NF2F' ELSE 'Unknown' END AS contracting_method
        FROM partner_categories WHERE contract_status = 1 GROUP BY company_key""", "partner_categories")),
    "min_code": Query(
        lambda spark, sf: entity_base.representative(
            entity_base.current(table(spark, sf, "partner_accounts")), "company_key", "mcc"),
        with_tables("""SELECT company_key, MIN(mcc) AS mcc FROM partner_accounts
        WHERE valid_until IS NULL AND mcc IS NOT NULL GROUP BY company_key""", "partner_accounts")),
    "frequency_one": Query(
        lambda spark, sf: frequency.most_frequent(table(spark, sf, "events"), ["event_type"]),
        'SELECT event_type, COUNT(*) AS "count" FROM events GROUP BY event_type'),
    "frequency_two": Query(
        lambda spark, sf: frequency.frequency(table(spark, sf, "documents"), ["lang", "source"]),
        'SELECT lang, source, COUNT(*) AS "count" FROM documents GROUP BY lang, source'),
    "distinct_beside_count": Query(
        lambda spark, sf: frequency.distinct_beside_count(table(spark, sf, "events"), "event_type", "user_id"),
        """SELECT event_type, COUNT(*) AS "count", COUNT(DISTINCT user_id) AS distinct_count
        FROM events GROUP BY event_type"""),
    "whole_row_distinct": Query(
        lambda spark, sf: table(spark, sf, "registry_links").distinct(),
        with_tables("SELECT DISTINCT * FROM registry_links", "registry_links")),
    "conditional_count": Query(
        lambda spark, sf: table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
            F.count(F.lit(1)).alias("lines"), F.count_if(F.col("l_linestatus") == "O").alias("open_lines")),
        """SELECT l_returnflag, COUNT(*) AS lines, COUNT(CASE WHEN l_linestatus = 'O' THEN 1 END) AS open_lines
        FROM lineitem GROUP BY l_returnflag"""),
    "global_counts": Query(
        lambda spark, sf: table(spark, sf, "lineitem").agg(
            F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_shipped")),
        "SELECT COUNT(*) AS lines, MAX(l_shipdate) AS last_shipped FROM lineitem"),
    "value_shares": Query(
        lambda spark, sf: frequency.shares(table(spark, sf, "orders"), "o_orderpriority"),
        """SELECT o_orderpriority, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS share
        FROM orders GROUP BY o_orderpriority"""),
    "share_of_group": Query(
        lambda spark, sf: frequency.share_of_group(
            table(spark, sf, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")),
            "lang", "docs", "pct_of_lang"),
        """SELECT lang, source, COUNT(*) AS docs,
          round_even(COUNT(*) * 1.0::DOUBLE / SUM(COUNT(*)) OVER (PARTITION BY lang) * 100, 2) AS pct_of_lang
        FROM documents GROUP BY lang, source"""),
    "latest_per_key": Query(
        lambda spark, sf: frequency.latest_per_key(
            table(spark, sf, "events"), ["user_id"], "ts", ["event_id"]),
        """SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, ROW_NUMBER() OVER (
          PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM events) WHERE rn = 1"""),
    "dense_row_id": Query(
        lambda spark, sf: with_row_id(
            table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                "l_extendedprice"),
            ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], plain_scan=True),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, ROW_NUMBER() OVER (
          ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS row_id FROM lineitem"""),
    # Over the result of a shuffle, which is written before it is numbered.
    "dense_row_id_after_group": Query(
        lambda spark, sf: with_row_id(
            table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(
                F.count(F.lit(1)).alias("lines")), ["l_suppkey", "l_returnflag"]),
        """SELECT l_suppkey, l_returnflag, COUNT(*) AS lines,
          ROW_NUMBER() OVER (ORDER BY l_suppkey, l_returnflag) - 1 AS row_id FROM lineitem GROUP BY 1, 2"""),
    "occurrence_number": Query(
        lambda spark, sf: occurrence(
            table(spark, sf, "events").select("event_id", "event_type"), ["event_type"], "event_id",
            block_rows=1000),
        """SELECT event_id, event_type, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS occurrence
        FROM events"""),
    "repeat_marks": Query(
        lambda spark, sf: mark_repeats(
            table(spark, sf, "dirty_orders").select("order_number", "order_id"), ["order_id"], "order_number"),
        with_tables("""SELECT order_number, order_id, ROW_NUMBER() OVER (
          PARTITION BY order_id ORDER BY order_number) > 1 AS is_repeat FROM dirty_orders""", "dirty_orders")),
    "step_change": Query(_step_change, """
        WITH y AS (SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS year,
          CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS volume, COUNT(*) AS orders
        FROM orders GROUP BY 1)
        SELECT year, volume, orders, COALESCE(round(volume - LAG(volume) OVER (ORDER BY year), 2), 0) AS volume_delta,
          COALESCE(orders - LAG(orders) OVER (ORDER BY year), 0) AS orders_delta FROM y"""),
    "severity_order": Query(_ranked, """
        SELECT o_orderpriority, COUNT(*) AS orders, CASE o_orderpriority WHEN '5-LOW' THEN 0
          WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 ELSE 4 END AS severity
        FROM orders GROUP BY o_orderpriority"""),
}
