"""Entity tables built from facts and dimensions."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import CUTOFF_KEY, Query, REPORTING_DATE, table, with_tables
from assayframe.operators.frequency import distributions, frequency
from assayframe.plans import entity_base
from assayframe.sources.files import project

POS_TABLES = ("pos_contracts", "pos_companies", "pos_terms", "pos_payments")
PARTNER_TABLES = (
    "partner_companies", "partner_accounts", "partner_transactions", "partner_contracts",
    "reference_codes", "partner_categories", "partner_details",
)


def pos_base(spark, sf):
    return entity_base.contract_base(
        *[table(spark, sf, name) for name in POS_TABLES],
        reporting_date=REPORTING_DATE, source="TERMINAL", id_prefix="TAX;")


def partner_base(spark, sf):
    return entity_base.company_base(
        *[table(spark, sf, name) for name in PARTNER_TABLES],
        reporting_date=REPORTING_DATE, source="PARTNER")


def both(spark, sf):
    return entity_base.combined_base(pos_base(spark, sf), partner_base(spark, sf))


_DATE = "CAST(strptime(CAST({} AS VARCHAR), '%Y%m%d') AS DATE)"


def _activity_sql(source: str, key: str) -> str:
    return f"""
        SELECT {key} AS k, COUNT(CASE WHEN date_key >= {CUTOFF_KEY} THEN 1 END) AS n,
          CAST(SUM(CASE WHEN date_key >= {CUTOFF_KEY} THEN CAST(amount AS DECIMAL(20,2)) END) AS DECIMAL(20,2)) AS total,
          CAST(MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN amount END) AS DECIMAL(20,2)) AS largest,
          MIN(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS first_key,
          MAX(CASE WHEN date_key >= {CUTOFF_KEY} THEN date_key END) AS recent_key,
          MAX(date_key) AS last_key FROM {source} GROUP BY {key}"""


_SHARED = f"""
          {_DATE.format('a.last_key')} AS last_trx_date, {_DATE.format('a.first_key')} AS first_trx_date_12m,
          {_DATE.format('a.recent_key')} AS recent_trx_date_12m, COALESCE(a.n, 0) AS trx_count_12m,
          CAST(COALESCE(a.total, 0) AS DECIMAL(20,2)) AS total_msv_12m_eur, a.largest AS max_trx_amount_12m_eur,
          CASE WHEN a.n > 0 THEN 'Active in last 12 months' ELSE 'No transactions in last 12 months' END AS activity_detail_status,
          CASE WHEN a.n > 0 THEN 'Active' ELSE 'Inactive' END AS merchant_activity_status,"""

_STRIP = "CASE WHEN {0} IN ('-1', '') THEN NULL ELSE regexp_replace({0}, '^TAX;', '') END"
_VAT, _KVK = _STRIP.format("p.vat_number"), _STRIP.format("p.kvk_number")

POS_SQL = f"""
        SELECT 'TERMINAL' AS source, 'TERMINAL:' || contract_id AS entity_key, contract_id AS id,
          CAST(NULL AS VARCHAR) AS source_code_ref, com.name, {_VAT} AS vat_number, {_KVK} AS kvk_number, com.country,
          {_SHARED}
          'CP' AS type_of_activity, 'F2F' AS contracting_method, CAST(NULL AS VARCHAR) AS legal_form,
          CAST(t.mcc AS VARCHAR) AS mcc, com.vintage_date,
          CASE WHEN p.ended_on IS NULL THEN 'Active' ELSE 'Terminated' END AS contract_status,
          CAST(NULL AS BIGINT) AS active_contracts, CAST(NULL AS VARCHAR) AS contract_category_descriptions,
          concat_ws('; ', CASE WHEN {_VAT} IS NULL THEN 'missing_vat' END, CASE WHEN {_KVK} IS NULL THEN 'missing_kvk' END,
            CASE WHEN t.mcc IS NULL THEN 'missing_mcc' END,
            CASE WHEN com.vintage_date IS NULL THEN 'missing_vintage' END) AS data_quality_notes
        FROM pos_contracts p LEFT JOIN pos_companies com ON p.company_key = com.company_key
          LEFT JOIN pos_terms t ON p.contract_key = t.contract_key
          LEFT JOIN ({_activity_sql("(SELECT * FROM pos_payments WHERE currency <> '-1')", 'contract_key')}) a
            ON p.contract_key = a.k"""

_SETTLED = """(SELECT s.company_key, f.amount, f.date_key FROM partner_transactions f
            JOIN partner_accounts s ON f.account_key = s.account_key
            WHERE f.clearing_state = 41 AND s.valid_until IS NULL)"""


def _class(both_name: str, first: str, second: str) -> str:
    return (f"CASE WHEN ct.f2f = 1 AND ct.nf2f = 1 THEN '{both_name}' WHEN ct.f2f = 1 THEN '{first}' "
            f"WHEN ct.nf2f = 1 THEN '{second}' ELSE 'Unknown' END")


PARTNER_SQL = f"""
        SELECT 'PARTNER' AS source, 'PARTNER:' || com.company_code AS entity_key, com.company_code AS id,
          ods.source_code_ref, com.name, com.vat_number, ods.kvk_number, com.country,
          {_SHARED}
          {_class('CP+CNP', 'CP', 'CNP')} AS type_of_activity, {_class('F2F+NF2F', 'F2F', 'NF2F')} AS contracting_method,
          ods.legal_form, CAST(m.mcc AS VARCHAR) AS mcc, ods.created_on AS vintage_date,
          COALESCE(com.status_text, 'Unknown') AS contract_status, COALESCE(ac.n, 0) AS active_contracts,
          ct.descriptions AS contract_category_descriptions,
          concat_ws('; ', CASE WHEN com.vat_number IS NULL THEN 'missing_vat' END,
            CASE WHEN ods.kvk_number IS NULL THEN 'missing_kvk' END,
            CASE WHEN ods.legal_form IS NULL THEN 'missing_legal_form' END,
            CASE WHEN m.mcc IS NULL THEN 'missing_mcc' END) AS data_quality_notes
        FROM partner_companies com
          LEFT JOIN ({_activity_sql(_SETTLED, 'company_key')}) a ON com.company_key = a.k
          LEFT JOIN (SELECT partner_id, COUNT(*) AS n FROM partner_contracts c JOIN reference_codes r
              ON CAST(c.status AS VARCHAR) = r.code AND c.institution = r.institution
              WHERE r.code_type = 'ContStatus' AND r.code = '1' GROUP BY partner_id) ac
            ON com.company_code = CAST(ac.partner_id AS VARCHAR)
          LEFT JOIN (SELECT company_key, MAX(CASE WHEN category IN (1, 9) THEN 1 ELSE 0 END) AS f2f,
              MAX(CASE WHEN category IN (8, 10) THEN 1 ELSE 0 END) AS nf2f,
              string_agg(DISTINCT category_description, ', ' ORDER BY category_description) AS descriptions
              FROM partner_categories WHERE contract_status = 1 GROUP BY company_key) ct
            ON com.company_key = ct.company_key
          LEFT JOIN (SELECT company_key, MIN(mcc) AS mcc FROM partner_accounts
              WHERE valid_until IS NULL GROUP BY company_key) m ON com.company_key = m.company_key
          LEFT JOIN (SELECT CAST(partner_id AS VARCHAR) AS partner_id, NULLIF(TRIM(legal_form), '') AS legal_form,
              NULLIF(TRIM(kvk_number), '') AS kvk_number, created_on, source_code_ref
              FROM partner_details WHERE valid_until IS NULL) ods ON com.company_code = ods.partner_id
        WHERE com.valid_until IS NULL AND com.company_code NOT IN ('-1', '-2', '-3', '-4', '-5')"""

_ALL = (*POS_TABLES, *PARTNER_TABLES)
_UNION = f"""SELECT * FROM ({POS_SQL}) UNION ALL BY NAME SELECT * FROM ({PARTNER_SQL})"""

QUERIES = {
    "entity_base_contracts": Query(pos_base, with_tables(POS_SQL, *POS_TABLES)),
    "entity_base_companies": Query(partner_base, with_tables(PARTNER_SQL, *PARTNER_TABLES)),
    "entity_base_combined": Query(both, with_tables(_UNION, *_ALL)),
    "entity_base_stored_columns": Query(
        lambda spark, sf: project(both(spark, sf), entity_base.STORED_COLUMNS),
        with_tables(f"SELECT {', '.join(entity_base.STORED_COLUMNS)} FROM ({_UNION})", *_ALL)),
    "base_by_activity": Query(
        lambda spark, sf: frequency(both(spark, sf), ["source", "merchant_activity_status"]),
        with_tables(f"""SELECT source, merchant_activity_status, COUNT(*) AS "count" FROM ({_UNION})
        GROUP BY source, merchant_activity_status""", *_ALL)),
    "base_cuts": Query(
        lambda spark, sf: distributions(
            both(spark, sf),
            [("source", "merchant_activity_status"), ("source", "contract_status"), ("country",)],
            {"merchants": F.count(F.lit(1)), "msv": F.sum("total_msv_12m_eur").cast("decimal(20,2)")}),
        with_tables(f"""WITH b AS ({_UNION})
        SELECT 0 AS cut, source, merchant_activity_status, NULL AS contract_status, NULL AS country,
          COUNT(*) AS merchants, CAST(SUM(total_msv_12m_eur) AS DECIMAL(20,2)) AS msv FROM b GROUP BY source, merchant_activity_status
        UNION ALL SELECT 1, source, NULL, contract_status, NULL, COUNT(*), CAST(SUM(total_msv_12m_eur) AS DECIMAL(20,2))
          FROM b GROUP BY source, contract_status
        UNION ALL SELECT 2, NULL, NULL, NULL, country, COUNT(*), CAST(SUM(total_msv_12m_eur) AS DECIMAL(20,2))
          FROM b GROUP BY country""", *_ALL)),
}
