"""How a query is registered, and the derived tables the queries start from.

The driver tables hold no nulls and no broken values.  ``DERIVED`` therefore states
tables with injected defects, and entity, fact and registry tables, as SQL that both
engines can run.  Spark reads them as DataFrames; the SQL counterparts use the same
text as common table expressions, so both sides start from equal rows and compute
the result independently.
"""
from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# Declared, so that no query starts with a job that only reads file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = list(SCHEMAS)


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or a derived table by name."""
    if name in TABLES:
        return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    text = DERIVED[name]
    inputs = {n: table(spark, sf_dir, n) for n in _inputs(text)}
    return spark.sql(text, **inputs)


def _inputs(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def with_tables(body: str, *names: str) -> str:
    """SQL text whose common table expressions are the named derived tables."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for inner in _inputs(DERIVED[name]):
            visit(inner)
        ordered.append(name)

    for name in names:
        visit(name)
    ctes = []
    for name in ordered:
        text = DERIVED[name]
        ctes.append(f"{name} AS ({text.format(**{n: n for n in _inputs(text)})})")
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ", ".join([*ctes, body[5:]])
    return "WITH " + ", ".join(ctes) + " " + body


def date_key(column: str) -> str:
    return f"CAST(REPLACE(CAST(CAST({column} AS DATE) AS STRING), '-', '') AS INT)"


def padded_key(column: str) -> str:
    return f"'P_M' || LPAD(CAST({column} AS STRING), 13, '0')"


REPORTING_DATE = "2001-06-30"
CUTOFF_KEY = 20000630

DERIVED = {
    # Orders with every kind of defect the checks look for.
    "dirty_orders": """
        SELECT
          CASE WHEN o_orderkey % 97 = 0 THEN NULL
               WHEN o_orderkey % 50 = 1 THEN CAST(o_orderkey - 1 AS STRING)
               ELSE CAST(o_orderkey AS STRING) END AS order_id,
          CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id,
          CASE o_orderkey % 31 WHEN 0 THEN 'abc' WHEN 1 THEN '-5' WHEN 2 THEN '1e3'
               WHEN 3 THEN 'nan' WHEN 4 THEN '3,5' WHEN 5 THEN '' WHEN 6 THEN NULL
               WHEN 7 THEN '0' WHEN 8 THEN '1d' WHEN 9 THEN ' 7 '
               ELSE CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS STRING) END AS amount,
          CASE o_orderkey % 23 WHEN 0 THEN '2025-13-01' WHEN 1 THEN '31/12/2024'
               WHEN 2 THEN '0000-00-00' WHEN 3 THEN NULL WHEN 4 THEN '2025-02-29'
               WHEN 5 THEN 'not-a-date' WHEN 6 THEN '2024-02-29'
               ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
          CASE o_orderkey % 29 WHEN 0 THEN 'X' WHEN 1 THEN LOWER(o_orderstatus)
               WHEN 2 THEN ' ' || o_orderstatus WHEN 3 THEN NULL
               ELSE o_orderstatus END AS status,
          CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END AS priority,
          o_orderkey AS order_number,
          o_totalprice AS total
        FROM {orders}
    """,
    # Contracts of source 1, with sentinel and missing tax ids.
    "pos_contracts": """
        SELECT CAST(c_custkey AS STRING) AS contract_id, c_custkey AS company_key,
          c_custkey AS contract_key,
          CASE c_custkey % 10 WHEN 0 THEN '-1' WHEN 1 THEN '' WHEN 2 THEN NULL
               WHEN 3 THEN 'V' || CAST(c_custkey AS STRING)
               ELSE 'TAX;V' || CAST(c_custkey AS STRING) END AS vat_number,
          CASE c_custkey % 7 WHEN 0 THEN '-1' WHEN 1 THEN NULL
               ELSE 'TAX;K' || CAST(c_custkey AS STRING) END AS kvk_number,
          CASE WHEN c_custkey % 5 = 0 THEN CAST('2001-01-01' AS DATE) ELSE NULL END AS ended_on
        FROM {customer}
    """,
    "pos_companies": """
        SELECT c_custkey AS company_key, c_name AS name, n_name AS country,
          CASE WHEN c_custkey % 12 = 0 THEN NULL
               ELSE CAST('1995-01-01' AS DATE) + CAST(c_custkey % 2000 AS INT) END AS vintage_date
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
    """,
    "pos_terms": """
        SELECT c_custkey AS contract_key,
          CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 5000 + c_custkey % 500 END AS mcc
        FROM {customer}
    """,
    "pos_payments": f"""
        SELECT o_custkey AS contract_key, o_totalprice AS amount,
          {date_key('o_orderdate')} AS date_key,
          CASE WHEN o_orderkey % 17 = 0 THEN '-1' WHEN o_orderkey % 19 = 0 THEN NULL
               ELSE 'EUR' END AS currency,
          o_orderstatus AS service_type
        FROM {{orders}}
    """,
    # Companies of source 2, with old versions, and the tables around them.
    "partner_companies": """
        SELECT s_suppkey AS company_key,
          CASE WHEN s_suppkey % 50 = 49 THEN '-1' ELSE CAST(s_suppkey AS STRING) END AS company_code,
          s_name AS name,
          CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'V' || CAST(s_suppkey AS STRING) END AS vat_number,
          n_name AS country,
          CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'Cancelled' ELSE 'Active' END AS status_text,
          CAST(NULL AS DATE) AS valid_until
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
        UNION ALL
        SELECT s_suppkey, CAST(s_suppkey AS STRING), LOWER(s_name), NULL, 'OLD', 'Entered',
          CAST('1999-12-31' AS DATE)
        FROM {supplier}
    """,
    "partner_accounts": """
        SELECT s_suppkey * 10 AS account_key, s_suppkey AS company_key,
          CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 5000 + s_suppkey % 100 END AS mcc,
          CAST(NULL AS DATE) AS valid_until
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 10 + 1, s_suppkey, 4000 + s_suppkey % 100, CAST(NULL AS DATE)
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 10 + 2, s_suppkey, 3000, CAST('1999-12-31' AS DATE) FROM {supplier}
    """,
    "partner_transactions": f"""
        SELECT l_suppkey * 10 + l_linenumber % 3 AS account_key, l_extendedprice AS amount,
          {date_key('l_shipdate')} AS date_key,
          CASE WHEN l_returnflag = 'R' THEN 40 ELSE 41 END AS clearing_state
        FROM {{lineitem}}
    """,
    "partner_contracts": """
        SELECT l_suppkey AS partner_id, l_linenumber % 3 AS status,
          'I' || CAST(l_partkey % 3 AS STRING) AS institution
        FROM {lineitem}
    """,
    "reference_codes": """
        SELECT CASE WHEN r_regionkey < 3 THEN 'ContStatus' ELSE 'AccStatus' END AS code_type,
          CASE WHEN r_regionkey IN (0, 1, 3) THEN '1' ELSE '2' END AS code,
          CASE WHEN r_regionkey = 1 THEN 'I1' ELSE 'I0' END AS institution,
          r_name AS description
        FROM {region}
    """,
    "partner_categories": """
        SELECT l_suppkey AS company_key,
          CASE WHEN l_suppkey % 4 = 0 THEN CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 9 END
               WHEN l_suppkey % 4 = 1 THEN CASE WHEN l_partkey % 2 = 0 THEN 8 ELSE 10 END
               WHEN l_suppkey % 4 = 2 THEN CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE 10 END
               ELSE 5 END AS category,
          CASE WHEN l_partkey % 2 = 0 THEN 'even terms' ELSE 'odd terms' END AS category_description,
          l_linenumber % 2 AS contract_status
        FROM {lineitem}
    """,
    "partner_details": """
        SELECT s_suppkey AS partner_id,
          CASE s_suppkey % 8 WHEN 0 THEN '   ' WHEN 1 THEN NULL WHEN 2 THEN ' BV ' ELSE 'NV' END AS legal_form,
          CASE s_suppkey % 9 WHEN 0 THEN '' ELSE ' K' || CAST(s_suppkey AS STRING) || ' ' END AS kvk_number,
          CAST('1996-01-01' AS DATE) + CAST(s_suppkey % 1500 AS INT) AS created_on,
          'REF' || CAST(s_suppkey AS STRING) AS source_code_ref,
          CAST(NULL AS DATE) AS valid_until
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey, 'OLD', 'OLD', CAST('1990-01-01' AS DATE), 'OLD', CAST('1999-12-31' AS DATE)
        FROM {supplier}
    """,
    # The registry: rows of customers, with history, other systems and persons.
    "registry_rows": f"""
        SELECT {padded_key('c_custkey')} AS key,
          CASE WHEN c_custkey % 13 = 0 THEN '20000101' ELSE '99991231' END AS valid_to,
          CASE WHEN c_custkey % 11 = 0 THEN 'OTHER' ELSE 'SYS1' END AS system_flag,
          ' ' || UPPER(c_name) || ' ' AS name, ' Street ' || CAST(c_nationkey AS STRING) AS street,
          CAST(1000 + c_custkey % 9000 AS STRING) || 'AB ' AS postal_code,
          ' City' || CAST(c_nationkey AS STRING) AS city, CAST(5000 + c_custkey % 500 AS STRING) AS mcc,
          'N' || CAST(c_nationkey AS STRING) AS country,
          CASE c_custkey % 9 WHEN 0 THEN ' besloten vennootschap met zetel ' WHEN 1 THEN 'EENMANSZAAK'
               WHEN 2 THEN 'Vennootschap onder Firma' WHEN 3 THEN 'Commanditaire venn.'
               WHEN 4 THEN 'stichting X' WHEN 5 THEN 'Vereniging Y' WHEN 6 THEN 'publiekrechtelijk lichaam'
               WHEN 7 THEN ' Other Form ' ELSE NULL END AS legal_form,
          CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE ' K' || CAST(c_custkey AS STRING) END AS kvk,
          CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'D' || CAST(c_custkey AS STRING) END AS duns_id,
          CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'V' || CAST(c_custkey AS STRING) END AS vat,
          CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE 'R' || CAST(c_custkey AS STRING) END AS registry_number,
          c_mktsegment || ' ' AS customer_type
        FROM {{customer}} WHERE c_acctbal > 2000
        UNION ALL
        SELECT 'P_P' || LPAD(CAST(s_suppkey AS STRING), 13, '0'), '99991231', 'SYS1', s_name, NULL, NULL,
          NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM {{supplier}}
    """,
    "registry_risks": f"""
        SELECT {padded_key('user_id')} AS key, CAST(ts AS STRING) AS valid_from,
          CASE WHEN event_id % 10 = 0 THEN '20240101' ELSE '99991231' END AS valid_to,
          CASE event_type WHEN 'view' THEN 'Low' WHEN 'click' THEN ' Medium' WHEN 'signup' THEN 'High '
               WHEN 'error' THEN 'VeryHigh' ELSE 'Low' END AS risk_score,
          event_type || ' risk' AS risk_label, event_type AS risk_original,
          CASE WHEN event_id % 3 = 0 THEN ' ' ELSE 'man' || CAST(event_id % 7 AS STRING) END AS risk_manual,
          CASE WHEN event_id % 4 = 0 THEN NULL ELSE ' parent' END AS risk_inherited,
          CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'CLEAN' END AS screening_status,
          'OPEN' || CAST(event_id % 3 AS STRING) AS screening_pstatus,
          CAST(event_id % 100 AS STRING) AS watchlist_hit_pct,
          CASE WHEN event_id % 2 = 0 THEN '' ELSE 'LIST' || CAST(event_id % 4 AS STRING) END AS watchlist_list,
          CAST(event_id % 2 AS STRING) AS embargo_hit_pct, CAST(event_id % 3 AS STRING) AS pep_hit_pct,
          CASE event_id % 6 WHEN 0 THEN ' ' WHEN 1 THEN '20011301' WHEN 2 THEN '20010101'
               ELSE '20020615' END AS next_review,
          CASE WHEN event_id % 7 = 0 THEN ' seen ' ELSE '' END AS risk_comment,
          event_id
        FROM {{events}}
    """,
    "registry_links": f"""
        SELECT {padded_key('user_id')} AS key,
          'P_P' || LPAD(CAST(event_id % 40 AS STRING), 13, '0') AS person_key,
          CASE WHEN event_type IN ('view', 'click') THEN 'BO ' ELSE ' SI' END AS link_type,
          CASE WHEN event_id % 8 = 0 THEN '20240101' ELSE '99991231' END AS valid_to
        FROM {{events}}
    """,
    # Entities from two sources with ids that need normalising or hold no digits.
    "entities": """
        SELECT 'TERMINAL' AS source, 'TERMINAL:' || CAST(c_custkey AS STRING) AS entity_key,
          CASE WHEN c_custkey % 20 = 0 THEN 'no digits' WHEN c_custkey % 20 = 1 THEN NULL
               WHEN c_custkey % 20 = 2 THEN 'SRC;' || CAST(c_custkey AS STRING)
               ELSE CAST(c_custkey AS STRING) END AS id,
          c_name AS name, 'N' || CAST(c_nationkey AS STRING) AS country,
          CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'Inactive' END AS merchant_activity_status,
          CASE c_custkey % 3 WHEN 0 THEN 'Active' WHEN 1 THEN 'Terminated' ELSE NULL END AS contract_status,
          CAST('1995-01-01' AS DATE) + CAST(c_custkey % 2000 AS INT) AS vintage_date,
          CAST(c_acctbal AS DECIMAL(20,2)) AS total_msv_12m_eur
        FROM {customer}
        UNION ALL
        SELECT 'PARTNER', 'PARTNER:' || CAST(s_suppkey AS STRING), 'S-' || CAST(s_suppkey AS STRING), s_name,
          'N' || CAST(s_nationkey AS STRING),
          CASE WHEN s_acctbal > 5000 THEN 'Active' ELSE 'Inactive' END,
          CASE WHEN s_suppkey % 2 = 0 THEN 'Cancelled' ELSE 'Active' END,
          CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST('1997-01-01' AS DATE) END,
          CAST(s_acctbal AS DECIMAL(20,2))
        FROM {supplier}
    """,
    # Entities as stored text with blanks, foreign values, bad dates and repeated ids.
    "dirty_entities": """
        SELECT c_custkey AS position,
          CASE c_custkey % 14 WHEN 0 THEN '' WHEN 1 THEN 'OTHER' WHEN 2 THEN 'TERMINAL' ELSE 'PARTNER' END AS source,
          CASE WHEN c_custkey % 15 = 0 THEN ' ' ELSE 'K' || CAST(c_custkey AS STRING) END AS entity_key,
          CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 3 = 0 THEN 'DUP'
               WHEN c_custkey % 8 = 1 THEN CAST(c_custkey - 1 AS STRING)
               ELSE CAST(c_custkey AS STRING) END AS id,
          CASE WHEN c_custkey % 25 = 0 THEN '  ' ELSE c_name END AS name,
          CASE c_custkey % 6 WHEN 0 THEN 'ZZ' WHEN 1 THEN '' ELSE 'NL' END AS country,
          CASE c_custkey % 5 WHEN 0 THEN 'Dormant?' ELSE 'Never transacted' END AS activity_detail_status,
          CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'paused' END AS merchant_activity_status,
          CASE c_custkey % 4 WHEN 0 THEN 'QR_ONLY' WHEN 1 THEN 'CP' ELSE 'CP+CNP' END AS type_of_activity,
          'F2F' AS contracting_method,
          CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'Entered' END AS contract_status,
          CASE c_custkey % 7 WHEN 0 THEN '2026-99-99' WHEN 1 THEN '' WHEN 2 THEN 'not-a-date'
               ELSE CAST(CAST('2000-01-01' AS DATE) + CAST(c_custkey % 900 AS INT) AS STRING) END AS last_trx_date,
          CASE WHEN c_custkey % 2 = 0 THEN '' ELSE '2020-02-29' END AS vintage_date,
          CASE WHEN c_custkey % 3 = 0 THEN '5411' ELSE '' END AS mcc,
          CASE WHEN c_custkey % 50 = 0 THEN '' ELSE 'V' || CAST(c_custkey AS STRING) END AS vat_number,
          CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'K' || CAST(c_custkey AS STRING) END AS kvk_number,
          '' AS legal_form, '' AS active_contracts, 'Retail payments' AS contract_category_descriptions
        FROM {customer}
    """,
}
