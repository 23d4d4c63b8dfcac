"""Scalar functions, each over a whole table."""
from __future__ import annotations

from pyspark.sql import functions as F

from assayframe.catalog.base import CUTOFF_KEY, Query, REPORTING_DATE, table, with_tables
from assayframe.functions import classes, dates, keys, parse, text

# Both engines evaluate this text: an id column with letters, marks and long numbers.
RAW_ID = ("CASE WHEN c_custkey % 7 = 0 THEN 'SRC4;' || CAST(c_custkey AS STRING) "
          "WHEN c_custkey % 7 = 1 THEN NULL WHEN c_custkey % 7 = 2 THEN 'none' "
          "WHEN c_custkey % 7 = 3 THEN '12345678901234567' ELSE c_name END")


def _on(name, *columns):
    """A query that selects expressions from one table."""
    return lambda spark, sf: table(spark, sf, name).select(
        *[c() if callable(c) else c for c in columns])


def _hash_sample(spark, sf):
    df = table(spark, sf, "entities")
    key = keys.registry_key(F.col("id"))
    picked = keys.in_hash_sample(key, F.col("source"), {"Terminal": 0.714}, 0.353)
    return df.select("entity_key", key.alias("join_key"), picked.alias("in_sample"))


def _mojibake(spark, sf):
    docs = table(spark, sf, "documents")
    damaged = docs.withColumn(
        "text", F.decode(F.encode(F.col("text"), "UTF-8"), "ISO-8859-1"))
    return damaged.select(
        "doc_id", parse.repair_double_encoding(F.col("text")).alias("text"),
    )


def _mojibake_clean(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", parse.repair_double_encoding(F.col("text")).alias("text"))


QUERIES = {
    # Registry key: digits of the id, padded, never cut; junk gives no key.
    "join_key": Query(
        lambda spark, sf: table(spark, sf, "customer").select(
            "c_custkey", F.expr(RAW_ID).alias("raw_id")).select(
            "c_custkey", "raw_id",
            keys.digits_only(F.col("raw_id")).alias("digits"),
            keys.registry_key(F.col("raw_id")).alias("join_key"),
            keys.registry_key(F.col("raw_id"), truncate=True).alias("cut_key")),
        f"""SELECT c_custkey, raw_id, regexp_replace(raw_id, '[^0-9]', '', 'g') AS digits,
          CASE WHEN regexp_replace(raw_id, '[^0-9]', '', 'g') <> '' THEN
            'P_M' || repeat('0', GREATEST(0, 13 - LENGTH(regexp_replace(raw_id, '[^0-9]', '', 'g'))))
            || regexp_replace(raw_id, '[^0-9]', '', 'g') END AS join_key,
          'P_M' || LPAD(regexp_replace(raw_id, '[^0-9]', '', 'g'), 13, '0') AS cut_key
        FROM (SELECT c_custkey, {RAW_ID} AS raw_id FROM customer)"""),
    "prefix_strip": Query(
        _on("pos_contracts", "contract_id",
            lambda: keys.strip_prefix(F.col("vat_number"), "TAX;").alias("vat_number"),
            lambda: keys.strip_prefix(F.col("kvk_number"), "TAX;").alias("kvk_number")),
        with_tables("""SELECT contract_id,
          CASE WHEN vat_number IN ('-1', '') THEN NULL ELSE regexp_replace(vat_number, '^TAX;', '') END AS vat_number,
          CASE WHEN kvk_number IN ('-1', '') THEN NULL ELSE regexp_replace(kvk_number, '^TAX;', '') END AS kvk_number
        FROM pos_contracts""", "pos_contracts")),
    "entity_key": Query(
        _on("entities", "entity_key",
            lambda: keys.entity_key(F.col("source"), F.col("id")).alias("built_key")),
        with_tables("SELECT entity_key, source || ':' || id AS built_key FROM entities", "entities")),
    "blank_to_null": Query(
        _on("registry_rows", "key",
            lambda: parse.blank_to_null(F.col("kvk")).alias("kvk"),
            lambda: parse.blank_to_null(F.col("duns_id")).alias("duns_id"),
            lambda: F.trim("name").alias("name")),
        with_tables("""SELECT key, NULLIF(TRIM(kvk), '') AS kvk, NULLIF(TRIM(duns_id), '') AS duns_id,
          TRIM(name) AS name FROM registry_rows""", "registry_rows")),
    "zero_to_null": Query(
        _on("registry_risks", "event_id",
            lambda: parse.zero_text_to_null(F.col("watchlist_hit_pct")).alias("watchlist_hit_pct"),
            lambda: parse.zero_text_to_null(F.col("pep_hit_pct")).alias("pep_hit_pct")),
        with_tables("""SELECT event_id, NULLIF(watchlist_hit_pct, '0') AS watchlist_hit_pct,
          NULLIF(pep_hit_pct, '0') AS pep_hit_pct FROM registry_risks""", "registry_risks")),
    "legal_form_map": Query(
        _on("registry_rows", "key",
            lambda: text.canonical_by_fragment(F.col("legal_form")).alias("legal_form")),
        with_tables("""SELECT key, CASE
          WHEN UPPER(legal_form) LIKE '%BESLOTEN VENNOOTSCHAP%' THEN 'Besloten Vennootschap (BV)'
          WHEN UPPER(legal_form) LIKE '%EENMANSZAAK%' THEN 'Eenmanszaak'
          WHEN UPPER(legal_form) LIKE '%VENNOOTSCHAP ONDER FIRMA%' THEN 'Vennootschap onder firma (VOF)'
          WHEN UPPER(legal_form) LIKE '%COMMANDITAIRE%' THEN 'Commanditaire Vennootschap (CV)'
          WHEN UPPER(legal_form) LIKE '%STICHTING%' THEN 'Stichting'
          WHEN UPPER(legal_form) LIKE '%VERENIGING%' THEN 'Vereniging'
          WHEN UPPER(legal_form) LIKE '%PUBLIEKRECHTELIJK%' THEN 'Publiekrechtelijk'
          ELSE TRIM(legal_form) END AS legal_form FROM registry_rows""", "registry_rows")),
    "notes_missing": Query(
        _on("pos_contracts", "contract_id",
            lambda: text.notes({
                "missing_vat": keys.strip_prefix(F.col("vat_number"), "TAX;").isNull(),
                "missing_kvk": keys.strip_prefix(F.col("kvk_number"), "TAX;").isNull(),
                "open_end": F.col("ended_on").isNull(),
            }).alias("notes")),
        with_tables("""SELECT contract_id, concat_ws('; ',
          CASE WHEN vat_number IS NULL OR vat_number IN ('-1', '') THEN 'missing_vat' END,
          CASE WHEN kvk_number IS NULL OR kvk_number IN ('-1', '') THEN 'missing_kvk' END,
          CASE WHEN ended_on IS NULL THEN 'open_end' END) AS notes FROM pos_contracts""", "pos_contracts")),
    "status_text": Query(
        _on("registry_risks", "event_id", lambda: text.join_present(
            " — ", F.col("screening_pstatus"), F.col("screening_status")).alias("screening")),
        with_tables("""SELECT event_id, screening_pstatus || COALESCE(' — ' || screening_status, '') AS screening
        FROM registry_risks""", "registry_risks")),
    "default_missing": Query(
        _on("entities", "entity_key",
            lambda: F.coalesce(F.col("contract_status"), F.lit("Unknown")).alias("contract_status"),
            lambda: text.upper_or(F.col("id"), "unknown").alias("id")),
        with_tables("""SELECT entity_key, COALESCE(contract_status, 'Unknown') AS contract_status,
          UPPER(COALESCE(id, 'unknown')) AS id FROM entities""", "entities")),
    "contract_status": Query(
        _on("pos_contracts", "contract_id",
            lambda: classes.status_from_end(F.col("ended_on")).alias("status")),
        with_tables("""SELECT contract_id, CASE WHEN ended_on IS NULL THEN 'Active' ELSE 'Terminated' END AS status
        FROM pos_contracts""", "pos_contracts")),
    "date_from_key": Query(
        _on("pos_payments", "date_key",
            lambda: parse.date_from_key(F.col("date_key")).alias("day"),
            lambda: parse.date_from_key(F.col("date_key") + 10000 * (F.col("contract_key") % 2)
                                        + 1200 * (F.col("contract_key") % 3)).alias("shifted")),
        with_tables("""SELECT date_key, CAST(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') AS DATE) AS day,
          CAST(try_strptime(CAST(date_key + 10000 * (contract_key % 2) + 1200 * (contract_key % 3) AS VARCHAR),
            '%Y%m%d') AS DATE) AS shifted FROM pos_payments""", "pos_payments")),
    "date_from_text": Query(
        _on("registry_risks", "event_id",
            lambda: parse.date_from_text_key(F.col("next_review")).alias("next_review")),
        with_tables("""SELECT event_id, CAST(try_strptime(NULLIF(TRIM(next_review), ''), '%Y%m%d') AS DATE) AS next_review
        FROM registry_risks""", "registry_risks")),
    "month_cutoff": Query(
        lambda spark, sf: table(spark, sf, "pos_payments").filter(
            F.col("date_key") >= dates.cutoff_key(REPORTING_DATE)).select(
            "contract_key", "date_key",
            dates.months_before(REPORTING_DATE, 6).alias("half_year_before")),
        with_tables(f"""SELECT contract_key, date_key,
          CAST(DATE '{REPORTING_DATE}' - INTERVAL 6 MONTH AS DATE) AS half_year_before
        FROM pos_payments WHERE date_key >= {CUTOFF_KEY}""", "pos_payments")),
    "money_cast": Query(
        _on("lineitem", "l_orderkey", "l_linenumber", lambda: F.col("l_extendedprice").cast(
            "decimal(20,2)").alias("price")),
        "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(20,2)) AS price FROM lineitem"),
    "number_parse": Query(
        lambda spark, sf: (lambda df: df.select(
            "order_number", parse.to_number("amount", df.schema["amount"].dataType).alias("amount"),
            parse.is_positive("amount", df.schema["amount"].dataType).alias("is_positive"),
        ))(table(spark, sf, "dirty_orders")),
        with_tables("""SELECT order_number, amount,
          COALESCE(amount > 0, FALSE) AS is_positive FROM (SELECT order_number, CASE WHEN
          regexp_matches(amount, '^\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*$')
          THEN TRY_CAST(TRIM(amount) AS DOUBLE) END AS amount FROM dirty_orders)""", "dirty_orders")),
    "date_parse": Query(
        _on("dirty_orders", "order_number",
            lambda: parse.to_date("order_date").alias("order_date")),
        with_tables("""SELECT order_number, CASE WHEN regexp_matches(order_date, '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
          THEN CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) END AS order_date FROM dirty_orders""",
                    "dirty_orders")),
    "null_tokens": Query(
        _on("dirty_orders", "order_number",
            lambda: parse.null_tokens_to_null("amount").alias("amount"),
            lambda: parse.is_blank("amount").alias("is_blank")),
        with_tables("""SELECT order_number, CASE WHEN amount NOT IN ('', 'nan') THEN amount END AS amount,
          TRIM(COALESCE(amount, '')) = '' AS is_blank FROM dirty_orders""", "dirty_orders")),
    # Text damaged on the way in must come out as it was written.
    "double_encoding_repair": Query(_mojibake, "SELECT doc_id, text FROM documents"),
    "double_encoding_clean_text": Query(_mojibake_clean, "SELECT doc_id, text FROM documents"),
    "hash_bucket": Query(
        _on("documents", "doc_id", lambda: keys.hash_bucket(F.col("text")).alias("bucket"),
            lambda: keys.hash_bucket(F.col("doc_id"), 64).alias("doc_bucket")),
        """SELECT doc_id, CAST(('0x' || substr(sha1(text), 1, 16))::UBIGINT % 1000 AS INTEGER) AS bucket,
          CAST(('0x' || substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16))::UBIGINT % 64 AS INTEGER) AS doc_bucket
        FROM documents"""),
    "hash_sample": Query(_hash_sample, with_tables("""
        SELECT entity_key, join_key, ('0x' || substr(sha1(join_key), 1, 16))::UBIGINT % 1000 <
          CASE WHEN source = 'TERMINAL' THEN 714 ELSE 353 END AS in_sample
        FROM (SELECT entity_key, source, CASE WHEN regexp_matches(id, '[0-9]') THEN
          'P_M' || LPAD(regexp_replace(id, '[^0-9]', '', 'g'), 13, '0') END AS join_key FROM entities)""",
                                                  "entities")),
    "value_map": Query(
        _on("customer", "c_custkey", lambda: text.map_value(
            F.col("c_mktsegment"), {"BUILDING": 0, "MACHINERY": 1}, 9).alias("rank")),
        """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'MACHINERY' THEN 1 ELSE 9 END AS rank
        FROM customer"""),
    "round_half_even": Query(
        _on("lineitem", "l_orderkey", "l_linenumber",
            lambda: text.round_half_even(F.col("l_quantity") / 8.0, 2).alias("eighth")),
        "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8.0, 2) AS eighth FROM lineitem"),
    "labels_text": Query(
        _on("part", "p_partkey", lambda: text.join_present(" | ", F.col("p_brand"), F.col("p_type")).alias("label"),
            lambda: text.spaced(F.concat_ws("_", "p_brand", "p_type")).alias("spaced")),
        """SELECT p_partkey, p_brand || ' | ' || p_type AS label,
          REPLACE(p_brand || '_' || p_type, '_', ' ') AS spaced FROM part"""),
    "local_time": Query(
        _on("events", "event_id",
            lambda: dates.local_label(F.col("ts"), "Europe/Amsterdam").alias("local"),
            lambda: dates.local_label(F.when(F.col("event_id") % 9 != 0, F.col("ts")), "UTC").alias("utc")),
        # All events fall into January, when the zone is one hour ahead.
        """SELECT event_id, strftime(ts + INTERVAL 1 HOUR, '%d %b %Y %H:%M') AS local,
          COALESCE(strftime(CASE WHEN event_id % 9 <> 0 THEN ts END, '%d %b %Y %H:%M'), 'unknown time') AS utc
        FROM events"""),
}
