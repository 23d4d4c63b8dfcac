"""Canonical entity tables from fact and dimension tables.

Inputs use the neutral column names in each docstring; ``sources.files.rename`` maps
physical tables to them.  Facts are read once and aggregated before any join, so
only one row per account or contract is joined however many facts it has.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.columns import named
from assayframe.functions import classes, dates, keys, text
from assayframe.functions.parse import blank_to_null, date_from_key
from assayframe.operators.lookups import lookup_join, lookup_joins

MONEY = "decimal(20,2)"

# The columns of an entity table, in order.
ENTITY_COLUMNS = (
    "source", "entity_key", "id", "source_code_ref", "name", "vat_number", "kvk_number",
    "country", "last_trx_date", "first_trx_date_12m", "recent_trx_date_12m",
    "trx_count_12m", "total_msv_12m_eur", "max_trx_amount_12m_eur",
    "activity_detail_status", "merchant_activity_status", "type_of_activity",
    "contracting_method", "legal_form", "mcc", "vintage_date", "contract_status",
    "active_contracts", "contract_category_descriptions", "data_quality_notes",
)
# The 18 of them kept in files and stored tables.
STORED_COLUMNS = (
    "entity_key", "source", "id", "name", "vat_number", "kvk_number", "country",
    "last_trx_date", "activity_detail_status", "merchant_activity_status",
    "type_of_activity", "contracting_method", "legal_form", "mcc", "vintage_date",
    "contract_status", "active_contracts", "contract_category_descriptions",
)


def current(df: DataFrame, end: str = "valid_until") -> DataFrame:
    """Current rows of a dimension that keeps its history."""
    return df.filter(named(end).isNull())


def _activity_measures(cutoff: Column, amount: Column, day: Column) -> dict[str, Column]:
    recent = day >= cutoff
    money = amount.cast(MONEY)
    return {
        "trx_count_12m": F.count_if(recent),
        "total_msv_12m_eur": F.sum(F.when(recent, money)),
        "max_trx_amount_12m_eur": F.max(F.when(recent, money)),
        "first_trx_key_12m": F.min(F.when(recent, day)),
        "recent_trx_key_12m": F.max(F.when(recent, day)),
        "last_trx_key": F.max(day),
    }


def activity(
    facts: DataFrame,
    key: str,
    reporting_date: str,
    months: int = 12,
    amount: str = "amount",
    day: str = "date_key",
    service: str | None = None,
) -> DataFrame:
    """Recent and all-time activity per key from a single scan of the facts.

    Amounts become decimals before they are added, so totals do not depend on the
    order of the rows.  ``service`` adds the set of recent service types.
    """
    cutoff = dates.cutoff_key(reporting_date, months)
    measures = _activity_measures(cutoff, named(amount), named(day))
    if service:
        measures["service_types"] = F.array_sort(
            F.collect_set(F.when(named(day) >= cutoff, named(service))))
    out = facts.groupBy(named(key)).agg(*[m.alias(n) for n, m in measures.items()])
    return out.withColumn("total_msv_12m_eur", F.col("total_msv_12m_eur").cast(MONEY))


def activity_through(
    facts: DataFrame,
    accounts: DataFrame,
    account: str,
    owner: str,
    reporting_date: str,
    months: int = 12,
) -> DataFrame:
    """Activity per owner when facts only name an account.

    Facts are reduced to one row per account first; only those rows meet the account
    table and are reduced again per owner.  An account listed for two owners counts
    for both.
    """
    per_account = activity(facts, account, reporting_date, months)
    linked = per_account.join(accounts.select(named(account), named(owner)), account, "inner")
    return linked.groupBy(named(owner)).agg(
        F.sum("trx_count_12m").alias("trx_count_12m"),
        F.sum("total_msv_12m_eur").cast(MONEY).alias("total_msv_12m_eur"),
        F.max("max_trx_amount_12m_eur").alias("max_trx_amount_12m_eur"),
        F.min("first_trx_key_12m").alias("first_trx_key_12m"),
        F.max("recent_trx_key_12m").alias("recent_trx_key_12m"),
        F.max("last_trx_key").alias("last_trx_key"),
    )


def active_contracts(
    contracts: DataFrame, codes: DataFrame, code_type: str = "ContStatus", active: str = "1"
) -> DataFrame:
    """Contracts per partner whose status code is active at their institution.

    ``contracts(partner_id, status, institution)``, ``codes(code_type, code, institution)``
    """
    wanted = codes.filter((F.col("code_type") == code_type) & (F.col("code") == active)).select(
        F.col("code").alias("_code"), F.col("institution").alias("_institution"))
    counted = contracts.groupBy("partner_id", "status", "institution").agg(
        F.count(F.lit(1)).alias("_n"))
    on = (F.col("status").cast("string") == F.col("_code")) & (
        F.col("institution") == F.col("_institution"))
    return counted.join(wanted, on, "inner").groupBy("partner_id").agg(
        F.sum("_n").alias("active_contracts"))


def contract_categories(categories: DataFrame, active: int = 1, separator: str = ", ") -> DataFrame:
    """Categories of active contracts per owner, as a set and as sorted text.

    ``categories(company_key, category, category_description, contract_status)``.
    Repeated contracts of a category are dropped before they are collected, so the
    collected lists are bounded by the code list.
    """
    return (
        categories.filter(F.col("contract_status") == active)
        .select("company_key", "category", "category_description").distinct()
        .groupBy("company_key")
        .agg(
            F.array_sort(F.collect_set("category")).alias("contract_categories"),
            F.array_join(F.array_sort(F.collect_set("category_description")), separator)
            .alias("contract_category_descriptions"),
        )
    )


def representative(df: DataFrame, key: str, column: str) -> DataFrame:
    """The smallest non-null value per key."""
    return df.filter(named(column).isNotNull()).groupBy(named(key)).agg(
        F.min(named(column)).alias(column))


def _activity_columns() -> list[Column]:
    n = F.col("trx_count_12m")
    return [
        date_from_key(F.col("last_trx_key")).alias("last_trx_date"),
        date_from_key(F.col("first_trx_key_12m")).alias("first_trx_date_12m"),
        date_from_key(F.col("recent_trx_key_12m")).alias("recent_trx_date_12m"),
        F.coalesce(n, F.lit(0)).cast("bigint").alias("trx_count_12m"),
        F.coalesce(F.col("total_msv_12m_eur"), F.lit(0).cast(MONEY)).cast(MONEY).alias("total_msv_12m_eur"),
        F.col("max_trx_amount_12m_eur"),
        classes.activity_detail(n).alias("activity_detail_status"),
        classes.activity_status(n).alias("merchant_activity_status"),
    ]


def contract_base(
    contracts: DataFrame,
    companies: DataFrame,
    terms: DataFrame,
    payments: DataFrame,
    reporting_date: str,
    source: str,
    id_prefix: str = "",
    no_currency: str = "-1",
) -> DataFrame:
    """One row per contract.

    ``contracts(contract_id, company_key, contract_key, vat_number, kvk_number, ended_on)``,
    ``companies(company_key, name, country, vintage_date)``, ``terms(contract_key, mcc)``,
    ``payments(contract_key, amount, date_key, currency)``
    """
    active = activity(
        payments.filter(F.col("currency") != no_currency), "contract_key", reporting_date)
    vat = keys.strip_prefix(F.col("vat_number"), id_prefix)
    kvk = keys.strip_prefix(F.col("kvk_number"), id_prefix)
    # Left joins, not a full join of terms and activity: only these can be split under skew.
    joined = lookup_joins(
        lookup_join(contracts, companies, "company_key", "left"), [terms, active], "contract_key", "left")
    return joined.select(
        F.lit(source).alias("source"),
        keys.entity_key(F.lit(source), F.col("contract_id")).alias("entity_key"),
        F.col("contract_id").alias("id"),
        F.lit(None).cast("string").alias("source_code_ref"),
        "name",
        vat.alias("vat_number"),
        kvk.alias("kvk_number"),
        "country",
        *_activity_columns(),
        F.lit("CP").alias("type_of_activity"),
        F.lit("F2F").alias("contracting_method"),
        F.lit(None).cast("string").alias("legal_form"),
        F.col("mcc").cast("string").alias("mcc"),
        "vintage_date",
        classes.status_from_end(F.col("ended_on")).alias("contract_status"),
        F.lit(None).cast("bigint").alias("active_contracts"),
        F.lit(None).cast("string").alias("contract_category_descriptions"),
        text.notes({
            "missing_vat": vat.isNull(),
            "missing_kvk": kvk.isNull(),
            "missing_mcc": F.col("mcc").isNull(),
            "missing_vintage": F.col("vintage_date").isNull(),
        }).alias("data_quality_notes"),
    ).select(*ENTITY_COLUMNS)


def company_base(
    companies: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    contracts: DataFrame,
    codes: DataFrame,
    categories: DataFrame,
    partners: DataFrame,
    reporting_date: str,
    source: str,
    settled: int = 41,
    sentinels: Sequence[str] = classes.SENTINEL_CODES,
) -> DataFrame:
    """One row per company.

    ``companies(company_key, company_code, name, vat_number, country, status_text, valid_until)``,
    ``accounts(account_key, company_key, mcc, valid_until)``,
    ``transactions(account_key, amount, date_key, clearing_state)``,
    ``contracts`` and ``codes`` as in ``active_contracts``, ``categories`` as in
    ``contract_categories``,
    ``partners(partner_id, legal_form, kvk_number, created_on, source_code_ref, valid_until)``
    """
    open_accounts = current(accounts)
    active = activity_through(
        transactions.filter(F.col("clearing_state") == settled),
        open_accounts, "account_key", "company_key", reporting_date,
    )
    details = current(partners).select(
        F.col("partner_id").cast("string").alias("company_code"),
        blank_to_null(F.col("legal_form")).alias("legal_form"),
        blank_to_null(F.col("kvk_number")).alias("kvk_number"),
        F.col("created_on").alias("vintage_date"),
        F.col("source_code_ref"),
    )
    counts = active_contracts(contracts, codes).withColumnRenamed("partner_id", "company_code")
    counts = counts.withColumn("company_code", F.col("company_code").cast("string"))
    joined = (
        current(companies).filter(~F.col("company_code").isin(*sentinels))
        .join(active, "company_key", "left")
        .join(contract_categories(categories), "company_key", "left")
        .join(representative(open_accounts, "company_key", "mcc"), "company_key", "left")
        .join(counts, "company_code", "left")
        .join(details, "company_code", "left")
    )
    found = F.col("contract_categories")
    return joined.select(
        F.lit(source).alias("source"),
        keys.entity_key(F.lit(source), F.col("company_code")).alias("entity_key"),
        F.col("company_code").alias("id"),
        "source_code_ref",
        "name",
        "vat_number",
        "kvk_number",
        "country",
        *_activity_columns(),
        classes.activity_channel(found).alias("type_of_activity"),
        classes.contracting_channel(found).alias("contracting_method"),
        "legal_form",
        F.col("mcc").cast("string").alias("mcc"),
        "vintage_date",
        F.coalesce(F.col("status_text"), F.lit("Unknown")).alias("contract_status"),
        F.coalesce(F.col("active_contracts"), F.lit(0)).cast("bigint").alias("active_contracts"),
        "contract_category_descriptions",
        text.notes({
            "missing_vat": F.col("vat_number").isNull(),
            "missing_kvk": F.col("kvk_number").isNull(),
            "missing_legal_form": F.col("legal_form").isNull(),
            "missing_mcc": F.col("mcc").isNull(),
        }).alias("data_quality_notes"),
    ).select(*ENTITY_COLUMNS)


def combined_base(*bases: DataFrame) -> DataFrame:
    """All sources in one table."""
    out = bases[0].select(*ENTITY_COLUMNS)
    for base in bases[1:]:
        out = out.unionByName(base.select(*ENTITY_COLUMNS))
    return out


def code_list(codes: DataFrame, code_type: str) -> DataFrame:
    """The codes of one type in order."""
    return codes.filter(F.col("code_type") == code_type).drop("code_type").orderBy("code")
