"""Entities against a reference registry: flags, enrichment, rates and causes.

Registry tables use neutral column names:
``registry(key, valid_to, system_flag, name, street, postal_code, city, mcc, country,
legal_form, kvk, duns_id, vat, registry_number, customer_type)``,
``risks(key, valid_from, valid_to, risk_score, risk_label, …)``,
``links(key, person_key, link_type, valid_to)``.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.columns import named, present
from assayframe.functions import dates, keys, text
from assayframe.functions.parse import blank_to_null, date_from_text_key, zero_text_to_null
from assayframe.operators.frequency import distributions, latest_per_key, share_of_group
from assayframe.operators.lookups import lookup_join, lookup_joins, with_flag, without_match
from assayframe.session import materialise
from assayframe.sources.sinks import replace_rows, stamp, write_csv

JOIN_KEY = "join_key"
FLAG = "in_registry_flag"

# The open end of validity, enrichment columns and risk classes.
OPEN_END = "%9999%"
IDENTITY_COLUMNS = (
    "registry_name", "registry_street", "registry_postal_code", "registry_city",
    "registry_mcc", "registry_country", "registry_legal_form", "registry_kvk",
    "registry_duns_id", "registry_vat",
)
RISK_COLUMNS = (
    "registry_risk_score", "registry_risk_label", "registry_risk_original",
    "registry_risk_manual", "registry_risk_inherited", "registry_screening_status",
    "registry_screening_pstatus", "registry_watchlist_hit_pct", "registry_watchlist_list",
    "registry_embargo_hit_pct", "registry_pep_hit_pct", "registry_next_review_date",
    "registry_risk_comment",
)
LINK_COLUMNS = ("registry_ubo_count", "registry_si_count")
OWNER_LINK = "BO"
SIGNATORY_LINK = "SI"
HIGH_RISK = ("High", "VeryHigh")
RISK_ORDER = {"Low": 0, "Medium": 1, "High": 2, "VeryHigh": 3}


def current_entities(registry: DataFrame, system: str | None = None,
                     key_prefix: str = keys.KEY_PREFIX) -> DataFrame:
    """Current registry rows of entities, optionally of one system.

    The key test is a prefix test so that it reaches the scan.
    """
    rows = registry.filter(F.col("valid_to").like(OPEN_END) & F.col("key").startswith(key_prefix))
    return rows.filter(F.col("system_flag").startswith(system)) if system else rows


def entity_lookup(registry: DataFrame, system: str | None = None) -> DataFrame:
    """Normalised identity of the registry's current entities."""
    return current_entities(registry, system).select(
        F.col("key").alias("registry_key"),
        F.trim("name").alias("registry_name"),
        F.trim("legal_form").alias("registry_legal_form"),
        text.canonical_by_fragment(F.col("legal_form")).alias("registry_legal_form_normalized"),
        F.trim("mcc").alias("registry_mcc"),
        F.trim("country").alias("registry_country"),
        blank_to_null(F.col("registry_number")).alias("registry_number"),
        F.trim("customer_type").alias("registry_customer_type"),
    )


def person_links(links: DataFrame, key_prefix: str = keys.KEY_PREFIX) -> DataFrame:
    """Distinct entity-person links."""
    return links.filter(F.col("key").startswith(key_prefix)).select(
        F.col("key").alias("entity_registry_key"),
        F.col("person_key"),
        F.col("link_type").alias("relationship_type"),
    ).distinct()


def latest_risks(risks: DataFrame, key_prefix: str = keys.KEY_PREFIX) -> DataFrame:
    """The most recent current risk row per key."""
    rows = risks.filter(F.col("valid_to").like(OPEN_END) & F.col("key").startswith(key_prefix))
    return latest_per_key(rows, ["key"], "valid_from")


def risk_lookup(risks: DataFrame) -> DataFrame:
    """Final, original, manual and inherited risk with one screening text."""
    return latest_risks(risks).select(
        F.col("key").alias("risk_key"),
        F.col("risk_score").alias("risk_final"),
        "risk_original",
        "risk_manual",
        "risk_inherited",
        text.join_present(" — ", F.col("screening_pstatus"), F.col("screening_status"))
        .alias("risk_screening_status"),
    )


def link_counts(links: DataFrame, key_prefix: str = keys.KEY_PREFIX) -> DataFrame:
    rows = links.filter(F.col("key").startswith(key_prefix) & F.col("valid_to").like(OPEN_END))
    kind = F.trim("link_type")
    return rows.groupBy(F.col("key").alias(JOIN_KEY)).agg(
        F.count_if(kind == OWNER_LINK).alias("registry_ubo_count"),
        F.count_if(kind == SIGNATORY_LINK).alias("registry_si_count"),
    )


def identity_columns(registry: DataFrame, system: str | None = None) -> DataFrame:
    """The ten identity columns of the enrichment, one row per registry row."""
    plain = ("name", "street", "postal_code", "city", "mcc", "country", "legal_form")
    blankable = ("kvk", "duns_id", "vat")
    return current_entities(registry, system).select(
        F.col("key").alias(JOIN_KEY),
        *[F.trim(c).alias(f"registry_{c}") for c in plain],
        *[blank_to_null(F.col(c)).alias(f"registry_{c}") for c in blankable],
    )


def risk_columns(risks: DataFrame) -> DataFrame:
    """The thirteen risk columns of the enrichment, one row per key."""
    plain = ("risk_score", "risk_label", "risk_original", "screening_status", "screening_pstatus")
    blankable = ("risk_manual", "risk_inherited", "watchlist_list", "risk_comment")
    zeroable = ("watchlist_hit_pct", "embargo_hit_pct", "pep_hit_pct")
    made = {
        **{f"registry_{c}": F.trim(c) for c in plain},
        **{f"registry_{c}": blank_to_null(F.col(c)) for c in blankable},
        **{f"registry_{c}": zero_text_to_null(F.col(c)) for c in zeroable},
        "registry_next_review_date": date_from_text_key(F.col("next_review")),
    }
    return latest_risks(risks).select(
        F.col("key").alias(JOIN_KEY), *[made[c].alias(c) for c in RISK_COLUMNS])


def registry_keys(registry: DataFrame, system: str | None = None) -> DataFrame:
    return current_entities(registry, system).select(F.col("key").alias(JOIN_KEY)).distinct()


def with_join_key(base: DataFrame, id_column: str = "id", **key_options) -> DataFrame:
    return base.withColumn(JOIN_KEY, keys.registry_key(named(id_column), **key_options))


def flagged(base: DataFrame, known: DataFrame, hot_keys: Sequence = (), **key_options) -> DataFrame:
    """The base with one more column: whether the registry holds the entity."""
    return with_flag(with_join_key(base, **key_options), known, JOIN_KEY, FLAG, hot_keys=hot_keys).drop(
        JOIN_KEY).select(*map(named, base.columns), FLAG)


def unmatched(base: DataFrame, known: DataFrame, hot_keys: Sequence = (), **key_options) -> DataFrame:
    return without_match(with_join_key(base, **key_options), known, JOIN_KEY, hot_keys).select(
        *map(named, base.columns))


def combined_registry(identity: DataFrame, risk: DataFrame, links: DataFrame,
                      dedupe: bool = False) -> DataFrame:
    """The three enrichment inputs in one table, to be stored and looked up later.

    ``dedupe`` keeps one identity row per key; otherwise several identity rows
    multiply the entity as they do in a direct join.
    """
    known = _known_identity(identity, dedupe)
    return known.join(risk, JOIN_KEY, "full").join(links, JOIN_KEY, "full")


def _known_identity(identity: DataFrame, dedupe: bool) -> DataFrame:
    if dedupe:
        rest = [c for c in identity.columns if c != JOIN_KEY]
        identity = identity.groupBy(JOIN_KEY).agg(
            F.min(F.struct(*map(named, rest))).alias("_row")).select(JOIN_KEY, "_row.*")
    return identity.withColumn("_known", F.lit(True))


def enriched(base: DataFrame, identity: DataFrame, risk: DataFrame, links: DataFrame,
             dedupe: bool = False, hot_keys: Sequence = (), **key_options) -> DataFrame:
    """The base with flag and 25 registry columns; unmatched entities have NULLs.

    ``in_registry_flag`` means the registry knows the key, ``has_risk_flag`` that a
    risk score was found; the two can differ.  ``dedupe`` is that of ``combined_registry``.
    The base is joined to each input on one key and one shuffle of its own, without a full join.
    """
    sides = [_known_identity(identity, dedupe), risk, links]
    joined = lookup_joins(with_join_key(base, **key_options), sides, JOIN_KEY, "left", hot_keys)
    return joined.select(
        *base.columns,
        F.when(F.col("_known"), "Y").otherwise("N").alias(FLAG),
        F.when(F.col("registry_risk_score").isNotNull(), "Y").otherwise("N").alias("has_risk_flag"),
        *present(joined, (*IDENTITY_COLUMNS, *RISK_COLUMNS, *LINK_COLUMNS)),
    )


def enrich_from_lookup(base: DataFrame, lookup: DataFrame, hot_keys: Sequence = (),
                       **key_options) -> DataFrame:
    """The base joined to an already combined lookup; the flag follows the risk score."""
    columns = [c for c in lookup.columns if c != JOIN_KEY]
    joined = lookup_join(with_join_key(base, **key_options), lookup, JOIN_KEY, "left", hot_keys)
    return joined.select(
        *base.columns, *map(named, columns),
        F.when(F.col("registry_risk_score").isNotNull(), "Y").otherwise("N").alias(FLAG),
    )


def match_summary(flagged_base: DataFrame) -> DataFrame:
    """Entities, active entities and percentage per source and flag.

    Only the few grouped rows pass through the window that adds source totals.
    """
    counts = flagged_base.groupBy("source", FLAG).agg(
        F.count("id").alias("merchants"),
        F.count_if(F.col("merchant_activity_status") == "Active").alias("active_merchants"),
    )
    return share_of_group(counts, "source", "merchants", "pct_of_source").orderBy("source", FLAG)


def match_volume(flagged_base: DataFrame, volume: str = "total_msv_12m_eur") -> DataFrame:
    """Entities, volume and active entities per source and flag."""
    return flagged_base.groupBy("source", FLAG).agg(
        F.count(F.lit(1)).alias("merchants"),
        F.sum(named(volume)).alias(volume),
        F.count_if(F.col("merchant_activity_status") == "Active").alias("active_merchants"),
    ).orderBy("source", FLAG)


def match_rates(base: DataFrame, known: DataFrame, **key_options) -> DataFrame:
    """Matched and total entities per source, straight from base and registry keys.

    The base is counted per (source, key) before it meets the registry, so a key with
    a third of all entities is one row in the join.
    """
    counted = with_join_key(base, **key_options).groupBy("source", JOIN_KEY).agg(F.count(F.lit(1)).alias("_n"))
    matched = with_flag(counted, known, JOIN_KEY, FLAG)
    out = matched.groupBy("source").agg(
        F.coalesce(F.sum(F.when(F.col(FLAG) == "Y", F.col("_n"))), F.lit(0)).alias("matched"),
        F.sum("_n").alias("total"),
    )
    return out.withColumn("pct", text.percent(F.col("matched"), F.col("total"))).orderBy("source")


def coverage_by(flagged_base: DataFrame, cuts: Sequence[Sequence[str]],
                volume: str = "total_msv_12m_eur") -> DataFrame:
    """Entities and volume for several cuts from one scan."""
    return distributions(flagged_base, cuts, {
        "merchants": F.count(F.lit(1)),
        "msv_12m_eur": F.sum(named(volume)),
    })


def root_causes(unmatched_base: DataFrame, load_date: str, cuts: Sequence[Sequence[str]],
                volume: str = "total_msv_12m_eur") -> DataFrame:
    """Why entities are missing: several cuts of the unmatched from one scan.

    ``onboarded_after_load`` tells entities that came after the registry's first load
    from those that were there before.
    """
    after = F.when(F.col("vintage_date") > dates.as_date(load_date), "Yes").otherwise("No / Unknown")
    return distributions(unmatched_base.withColumn("onboarded_after_load", after), cuts, {
        "merchants": F.count(F.lit(1)),
        "active_merchants": F.count_if(F.col("merchant_activity_status") == "Active"),
        "total_msv_12m_eur": F.sum(named(volume)),
    })


def coverage_scalars(rich: DataFrame, reporting_date: str) -> DataFrame:
    """All headline numbers from one aggregate."""
    matched = F.col(FLAG) == "Y"
    out = rich.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(matched).alias("matched"),
        F.count_if(F.col("registry_risk_score").isNotNull()).alias("enriched"),
        F.count_if(matched & F.col("registry_risk_score").isin(*HIGH_RISK)).alias("high_risk"),
        F.count_if(matched & F.col("registry_watchlist_hit_pct").isNotNull()).alias("watchlist_hits"),
        F.count_if(dates.is_overdue(F.col("registry_next_review_date"), reporting_date))
        .alias("reviews_overdue"),
    )
    return out.select(
        "total", "matched", (F.col("total") - F.col("matched")).alias("unmatched"),
        text.percent(F.col("matched"), F.col("total"), 1).alias("pct_matched"),
        "enriched", "high_risk", "watchlist_hits", "reviews_overdue",
    )


def risk_distribution(rich: DataFrame) -> DataFrame:
    """Matched entities per risk class in order of severity."""
    counts = (
        rich.filter((F.col(FLAG) == "Y") & F.col("registry_risk_score").isNotNull())
        .groupBy(F.col("registry_risk_score").alias("risk"))
        .agg(F.count(F.lit(1)).alias("merchants"))
    )
    return counts.orderBy(text.map_value(F.col("risk"), RISK_ORDER, len(RISK_ORDER)), "risk")


def top_watchlist(rich: DataFrame, rows: int = 10) -> DataFrame:
    """The strongest watchlist hits among matched entities."""
    hit = F.col("registry_watchlist_hit_pct").cast("double")
    return (
        rich.filter((F.col(FLAG) == "Y") & F.col("registry_watchlist_hit_pct").isNotNull())
        .select("id", "name", "country", "registry_risk_score", "registry_watchlist_list",
                hit.alias("registry_watchlist_hit_pct"))
        .orderBy(F.desc("registry_watchlist_hit_pct"), F.asc("id"))
        .limit(rows)
    )


def matched_sample(flagged_base: DataFrame, rows: int = 5) -> DataFrame:
    return flagged_base.filter(F.col(FLAG) == "Y").orderBy("source", "id").limit(rows)


class Coverage(NamedTuple):
    flag: DataFrame
    rich: DataFrame
    summary: DataFrame


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty; load it before the coverage run")


def run_coverage(base: DataFrame, lookup: DataFrame, run_ts: str) -> Coverage:
    """Flag, enrichment and summary of a base against a combined lookup.

    Empty inputs are an error.  Every output row carries the same run time.  The flagged
    base is stored once, and all outputs start from it however often they are written;
    ``lookup`` is read for the check, the flag and each use of the enriched table, so a
    derived one should be stored before.
    """
    require_rows(base, "the entity base")
    require_rows(lookup, "the registry lookup")
    flag = materialise(flagged(base, lookup), "flagged")
    return Coverage(
        stamp(flag, run_ts),
        stamp(enrich_from_lookup(flag.select(*map(named, base.columns)), lookup), run_ts),
        stamp(match_summary(flag), run_ts),
    )


def write_coverage(run: Coverage, lookup: DataFrame, root: str) -> dict[str, str]:
    """Lookup, flag and enriched tables as parquet, the summary as one ordered CSV."""
    base = root.rstrip("/")
    paths = {part: f"{base}/{part}" for part in ("lookup", *run._fields)}
    lookup.write.mode("overwrite").parquet(paths["lookup"])
    run.flag.write.mode("overwrite").parquet(paths["flag"])
    run.rich.write.mode("overwrite").parquet(paths["rich"])
    write_csv(run.summary, paths["summary"], single_file=True)
    return paths


def store_coverage(run: Coverage, tables: Mapping[str, str]) -> dict[str, int]:
    """Replace the rows of the three output tables; returns the rows written."""
    return {part: replace_rows(getattr(run, part), table) for part, table in tables.items()}
