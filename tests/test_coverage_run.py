"""What a coverage run works out once: base, lookup, join."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from assayframe.catalog import coverage as catalog_coverage
from assayframe.functions.keys import registry_key
from assayframe.plans import coverage

BASE = [("a", "1", "One", "Active"), ("a", "S-2", "Two", None), ("b", None, "Three", "Active"),
        ("b", "none", "Four", "Active"), ("b", "12345678901234", "Five", "Active")]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def run(spark):
    base = spark.createDataFrame(BASE, "source string, id string, name string, merchant_activity_status string")
    lookup = spark.createDataFrame(
        [("P_M0000000000001", "x", "Low"), ("P_M0000000000001", "y", None), ("P_M12345678901234", "z", None)],
        f"{coverage.JOIN_KEY} string, registry_name string, registry_risk_score string")
    return coverage.run_coverage(base, lookup, "2001-06-30 12:00:00")


def test_rows_of_a_run(run):
    """Several lookup rows of a key multiply the enriched rows alone."""
    assert sorted((r["name"], r[coverage.FLAG]) for r in run.flag.collect()) == [
        ("Five", "Y"), ("Four", "N"), ("One", "Y"), ("Three", "N"), ("Two", "N")]
    assert sorted((r["name"], r["registry_name"] or "", r[coverage.FLAG]) for r in run.rich.collect()) == [
        ("Five", "z", "N"), ("Four", "", "N"), ("One", "x", "Y"), ("One", "y", "N"), ("Three", "", "N"), ("Two", "", "N")]
    assert [(r["source"], r[coverage.FLAG], r["merchants"], r["active_merchants"]) for r in run.summary.collect()] == [
        ("a", "N", 1, 0), ("a", "Y", 1, 1), ("b", "N", 1, 2), ("b", "Y", 1, 1)]


def test_outputs_of_a_run_share_one_stored_flag(run):
    assert "Join" not in plan(run.flag) and "Join" not in plan(run.summary)
    assert plan(run.rich).count("Join ") == 1


def test_sampled_run_reads_the_given_tables_once(spark, sf):
    found = catalog_coverage._sample_run(spark, sf)
    for part in found:
        assert not [f for f in part.inputFiles() if f.startswith(f"file://{sf}")]


def test_registry_key_names_the_id_in_few_places(spark):
    rows = [("7",), ("S-12",), ("",), (None,), ("none",), ("1234567890123",), ("00012345678901234",), ("0",)]
    df = spark.createDataFrame(rows, "id string").withColumn("key", registry_key(F.col("id")))
    assert {r["id"]: r["key"] for r in df.collect()} == {
        "7": "P_M0000000000007", "S-12": "P_M0000000000012", "": None, None: None, "none": None,
        "1234567890123": "P_M1234567890123", "00012345678901234": "P_M00012345678901234", "0": "P_M0000000000000"}
    assert plan(df).count("regexp_replace") <= 3
