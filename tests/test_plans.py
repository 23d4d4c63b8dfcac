"""The plans are the ones wanted: pruned, pushed down, no cross joins, no Python."""
from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from assayframe.catalog.base import table
from assayframe.functions import dates
from assayframe.operators import checks
from assayframe.operators.frequency import latest_per_key
from assayframe.rules import Rules


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "dq_report_lineitem", "entity_base_combined", "match_flag", "enriched_base", "match_summary",
    "unmatched_root_causes", "base_cuts", "scenario_matrix", "ladder_scores", "latest_per_key",
    "value_shares", "hot_key_join"])
def test_no_cross_join_and_no_python(spark, sf, name):
    text = plan(entry.queries()[name](spark, sf))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "Arrow"):
        assert unwanted not in text


def test_checks_read_the_table_twice_and_only_needed_columns(spark, sf):
    df = table(spark, sf, "lineitem")
    rules = Rules(non_null_columns=("l_tax",), unique_columns=("l_orderkey", "l_partkey"))
    text = plan(checks.run_checks(df, rules))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    names = sorted(re.sub(r"#\d+L?", "", s) for s in scans)
    assert names == ["l_orderkey,l_partkey", "l_tax"]


def test_counts_are_combined_before_they_are_shuffled(spark, sf):
    text = plan(checks.check_unique(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"]))
    assert "partial_count" in text
    text = plan(latest_per_key(table(spark, sf, "events"), ["user_id"], "ts"))
    assert "partial_max" in text and "Window" not in text


def test_cutoff_reaches_the_scan(spark, sf):
    import pyspark.sql.functions as F

    facts = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").cast("int").alias("k"), "o_custkey")
    text = plan(facts.filter(F.col("o_custkey") >= dates.cutoff_key("2001-06-30")))
    assert "GreaterThanOrEqual(o_custkey,20000630)" in text


def test_wide_facts_are_reduced_before_the_account_join(spark, sf):
    text = plan(entry.queries()["activity_through_accounts"](spark, sf))
    join = text.index("Join")
    assert "partial_" in text[join:]
