"""Verdict table, score, and the questions asked of a finished run."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.columns import named
from assayframe.functions.text import map_value
from assayframe.operators.checks import (
    ALLOWED, NON_NULL, NULL_RATIO, POSITIVE, REQUIRED, RESULT_COLUMNS, UNIQUE, VALID_DATE,
)

# Priorities and recommended actions of the remediation plan.
PRIORITY = {"critical": 0, "warning": 1}
OTHER_PRIORITY = 2
ACTIONS = {
    REQUIRED: "Add the missing source column before the file reaches the quality gate.",
    NON_NULL: "Fix missing values upstream or reject rows where this business-critical field is empty.",
    UNIQUE: "Deduplicate the business key and investigate whether the source system produced repeated records.",
    POSITIVE: "Correct non-numeric, zero, or negative values before financial totals are trusted.",
    VALID_DATE: "Normalize the date format and quarantine rows with invalid calendar values.",
    ALLOWED: "Map unsupported values to the allowed domain or update the rule if the business list changed.",
    NULL_RATIO: "Reduce missing values or agree a new tolerance with the data owner.",
}
OTHER_ACTION = "Review the failed rule, fix the source data, and rerun the Jenkins pipeline."

REPORT_SCHEMA = T.StructType([
    T.StructField("check_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("metric_value", T.DoubleType()),
    T.StructField("threshold", T.StringType()),
    T.StructField("failed_rows", T.LongType()),
    T.StructField("message", T.StringType()),
])


def build_report(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The eight report columns, failures first."""
    groups = [named(g) for g in by]
    return results.select(*groups, *RESULT_COLUMNS).orderBy(
        *groups, "status", "severity", "column_name", "check_name"
    )


def score(passed: Column, total: Column) -> Column:
    """Passed checks as a percentage; 100 when there were no checks."""
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.bround(passed.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 100.0, 2)
    )


def build_summary(
    results: DataFrame,
    source: str | None = None,
    run_ts: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """One row per run or group: counts, score and the failed checks in execution order.

    Only counts and rule metadata enter the summary, never values of the table.
    The list of failed checks is bounded by the number of rules.
    """
    groups = [named(g) for g in by]
    failed = F.struct("seq", *RESULT_COLUMNS)
    counted = results.groupBy(*groups).agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("checks_total"),
        F.count_if(F.col("status") == "PASS").alias("checks_passed"),
        F.count_if(F.col("status") != "PASS").alias("checks_failed"),
        F.array_sort(F.collect_list(F.when(F.col("status") != "PASS", failed))).alias("_failed"),
    )
    stamp = F.lit(run_ts).cast("timestamp_ntz")
    return counted.select(
        *groups,
        stamp.alias("generated_at_utc"),
        F.lit(source).cast("string").alias("input_file"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        "checks_total",
        "checks_passed",
        "checks_failed",
        score(F.col("checks_passed"), F.col("checks_total")).alias("quality_score"),
        F.transform(
            "_failed", lambda item: F.struct(*[item[c].alias(c) for c in RESULT_COLUMNS])
        ).alias("failed_checks"),
    )


def scores(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The summary without its nested list."""
    return build_summary(results, by=by).drop("generated_at_utc", "input_file", "failed_checks")


def severity_summary(report: DataFrame) -> DataFrame:
    return (
        report.groupBy("status", "severity")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("status", "severity")
    )


def pass_fail_split(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("count")).orderBy("status")


def _tolerant(report: DataFrame) -> DataFrame:
    """Failed checks, with unreadable numbers as 0 (a report may come from CSV)."""
    return report.filter(F.col("status") == "FAIL").withColumns({
        "failed_rows": F.coalesce(
            F.col("failed_rows").cast("string").try_cast("double"), F.lit(0.0)
        ).cast("bigint"),
        "metric_value": F.coalesce(
            F.col("metric_value").cast("string").try_cast("double"), F.lit(0.0)
        ),
    })


def remediation_plan(report: DataFrame) -> DataFrame:
    """What to fix first: failed checks with priority and recommended action."""
    return (
        _tolerant(report)
        .withColumn("priority", map_value(F.col("severity"), PRIORITY, OTHER_PRIORITY))
        .withColumn("recommended_action", map_value(F.col("check_name"), ACTIONS, OTHER_ACTION))
        .orderBy(F.asc("priority"), F.desc("failed_rows"), F.asc("check_name"), F.asc("column_name"))
    )


def failed_rows_by_control(report: DataFrame) -> DataFrame:
    """Failed checks ranked by the rows behind them."""
    return (
        _tolerant(report)
        .select(
            F.concat_ws(" | ", "check_name", "column_name").alias("label"),
            "severity",
            "failed_rows",
            "message",
        )
        .orderBy(F.desc("failed_rows"), F.asc("label"))
    )
