"""A validation run: source, checks, report, score, publication."""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from assayframe.operators.checks import check_while_writing, run_checks
from assayframe.operators.report import build_report, build_summary
from assayframe.rules import Config, Rules, load_config
from assayframe.session import materialise
from assayframe.sources.files import load_dataset, load_table
from assayframe.sources.sinks import publish_run, shaped


class Validation(NamedTuple):
    data: DataFrame
    results: DataFrame
    report: DataFrame
    summary: DataFrame
    paths: dict[str, str]


def validate_frame(
    df: DataFrame, rules: Rules, source: str = "dataframe", run_ts: str | None = None
) -> Validation:
    """Everything lazy; nothing runs until report or summary is read."""
    results = run_checks(df, rules)
    return Validation(
        df, results, build_report(results), build_summary(results, source, run_ts), {}
    )


def validate_source(
    spark: SparkSession,
    config: Config | str,
    path: str | None = None,
    table: str | None = None,
    output: str | None = None,
    run_id: str | None = None,
    run_ts: str | None = None,
) -> Validation:
    """Validate a CSV file or a catalog table, and publish the run if asked to.

    The checks run once: their few result rows are written to the scratch folder and
    both report and summary are read from there.
    """
    config = load_config(config) if isinstance(config, str) else config
    if table:
        data, source = load_table(spark, table, config.dataset.dtypes), f"sql://{table}"
    else:
        source = path or config.dataset.input_path
        if source is None:
            raise ValueError("no input given and the rules name none")
        data = load_dataset(spark, source, config.dataset.dtypes)
    results = materialise(run_checks(data, config.checks).coalesce(1), "results")
    summary = build_summary(results, source, run_ts)
    paths = publish_run(results, summary, output, run_id) if output and run_id else {}
    return Validation(data, results, build_report(results), summary, paths)


def store_and_validate(
    df: DataFrame, table: str, rules: Rules, run_ts: str | None = None
) -> Validation:
    """Replace the rows of an existing table and validate them as they are written.

    Rows take the table's schema first, so what is checked is what is stored.  The row-level
    checks cost no scan; unique columns are read back, and nothing else is.
    """
    spark = df.sparkSession
    rows = shaped(df, spark.table(table).schema)
    results = materialise(check_while_writing(
        rows, rules, lambda out: out.write.insertInto(table, overwrite=True), lambda: spark.table(table),
    ).coalesce(1), "results")
    return Validation(
        spark.table(table), results, build_report(results),
        build_summary(results, f"sql://{table}", run_ts), {})
