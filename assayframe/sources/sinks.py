"""Writers: tables that keep their schema, report files, and published runs.

Every publication of a run writes to a folder of its own, the attempt.  Its results go
first and its history row, which names the attempt, last, so a reader that starts from the
history only ever sees complete runs and no two publications write to the same place.
"""
from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.columns import named
from assayframe.operators.report import build_report


def stamp(df: DataFrame, run_ts: str | dt.datetime, column: str = "generated_at") -> DataFrame:
    """The same run time on every row."""
    return df.withColumn(column, F.lit(str(run_ts)).cast("timestamp_ntz"))


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace a managed table, schema included."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def create_tables(spark: SparkSession, schemas: dict[str, T.StructType]) -> None:
    for name, schema in schemas.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def drop_tables(spark: SparkSession, schemas: dict[str, T.StructType]) -> None:
    for name in schemas:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its types; those that the frame lacks are NULL."""
    have = set(df.columns)
    return df.select(*[
        (named(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def replace_rows(df: DataFrame, table: str, append: bool = False) -> int:
    """Fill an existing table, keeping its schema; loading twice does not duplicate.

    The row count comes from the write itself.
    """
    from pyspark.sql import Observation

    seen = Observation()
    shaped(df, df.sparkSession.table(table).schema).observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(
        table, overwrite=not append)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header, cells kept as they are.  ``single_file`` is for small reports."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(
        path, header=True, escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def publish_run(
    results: DataFrame, summary: DataFrame, root: str, run_id: str
) -> dict[str, str]:
    """Write report and summary of one run, then make it visible in the history.

    A run id that is published again gets another attempt; readers take the last one.
    """
    base = root.rstrip("/")
    now = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    attempt = f"{now}-{uuid.uuid4().hex[:8]}"
    paths = {
        "report": f"{base}/report/run_id={run_id}/attempt={attempt}",
        "summary": f"{base}/summary/run_id={run_id}/attempt={attempt}",
        "history": f"{base}/history",
    }
    write_csv(build_report(results), paths["report"], single_file=True)
    write_json(summary, paths["summary"], single_file=True)
    spark = results.sparkSession
    row = spark.read.schema(summary.schema).json(paths["summary"])
    row.withColumns({"run_id": F.lit(run_id), "attempt": F.lit(attempt)}).coalesce(1).write.parquet(
        f"{paths['history']}/publication={attempt}")
    return paths
