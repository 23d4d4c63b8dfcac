"""Run history: finding, labelling and comparing finished runs."""
from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayframe.functions.dates import local_label
from assayframe.operators.frequency import latest_per_key, step_change
from assayframe.operators.report import REPORT_SCHEMA
from assayframe.sources.files import FILE_PATH

SUMMARY_SCHEMA = T.StructType([
    T.StructField("generated_at_utc", T.StringType()),
    T.StructField("input_file", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("checks_total", T.LongType()),
    T.StructField("checks_passed", T.LongType()),
    T.StructField("checks_failed", T.LongType()),
    T.StructField("quality_score", T.DoubleType()),
    T.StructField("failed_checks", T.ArrayType(REPORT_SCHEMA)),
    T.StructField("_broken", T.StringType()),
])
# A summary without these is not a finished run.
NEEDED = ("quality_score", "checks_failed", "checks_passed", "row_count")


_SCHEME = r"[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?(?=/)"
# Summaries of one file per run, and those that ``publish_run`` writes.
SUMMARY_FILES = "{summary.json,part-*.json}"
# What ``publish_run`` puts around a run id.
_PUBLISHED = r"^(?:summary/)?run_id=(.*)/attempt=[^/]*$"


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def find_runs(spark: SparkSession, root: str, pattern: str = SUMMARY_FILES) -> DataFrame:
    """All runs below ``root``, newest first, runs without a readable time last.

    Corrupt files and summaries without the needed fields are left out, and a missing
    root has no runs.  The run id is the folder of the file relative to ``root``, or the
    id that a run was published under; of several publications the last counts.
    """
    reader = (
        spark.read.schema(SUMMARY_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
    )
    try:
        raw = reader.json(root).withColumn("_path", F.expr(FILE_PATH))
    except AnalysisException as error:
        if not _missing(error):
            raise
        raw = spark.createDataFrame([], SUMMARY_SCHEMA).withColumn("_path", F.lit(""))
    folder = F.regexp_replace(F.col("_path"), r"/[^/]*$", "")
    # Readers may spell the scheme in another way than the caller did.
    inside = F.regexp_replace(folder, f"^{_SCHEME}", "")
    own = re.sub(f"^{_SCHEME}", "", root.rstrip("/"))
    below = F.substring(inside, F.instr(inside, own) + len(own) + 1, F.length(inside))
    runs = raw.filter(F.col("_broken").isNull()).dropna(subset=list(NEEDED)).withColumns({
        "run_id": F.regexp_replace(below, _PUBLISHED, "$1"),
        "_attempt": F.regexp_extract(below, r"attempt=([^/]*)$", 1),
    })
    return latest_per_key(runs, ["run_id"], "_attempt").select(
        "run_id",
        F.try_to_timestamp("generated_at_utc").cast("timestamp_ntz").alias("generated_at"),
        "input_file",
        "row_count",
        F.coalesce("checks_total", F.lit(0)).alias("checks_total"),
        "checks_passed",
        "checks_failed",
        "quality_score",
    ).orderBy(F.desc_nulls_last("generated_at"), F.asc("run_id"))


def _history(spark: SparkSession, root: str) -> DataFrame:
    """The last publication of each run, with its attempt."""
    return latest_per_key(
        spark.read.parquet(root.rstrip("/") + "/history").drop("publication"), ["run_id"], "attempt")


def published_runs(spark: SparkSession, root: str) -> DataFrame:
    """Runs published with ``publish_run``, newest first; of repeated ids the last publication."""
    return _history(spark, root).drop("attempt").orderBy(
        F.desc_nulls_last("generated_at_utc"), F.asc("run_id"))


def run_report(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """The report of one published run, as its history row names it; no rows when there is none."""
    try:
        found = _history(spark, root).filter(F.col("run_id") == run_id).select("attempt").first()
    except AnalysisException as error:
        if not _missing(error):
            raise
        found = None
    if found is None:
        return spark.createDataFrame([], REPORT_SCHEMA)
    path = root.rstrip("/") + f"/report/run_id={run_id}/attempt={found['attempt']}"
    return spark.read.schema(REPORT_SCHEMA).option("escape", '"').csv(path, header=True)


def inventory(runs: DataFrame, zone: str, time: str = "generated_at") -> DataFrame:
    """Run id, score, failed checks and local time, with a label for pickers."""
    shown = local_label(F.col(time), zone)
    return runs.select(
        "run_id",
        F.concat_ws(" | ", F.col("run_id"), shown).alias("label"),
        "quality_score",
        "checks_failed",
        shown.alias("generated_local"),
    )


def trend(runs: DataFrame, time: str = "generated_at") -> DataFrame:
    """Scores in time order with the change since the run before."""
    return step_change(
        runs.select("run_id", time, "quality_score", "checks_failed", "checks_passed"),
        time,
        {"quality_score": "score_delta", "checks_failed": "failed_delta"},
    ).orderBy(time)


def last_run(runs: DataFrame, time: str = "generated_at") -> DataFrame:
    return runs.agg(F.max(time).alias("last_run"))


def ladder_scores(ladder: DataFrame) -> DataFrame:
    """A stored ladder summary with unreadable numbers as 0."""
    numbers = ("quality_score", "checks_failed", "checks_passed", "score_delta", "failed_delta")
    return ladder.withColumns({
        c: F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0))
        for c in numbers if c in ladder.columns
    })
