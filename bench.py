"""Time the headline queries and print one JSON line.

Each query runs once to warm up and then ``ROUNDS`` times; the median counts, which
is how the published figures were taken.  A query is timed from building its
DataFrame to the last row of its result.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assayframe.catalog import catalog  # noqa: E402
from assayframe.catalog.base import table  # noqa: E402

ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))
HEADLINE = [
    "dq_report_lineitem",
    "dq_report_orders",
    "dq_report_documents",
    "dq_scores_by_group",
    "check_unique_text",
    "double_encoding_repair",
    "hash_sample",
    "activity_metrics",
    "activity_through_accounts",
    "latest_per_key",
    "distinct_beside_count",
    "entity_base_combined",
    "base_cuts",
    "match_flag",
    "match_summary",
    "match_rates",
    "unmatched_root_causes",
    "enriched_base",
    "coverage_scalars",
    "dense_row_id",
    "occurrence_number",
    "repair_repeated_keys",
    "ladder_scores",
    "scenario_mixed_extreme",
    "scenario_matrix",
    "csv_validate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("assayframe-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_CHECKPOINT_DIR") or f"file://{tempfile.mkdtemp(prefix='bench-')}")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        # Building plans from Python is a visible share of runs this small.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found, times = catalog(), {}
    lines = table(spark, sf_dir, "lineitem").count()
    for name in wanted:
        rounds = []
        for i in range(ROUNDS + 1):
            start = time.perf_counter()
            found[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                rounds.append(time.perf_counter() - start)
        times[name] = round(statistics.median(rounds), 3)
        print(f"{times[name]:8.3f}  {name}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "total_median_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows_per_second": {
            "dq_report_lineitem": round(lines / times["dq_report_lineitem"])
        } if "dq_report_lineitem" in times else {},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
