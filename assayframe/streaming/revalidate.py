"""Validate files as they arrive: one scored run per micro-batch."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from assayframe.operators.checks import run_checks
from assayframe.operators.report import build_summary
from assayframe.rules import Rules


def revalidate(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    rules: Rules,
    history: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    every: str | None = None,
    file_format: str = "parquet",
    **options: str,
) -> StreamingQuery:
    """Start the run; without ``every`` it handles what is there and stops.

    Nothing is kept between batches.  Each batch overwrites its own ``run_id`` folder
    of the history, so a batch that is repeated after a failure leaves one run.
    ``options`` go to the file reader.
    """
    source = spark.readStream.schema(schema).format(file_format).options(**options)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)

    def score(batch: DataFrame, batch_id: int) -> None:
        run = build_summary(run_checks(batch, rules), folder)
        run.withColumn("run_id", F.lit(f"batch-{batch_id:06d}")).coalesce(1).write.mode(
            "overwrite").parquet(f"{history.rstrip('/')}/batch={batch_id:06d}")

    writer = source.load(folder).writeStream.foreachBatch(score).option(
        "checkpointLocation", checkpoint)
    timing = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**timing).start()


def batch_history(spark: SparkSession, history: str) -> DataFrame:
    """All scored batches in order."""
    return spark.read.parquet(history).drop("batch").orderBy("run_id")
