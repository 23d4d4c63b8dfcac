"""One local session for all tests."""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def make_session(cores: str = "8") -> SparkSession:
    shared = tempfile.mkdtemp(prefix="assayframe-tests-")
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("assayframe-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoints")
        .getOrCreate()
    )
