"""Session helpers: the shared scratch folder and tables written to it."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster a missing setting is an error, because executors share no disk.
    """
    configured = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    own = getattr(spark.sparkContext, "_assayframe_scratch", None)
    if own is None:
        own = tempfile.mkdtemp(prefix="assayframe-")
        spark.sparkContext._assayframe_scratch = own
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the scratch folder."""
    return f"{scratch_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet and read it back.

    This cuts lineage like ``checkpoint()`` does, survives lost executors, and
    unlike a checkpoint keeps column pruning and filter pushdown for later reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
