"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns of
documents:

1. quality: documents that the classifier rejects go (score below 0.3);
2. near_duplicates: one document of each class of near copies stays;
3. repeats: bytes that an earlier document has too are cut out; a cut inside a character
   drops what is left of it;
4. mixing: every document as often as the mix to target weights takes it;
5. packing: pieces of sequences of at most 1024 ids along the space-filling curve.

No stage is SQL that DuckDB runs (a trained model, sampled paths, bytes, a vocabulary), so
ORACLE_SQL is None and the tests compare every stage with a brute-force version.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.catalog.base import table
from assayframe.llm import mixing, quality, repeats, similarity
from assayframe.llm.catalog import pieces
from assayframe.llm.rows import free_name
from assayframe.session import materialise

LEAST_QUALITY = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = free_name("_quality_score", docs.columns)
    scored = quality.quality_scores(docs, table(spark, sf_dir, "labels"), name=score)
    return scored.where(F.col(score) >= LEAST_QUALITY).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity.without_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.trimmed(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, shard=None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeats", without_repeats),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
