"""Registered queries of the corpus operators."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayframe.catalog.base import Query, table
from assayframe.llm import fingerprints, labelled, mixing, packing, quality, quotes, repeats, search, similarity, spelling, superkmers, toxicity, turns, warc
from assayframe.session import scratch_path


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read_archives(spark, path, payloads=False)


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_text_links")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", F.coalesce(labelled.fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.quality_scores(docs, table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", F.coalesce(labelled.fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(table(spark, sf_dir, "documents"))


def pieces(docs: DataFrame) -> DataFrame:
    """Pieces under the byte-level vocabulary, with a checksum in place of their ids."""
    import public_tokenizers as files

    found = packing.pack(docs, files.path("byte_bpe_50k.json"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN)
    return found.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                        "sequence_id", "offset")


def fingerprinted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.linked(table(spark, sf_dir, "conversations"))


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(table(spark, sf_dir, "documents"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), spelling.DAMAGED)


def repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superkmers.windows_report(table(spark, sf_dir, "documents"))


def repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair_report(table(spark, sf_dir, "conversations"))


SEARCH_SQL = """
WITH q AS (
  SELECT row_number() OVER () AS own, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.own, a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.own <> b.own WHERE a.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

QUERIES: dict[str, Query] = {
    "op1_jaccard_join": Query(near),
    "op2_toxicity": Query(toxic),
    "op3_quality": Query(good),
    "op4_warc": Query(archives),
    "op5_packing": Query(packed),
    "op6_mixing": Query(mixed),
    "op7_quotations": Query(replies),
    "op8_fingerprints": Query(fingerprinted),
    "op9_repeats": Query(repeated),
    "op10_topk": Query(neighbours, SEARCH_SQL),
    "op11_spelling": Query(spellings),
    "op12_superkmers": Query(repeated_windows),
    "op13_repair": Query(repaired),
}
