"""Bounded, repeatable samples of labelled documents."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.ranges import in_sample
from assayframe.session import materialise

MOST_BYTES = 64 << 20
_UNIT = 1 << 30


def fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, usable, most: int, seed: str,
           most_bytes: int = MOST_BYTES) -> DataFrame:
    """(doc_id, text, label, rate): about ``most`` / 2 labelled documents of each class, stored.

    Ids are chosen by a hash; ``rate`` is the part of the class that was taken.  Rows that agree
    in id and text are one.  If ids repeat with other texts, or texts are long, rows are thinned
    by a hash of both until a class has about ``most`` / 2 rows and ``most_bytes`` / 2 bytes.
    Several labels of a document count as their mean, rounded up from one half; rows without
    label or id are left out.  The ids are broadcast, which ``most`` bounds.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(usable).groupBy("doc_id").agg(
        (F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    known = materialise(known, "labels")
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    chosen = None
    for value, count in sorted(counts.items()):
        part = known.where(F.col("label") == value).where(in_sample(count, most // 2, "doc_id")).withColumn(
            "rate", F.lit(min(1.0, most / 2 / count)))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = known.withColumn("rate", F.lit(1.0))
    texts = docs.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").withColumn("_key", F.xxhash64("doc_id", "text"))
    sizes = found.select("label", "_key", F.octet_length("text").cast("long").alias("bytes")).groupBy("label", "_key").agg(
        F.max("bytes").alias("bytes")).groupBy("label").agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).collect()
    share = {r["label"]: min(1.0, most / 2 / r["rows"], most_bytes / 2 / max(r["bytes"], 1)) for r in sizes}
    # a class within its bounds, but for the spread of the hash, stays whole
    share = {value: 1.0 if part > 0.9 else part for value, part in share.items()}
    taken = F.lit(1.0)
    for value, part in sorted(share.items()):
        taken = F.when(F.col("label") == value, F.lit(part)).otherwise(taken)
    kept = F.pmod(F.xxhash64(F.lit("thin"), "_key"), F.lit(_UNIT)) < taken * _UNIT
    return materialise(found.where(kept).withColumn("rate", F.col("rate") * taken).dropDuplicates(["doc_id", "_key"])
                       .drop("_key"), "labelled-" + seed)
