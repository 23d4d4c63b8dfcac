"""Keys that let rows meet what was found for them, and the rows that stay."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["row_key_1", "row_key_2"]


def row_keys() -> dict[str, Column]:
    """128 bits that stand for doc_id and text; rows equal in both are interchangeable."""
    parts = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text")]
    return {KEYS[0]: F.xxhash64(F.lit(1), *parts), KEYS[1]: F.xxhash64(F.lit(2), *parts)}


def exact(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keep_one(docs: DataFrame, kept_keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``kept_keys``, one row per key, columns unchanged.

    One shuffle of the texts: the join and the numbering use the same partitioning.  The
    columns travel in one struct, so no name of theirs meets one used here.
    """
    same = Window.partitionBy(*KEYS).orderBy(F.lit(1))
    rows = docs.select(F.struct(*[exact(c) for c in docs.columns]).alias("whole"), *[k.alias(n) for n, k in row_keys().items()])
    first = rows.join(kept_keys.select(*KEYS), KEYS).withColumn("row_no", F.row_number().over(same)).where("row_no = 1")
    return first.select("whole.*")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores behind it until no other column has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name
