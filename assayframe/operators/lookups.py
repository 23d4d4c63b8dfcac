"""Lookups against a reference table keyed by a nullable, possibly skewed key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.columns import named

# Rows without a key are spread over at least this many join keys that match nothing,
# and rows of a hot key over at least this many copies of its lookup rows; both follow
# the number of shuffle partitions beyond that.
NULL_SPREAD = 4096
HOT_SPREAD = 64


def find_hot_keys(df: DataFrame, key: str, share: float = 0.01) -> list:
    """Keys that hold more than ``share`` of the rows.

    One sketch per task, merged; at most ``2 / share`` keys reach the driver.  The
    sketch only decides how rows are spread, never what a join returns.
    """
    k = int(2 / share)
    quoted = key.replace("`", "``")
    found = df.agg(
        F.expr(f"approx_top_k(`{quoted}`, {k}, {max(10_000, 4 * k)})").alias("top"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    return [row["item"] for row in found["top"] or [] if row["item"] is not None
            and row["count"] > share * found["n"]]


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str, hot_keys: Sequence = ()
) -> DataFrame:
    """Join on ``key`` (present on both sides) without piling rows up in one task.

    * Rows without a key match nothing in any join type used here.  They get one of
      many stand-in keys instead of all hashing to the same partition.
    * Keys named in ``hot_keys`` are salted: their rows spread over ``HOT_SPREAD``
      partitions and only their lookup rows are copied.  Other skew, such as many exact
      copies of one row, is left to adaptive execution, which splits oversized
      partitions of these joins.

    Salts come from the row's own values, so a repeated task sends every row where it
    went before.  A side is broadcast only when the optimizer's size estimate allows it.
    """
    return lookup_joins(left, [right], key, how, hot_keys)


def lookup_joins(
    left: DataFrame, rights: Sequence[DataFrame], key: str, how: str, hot_keys: Sequence = ()
) -> DataFrame:
    """``lookup_join`` with several tables of one key, one after the other.

    The rows are salted once, so all joins that shuffle use one shuffle of ``left``.
    """
    hashable = [
        named(f.name) for f in left.schema.fields
        if f.name != key and "map<" not in f.dataType.simpleString()
    ]
    hashed = F.xxhash64(*hashable) if hashable else F.lit(0)
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    null_spread, hot_spread = max(NULL_SPREAD, 8 * width), max(HOT_SPREAD, width)
    salt = F.when(named(key).isNull(), (F.pmod(hashed, F.lit(null_spread)) + 1).cast("int"))
    copies = F.array(F.lit(0))
    if hot_keys:
        hot = named(key).isin(*hot_keys)
        salt = salt.when(hot, F.pmod(hashed, F.lit(hot_spread)).cast("int"))
        copies = F.when(hot, F.sequence(F.lit(0), F.lit(hot_spread - 1))).otherwise(copies)
    joined = left.withColumn("_salt", salt.otherwise(0))
    for right in rights:
        matches = right.filter(named(key).isNotNull())
        # Exploded even where it is always 0: a constant would be folded out of the join keys.
        matches = matches.withColumn("_salt", F.explode(copies))
        joined = joined.join(matches, [key, "_salt"], how)
    return joined.drop("_salt")


def with_flag(
    left: DataFrame, keys: DataFrame, key: str, flag: str,
    yes: str = "Y", no: str = "N", hot_keys: Sequence = (),
) -> DataFrame:
    """Whether each row's key occurs in ``keys``; no row is multiplied."""
    found = keys.select(named(key)).distinct().withColumn("_found", F.lit(True))
    return (
        lookup_join(left, found, key, "left", hot_keys)
        .withColumn(flag, F.when(F.col("_found"), yes).otherwise(no))
        .drop("_found")
    )


def without_match(left: DataFrame, keys: DataFrame, key: str, hot_keys: Sequence = ()) -> DataFrame:
    """The rows whose key does not occur in ``keys``, rows without a key included."""
    return lookup_join(left, keys.select(named(key)), key, "left_anti", hot_keys)


def split_by_key(df: DataFrame, key: str, parts: dict[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Cut one wide table into several tables with one row per key.

    The surviving row is the smallest in column order, not whichever came first.
    """
    tables = {}
    for name, columns in parts.items():
        keep = [c for c in columns if c in df.columns and c != key]
        row = F.min(F.struct(*map(named, keep))).alias("_row")
        tables[name] = df.groupBy(named(key)).agg(row).select(named(key), "_row.*")
    return tables


def rejoin(first: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Put tables with one row per key back together around the first."""
    for other in others:
        first = first.join(other, key, "left")
    return first
