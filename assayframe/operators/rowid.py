"""Dense row numbers and occurrence numbers without a single-task window."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.columns import name_sql, named
from assayframe.session import materialise

ROW_ID = "row_id"
# Rows of one key that one task numbers at a time.
BLOCK_ROWS = 1_000_000
# Rows that one range of an ordered table holds at most, about.
RANGE_ROWS = 1_000_000
_READ = ("_file", "_start", "_read")
_PLACE = ("_row_path", "_row_index")
# The path of a file as 96 bits of fixed width, which is what rows are joined by.
_ROW = ("_row_file", "_row_check", "_row_index")


def _with_reading_position(df: DataFrame) -> DataFrame:
    """Where each row was read: file, start of its split, and position as Spark counts.

    Spark packs splits into tasks by size, so its own count follows the files only
    inside a split.  A table that is not read from files has no file and no split.
    """
    counted = df.withColumn("_read", F.monotonically_increasing_id())
    try:
        return counted.withColumns({
            "_file": F.col("_metadata.file_path"), "_start": F.col("_metadata.file_block_start")})
    except AnalysisException:
        return counted.withColumns({"_file": F.lit(""), "_start": F.lit(0).cast("bigint")})


def _with_row_index(df: DataFrame) -> DataFrame | None:
    """File and place in it of each row, where the format knows them (parquet does)."""
    try:
        found = df.withColumns({
            "_row_path": F.col("_metadata.file_path"), "_row_index": F.col("_metadata.row_index")})
    except AnalysisException:
        return None
    return found.withColumns({"_row_file": F.xxhash64("_row_path"), "_row_check": F.crc32(F.col("_row_path").cast("binary"))})


def _before(pieces: DataFrame, order: Sequence[str]) -> DataFrame:
    """``_shift``: the rows of all earlier pieces, stored.  One row per file, split or range."""
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    return materialise(pieces.withColumn("_shift", shift).drop("_rows").coalesce(1), "offsets")


def with_row_id(
    df: DataFrame,
    order: Sequence[str] = (),
    name: str = ROW_ID,
    partitions: int | None = None,
    plain_scan: bool = False,
    keep: bool = False,
) -> DataFrame:
    """Number the rows 0..n-1 in the given order; ties keep the order they are read in.

    Reading order is by file path and position in the file.  ``plain_scan`` states that
    the table is a scan of files with at most a projection on it.  Parquet then names the
    place of each row in its file, so an unordered number is that place plus the rows of
    earlier files, and nothing is written.  An ordered number range-partitions and sorts
    the order columns and places alone; what is written is a place and a number a row, and
    the table is joined to it by place (a table of order columns alone needs no join).
    ``keep`` writes whole rows with their numbers instead: one write in place of a join for
    each later use, for tables that are read several times.  Places are part of the range key, so no order
    value is too frequent to be split over several tasks.

    Anything else is written once with its reading positions: a repeated task must see the
    positions it saw before, or rows would change ranges half way.
    """
    spark = df.sparkSession
    found, ties = _with_row_index(df) if plain_scan else None, list(_PLACE)
    if found is None:
        found, ties = _with_reading_position(df), list(_READ)
        if not (plain_scan and keep and order):  # whole rows of a plain scan are written below
            stored = materialise(found, "positions")
            if not order:
                return _numbered_by_split(stored, df.columns, name)
            found = _with_row_index(stored)
    if not order:
        files = found.groupBy("_row_path").agg(F.count(F.lit(1)).alias("_rows"))
        return found.join(_before(files, ["_row_path"]), "_row_path").select(
            *map(named, df.columns), (F.col("_shift") + F.col("_row_index")).alias(name))
    keys = [*map(named, order), *map(F.col, ties)]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or max(width, -(-found.count() // RANGE_ROWS))
    carried = [] if keep or set(df.columns) <= set(order) else list(_ROW)
    in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    kept = carried or df.columns
    placed = materialise(
        found.select(*map(named, dict.fromkeys([*order, *ties, *kept])))
        .repartitionByRange(n, *keys).sortWithinPartitions(*keys)
        .select(*map(named, kept), F.spark_partition_id().alias("_part"), in_part.alias("_place")), "rowid")
    ranges = _before(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), ["_part"])
    numbers = placed.join(ranges, "_part").withColumn("_number", F.col("_shift") + F.col("_place"))
    if carried:
        numbers = found.join(numbers.select(*carried, "_number"), carried)
    return numbers.select(*map(named, df.columns), F.col("_number").alias(name))


def _numbered_by_split(stored: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Numbers in reading order; the rows of a split follow each other in one task."""
    split = ["_file", "_start", "_part"]
    stored = stored.withColumn("_part", F.shiftright("_read", 33))
    pieces = stored.groupBy(*split).agg(F.count(F.lit(1)).alias("_rows"), F.min("_read").alias("_first"))
    return stored.join(_before(pieces, split), split).select(
        *map(named, columns), (F.col("_shift") + F.col("_read") - F.col("_first")).alias(name))


def occurrence(
    df: DataFrame,
    key: Sequence[str],
    row_id: str = ROW_ID,
    name: str = "occurrence",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Number the rows of each key 0, 1, 2… in row order; NULL keys form one group.

    Rows are numbered inside (key, block of row ids) and shifted by the size of the
    key's earlier blocks.  Block sizes are combined before they are shuffled, so a
    key that holds a third of the table is spread over many tasks.
    """
    keys = [named(c) for c in key]
    blocked = df.withColumn("_block", F.expr(f"{name_sql(row_id)} div {block_rows}"))
    inside = Window.partitionBy(*keys, "_block").orderBy(named(row_id))
    numbered = blocked.withColumn(name, F.row_number().over(inside).cast("bigint") - 1)
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    shifts = (
        blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        # Only keys that span blocks need a shift.
        .filter("_shift > 0")
        .select(*[c.alias(f"_k{i}") for i, c in enumerate(keys)], F.col("_block").alias("_b"), "_shift")
    )
    same: list[Column] = [c.eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(keys)]
    on = reduce(Column.__and__, same, F.col("_block") == F.col("_b"))
    return (
        numbered.join(shifts, on, "left")
        .withColumn(name, F.col(name) + F.coalesce("_shift", F.lit(0)))
        .drop("_block", "_b", "_shift", *[f"_k{i}" for i in range(len(keys))])
    )


def mark_repeats(df: DataFrame, key: Sequence[str], row_id: str = ROW_ID) -> DataFrame:
    """Flag every row whose key occurred in an earlier row."""
    return occurrence(df, key, row_id, "_nth").withColumn(
        "is_repeat", F.col("_nth") > 0
    ).drop("_nth")


def head(df: DataFrame, rows: int, row_id: str = ROW_ID) -> DataFrame:
    """The first rows of an ordered table, as a filter the scan can use."""
    return df.filter(named(row_id) < rows)
