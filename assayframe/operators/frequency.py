"""Counts, shares, distributions and latest rows per key."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayframe.columns import named
from assayframe.functions.text import percent
from assayframe.session import materialise


def frequency(df: DataFrame, columns: Sequence[str], count: str = "count") -> DataFrame:
    return (
        df.groupBy(*map(named, columns)).agg(F.count(F.lit(1)).alias(count))
        .orderBy(*map(named, columns))
    )


def most_frequent(df: DataFrame, columns: Sequence[str], count: str = "count") -> DataFrame:
    return (
        df.groupBy(*map(named, columns)).agg(F.count(F.lit(1)).alias(count))
        .orderBy(F.desc(count), *map(named, columns))
    )


def shares(df: DataFrame, column: str, share: str = "share") -> DataFrame:
    """Normalised frequencies of a column."""
    counted = df.groupBy(named(column)).agg(F.count(F.lit(1)).alias("_count"))
    # The total adds the grouped counts, whose shuffle is reused: the table is read once.
    total = counted.agg(F.sum("_count")).scalar()
    return counted.select(named(column), (F.col("_count") / total).alias(share)).orderBy(named(column))


def distributions(
    df: DataFrame, cuts: Sequence[Sequence[str]], measures: Mapping[str, Column]
) -> DataFrame:
    """Several group-bys over one scan; columns outside a cut are NULL.

    ``cut`` numbers the grouping, so NULL group keys stay apart from absent ones.
    """
    names = list(dict.fromkeys(name for cut in cuts for name in cut))
    cols = {name: named(name) for name in names}
    grouped = df.groupingSets(
        [[cols[name] for name in cut] for cut in cuts], *cols.values()
    ).agg(F.grouping_id().alias("_gid"), *[m.alias(name) for name, m in measures.items()])
    ids = {}
    for i, cut in enumerate(cuts):
        gid = sum(1 << (len(names) - 1 - pos) for pos, name in enumerate(names) if name not in cut)
        ids[gid] = i
    pairs = [F.lit(part) for item in ids.items() for part in item]
    return grouped.select(
        F.try_element_at(F.create_map(*pairs), F.col("_gid").cast("int")).alias("cut"),
        *[named(name) for name in names],
        *[F.col(name) for name in measures],
    )


def distinct_beside_count(df: DataFrame, group: str, column: str, approximate: bool = False) -> DataFrame:
    """Rows and distinct values per group.

    Exact counting first reduces to one row per (group, value), so a hot group is
    spread by its values; ``approximate`` uses a sketch and no second shuffle.
    """
    if approximate:
        return df.groupBy(named(group)).agg(
            F.count(F.lit(1)).alias("count"),
            F.approx_count_distinct(named(column)).alias("distinct_count"),
        )
    pairs = df.groupBy(named(group), named(column)).agg(F.count(F.lit(1)).alias("_rows"))
    return pairs.groupBy(named(group)).agg(
        F.sum("_rows").alias("count"), F.count(named(column)).alias("distinct_count")
    ).orderBy(named(group))


def latest_per_key(
    df: DataFrame, key: Sequence[str], version: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest version of each key; NULL versions come last.

    A maximum over (version, tie-break, rest) is combined before the shuffle, so a
    key with a third of all rows sends one row per task.  Ties are settled by the
    remaining columns, which makes the choice independent of row order.
    """
    first = [version, *tie_break]
    rest = [c for c in df.columns if c not in (*key, *first)]
    best = F.max(F.struct(*[named(c) for c in (*first, *rest)])).alias("_best")
    return df.groupBy(*map(named, key)).agg(best).select(
        *[named(c) if c in key else F.col("_best").getField(c).alias(c) for c in df.columns]
    )


def category_text(df: DataFrame, key: str, column: str, separator: str = ", ") -> DataFrame:
    """The distinct categories of each key as one text, in sorted order."""
    pairs = df.select(named(key), named(column)).distinct()
    return pairs.groupBy(named(key)).agg(
        F.array_join(F.array_sort(F.collect_list(named(column))), separator).alias(column)
    )


def step_change(
    df: DataFrame, order: str, columns: Mapping[str, str], partitions: int | None = None,
    few: bool = False,
) -> DataFrame:
    """Differences between consecutive rows; the first row has 0.

    Rows are range-partitioned by ``order`` and compared inside their range; the first row
    of a range is compared with the last row of the range before it that has any.  What
    passes from range to range is one struct of the compared values each.  Rows with equal
    order are ordered by these values, rows without one come first.  The ranges are stored,
    so that a repeated task finds its row in the range where it was.

    ``few`` states that the rows are bounded by something the caller holds in memory, such
    as the steps of a plan; they are then compared in one window.
    """
    old = F.struct(*[named(c).alias(f"_{i}") for i, c in enumerate(columns)])
    ties = [named(order), *map(named, columns)]
    if few:
        before = F.lag(old).over(Window.orderBy(*ties))
        return df.withColumn("_before", before).withColumns(_changes(columns)).drop("_before")
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialise(
        df.repartitionByRange(width, named(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*ties)
    compared = rows.withColumns({"_before": F.lag(old).over(inside), "_after": F.lead(old).over(inside)})
    # One entry a range that has rows, at most ``width``; each gets the end of the one before.
    ends = compared.filter("_after IS NULL").agg(
        F.array_sort(F.collect_list(F.struct("_range", old.alias("_end")))).alias("_ends"))
    carried = ends.select(F.inline(F.transform("_ends", lambda end, i: F.struct(
        end["_range"].alias("_range"), F.get("_ends", i - 1)["_end"].alias("_carried")))))
    return (
        compared.join(carried, "_range", "left")
        .withColumn("_before", F.coalesce("_before", "_carried"))
        .withColumns(_changes(columns)).drop("_before", "_after", "_carried", "_range")
    )


def _changes(columns: Mapping[str, str]) -> dict[str, Column]:
    return {
        new: F.coalesce(F.bround(named(old) - F.col("_before")[f"_{i}"], 2), F.lit(0))
        for i, (old, new) in enumerate(columns.items())
    }


def share_of_group(counts: DataFrame, group: str, count: str, share: str) -> DataFrame:
    """Each count as a percentage of its group's total, over already grouped rows."""
    total = F.sum(named(count)).over(Window.partitionBy(named(group)))
    return counts.withColumn(share, percent(named(count), total))
