"""Activity, channel and status classes of entities."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts of the classes and the contract categories behind them.
ACTIVE_DETAIL = "Active in last 12 months"
INACTIVE_DETAIL = "No transactions in last 12 months"
FACE_TO_FACE = (1, 9)
REMOTE = (8, 10)
SENTINEL_CODES = ("-1", "-2", "-3", "-4", "-5")


def is_active(recent_count: Column) -> Column:
    return F.coalesce(recent_count > 0, F.lit(False))


def activity_detail(recent_count: Column) -> Column:
    return F.when(is_active(recent_count), ACTIVE_DETAIL).otherwise(INACTIVE_DETAIL)


def activity_status(recent_count: Column) -> Column:
    return F.when(is_active(recent_count), "Active").otherwise("Inactive")


def _overlaps(categories: Column, wanted: Sequence) -> Column:
    return F.coalesce(
        F.arrays_overlap(categories, F.array(*[F.lit(w) for w in wanted])), F.lit(False)
    )


def two_way_class(
    categories: Column, first: Sequence, second: Sequence, first_name: str, second_name: str
) -> Column:
    """Which of two category groups a set touches: both, one, or ``Unknown``."""
    in_first, in_second = _overlaps(categories, first), _overlaps(categories, second)
    label = F.concat_ws("+", F.when(in_first, F.lit(first_name)), F.when(in_second, F.lit(second_name)))
    return F.when(in_first | in_second, label).otherwise("Unknown")


def activity_channel(categories: Column, first=FACE_TO_FACE, second=REMOTE) -> Column:
    return two_way_class(categories, first, second, "CP", "CNP")


def contracting_channel(categories: Column, first=FACE_TO_FACE, second=REMOTE) -> Column:
    return two_way_class(categories, first, second, "F2F", "NF2F")


def status_from_end(end: Column) -> Column:
    return F.when(end.isNull(), "Active").otherwise("Terminated")
