"""Join keys, entity keys and stable hash buckets."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The registry key is this prefix and the id's digits, 13 wide.
KEY_PREFIX = "P_M"
KEY_WIDTH = 13


def digits_only(col: Column) -> Column:
    return F.regexp_replace(col.cast("string"), "[^0-9]", "")


def registry_key(
    col: Column, prefix: str = KEY_PREFIX, width: int = KEY_WIDTH, truncate: bool = False
) -> Column:
    """The registry's form of an id: prefix and zero-padded digits.

    Ids without any digit give NULL so that junk cannot match junk.  Digits beyond
    ``width`` are kept; ``truncate=True`` cuts them (and pads digit-free ids with
    zeros) as a plain ``lpad`` does.
    """
    digits = digits_only(col)
    if truncate:
        return F.concat(F.lit(prefix), F.lpad(digits, width, "0"))
    # Named in few places: each is a pass of the pattern where the engine does not share them.
    padded = F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), "0")
    return F.when(digits != "", F.concat(F.lit(prefix), padded))


def strip_prefix(col: Column, prefix: str, sentinels: tuple[str, ...] = ("-1", "")) -> Column:
    """Drop a literal leading ``prefix``; sentinel values become NULL."""
    return (
        F.when(col.isin(*sentinels), F.lit(None))
        .when(col.startswith(prefix), F.substring(col, F.lit(len(prefix) + 1), F.length(col)))
        .otherwise(col)
    )


def entity_key(source: Column, identifier: Column) -> Column:
    """``source:id``; NULL when either part is."""
    return F.concat(source, F.lit(":"), identifier)


def hash_bucket(col: Column, buckets: int = 1000) -> Column:
    """A stable bucket: the first 8 bytes of SHA-1, big-endian, modulo ``buckets``."""
    head = F.substring(F.sha1(col.cast("string").cast("binary")), 1, 16)
    number = F.conv(head, 16, 10).cast("decimal(20,0)")
    return F.pmod(number, F.lit(buckets).cast("decimal(20,0)")).cast("int")


def in_hash_sample(
    key: Column, source: Column, rates: Mapping[str, float], default_rate: float,
    buckets: int = 1000,
) -> Column:
    """True when a key falls into the sample its source is given.

    Sources compare without regard to case.  The same key always decides the same way.
    """
    limit = F.lit(int(default_rate * buckets))
    for name, rate in rates.items():
        limit = F.when(F.upper(source) == name.upper(), F.lit(int(rate * buckets))).otherwise(limit)
    return hash_bucket(key, buckets) < limit
