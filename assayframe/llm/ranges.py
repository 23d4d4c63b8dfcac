"""Cutting an order into ranges that tasks share evenly, from a sample that depends on rows alone."""
from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
_UNIT = 1 << 30


def in_sample(rows: int, sample_rows: int, *key: str) -> Column:
    """True for about ``sample_rows`` of ``rows`` rows, by a hash of their key."""
    limit = min(_UNIT, max(1, (sample_rows * _UNIT) // max(rows, 1)))
    return F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(_UNIT)) < F.lit(limit)


def cuts(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """Positions in the sorted ``keys`` (given sorted) that start parts of equal weight."""
    if parts < 2 or not len(keys):
        return np.zeros(0, np.int64)
    grown = np.cumsum(weights)
    at = np.searchsorted(grown, grown[-1] * np.arange(1, parts) / parts)
    return np.unique(at)


def id_cuts(rows: DataFrame, id_column: str, weight: Column, part_weight: int,
            sample_rows: int = SAMPLE_ROWS) -> list[int]:
    """Ids that cut rows in id order into parts of about ``part_weight`` each.

    What reaches the driver is the sample: about ``sample_rows`` pairs of numbers.
    """
    total = rows.count()
    sample = rows.where(in_sample(total, sample_rows, id_column)).where(F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("i"), weight.cast("double").alias("w")).toPandas()
    if not len(sample):
        return []
    sample = sample.sort_values(["i", "w"])
    share = min(1.0, sample_rows / max(total, 1))
    parts = max(1, int(-(-sample["w"].sum() / share // part_weight)))
    at = cuts(sample["i"].to_numpy(), sample["w"].to_numpy() + 1.0, parts)
    return sorted({int(x) for x in sample["i"].to_numpy()[at]})


def range_of(limits: Sequence[int]):
    """A function of an id column: how many limits are not above the id (nulls: 0)."""
    held = np.array(limits, np.int64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        out = np.zeros(len(ids), np.int32)
        out[known] = np.searchsorted(held, ids[known].to_numpy().astype(np.int64), "right")
        return pd.Series(out)

    return part
