"""Block-pruned search against all products."""
from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from assayframe.llm.search import top_k

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def brute(rows, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (qi, q) in enumerate(usable):
        if qi % 50:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for n, (i, v) in enumerate(usable) if n != own)[:k]
        out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(df, F.col("vec_id") % 50 == 0, **how)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("how", [{}, {"block_rows": 4, "run_rows": 30, "query_rows": 2}])
def test_equals_all_products(spark, how):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-8, 8)) / 64 for _ in range(6)], "x", "y") for i in range(160)]
    rows += [(7, [0.5] * 6, None, None), (8, None, None, None), (9, [None] * 6, None, None),
             (None, [1.0] * 6, None, None), (200, [math.nan] * 6, None, None),
             (250, [math.inf] * 6, None, None), (300, [], None, None), (301, [9.0, 9.0], None, None)]
    rows += [(500 + i, [0.25] * 6, "copy", "copy") for i in range(40)]
    assert found(spark, rows, **how) == brute(rows, 5)


def test_skewed_ids_and_large_values(spark):
    rows = [(i, [float(i % 7), 1e6 * (i % 3)], "", "") for i in range(60)] + [(10 ** 12, [1.0, 1.0], "", "")]
    assert found(spark, rows, run_rows=8, block_rows=3) == brute(rows, 5)


def test_empty_and_single(spark):
    assert found(spark, []) == []
    assert found(spark, [(50, [1.0], "", "")]) == []
    assert found(spark, [(50, [1.0], "", ""), (51, [2.0], "", "")]) == [(50, 1, 51, 256 * 512)]


@pytest.mark.parametrize("how", [{}, {"block_rows": 2, "run_rows": 4, "query_rows": 2}])
def test_repeated_query_ids(spark, how):
    rows = [(50, [1.0, 0.0], "", ""), (50, [0.0, 1.0], "", ""), (50, [1.0, 0.0], "", ""), (100, [1.0, 1.0], "", ""),
            (1, [2.0, 0.5], "", ""), (2, [0.5, 3.0], "", "")]
    assert found(spark, rows, **how) == brute(rows, 5)
