"""Every stage of the pipeline keeps what it should, and takes effect."""
from __future__ import annotations

from collections import Counter

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F

from assayframe.session import materialise
from test_repeats import brute as brute_repeats
from test_similarity import brute as brute_near

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, blob string"


def test_stages_on_real_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    names = docs.columns
    for name, stage in pipeline.STAGES:
        made = stage(spark, docs, sf)
        if name != "packing":
            assert made.columns == names
        docs_before, docs = docs, materialise(made, "test-" + name)
        counts.append(docs.count())
        if name == "near_duplicates":
            rows = [tuple(r) for r in docs_before.select("doc_id", "text").collect()]
            classes = {c for _, c, *_ in brute_near(rows)}
            assert {r["doc_id"] for r in docs.collect()} == classes
        if name == "repeats":
            rows = [tuple(r) for r in docs_before.select("doc_id", "text").collect()]
            want = Counter((r[0], r[5].decode("utf-8", "ignore")) for r in brute_repeats(rows))
            assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == want
    assert counts[0] >= counts[1] >= counts[2] == counts[3] and counts[5] > 0
    assert pipeline.run(spark, sf).count() == counts[5]


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None, None, None), (None, "", "x", "s", 0, 1.0, "b"),
                                       (2, "a few words here now", "en", "s", 20, 0.5, "b")] * 2])
def test_odd_rows_and_extra_columns(spark, sf, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name, stage in pipeline.STAGES:
        made = stage(spark, docs, sf)
        if name != "packing":
            assert made.columns == docs.columns
            docs = materialise(made, "test-odd")
    assert (made.agg(F.sum("length")).first()[0] or 0) >= docs.count()
