"""Quality scores: updates by the published formula, held-out accuracy, defined results."""
from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayframe.llm import labelled, quality
from assayframe.llm.quality import dots, features, ftrl, quality_scores, weights_of

DOCS = "doc_id long, text string, label string, rate int"


def corpus(n=600):
    rng = random.Random(8)
    words = [f"word{k}" for k in range(300)]
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(5, 80)))
        if not good:
            text = rng.choice([text.upper() + "!!", " ".join([rng.choice(words)] * 30), text.replace(" ", "### ")])
        docs.append((i, text, "clash", 1))
        labels.append((i, int(good), 0))
    docs += [(9001, None, None, None), (9002, "", "", 0), (9003, "long words " * 30_000, "", 0), (None, "null id text", "", 0)]
    labels += [(5, 1, 0), (7, None, 0), (None, 1, 0), (123456, 1, 1)]
    return docs, labels


def test_held_out_accuracy_and_rows(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + docs[:3], DOCS)
    got = quality_scores(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["doc_id", "text", "label", "rate", "score"]
    rows = got.collect()
    assert len(rows) == len(docs) + 3 and all(0 <= r["score"] <= 1 for r in rows)
    truth = {i: q for i, q, _ in labels[:600]}
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.3) == truth[r["doc_id"]] for r in held]) > 0.97
    again = {r["doc_id"]: r["score"] for r in quality_scores(
        df.repartition(5), spark.createDataFrame(labels[::-1], "doc_id long, quality int, toxic int")).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-6 for r in rows)


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus(200)
    flipped = [(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    one, two = (sorted((str(r["doc_id"]), r["score"]) for r in quality_scores(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect())
        for x in (labels, flipped))
    assert one == two


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1, 0), (2, 1, 0), (3, 1, 0)], 1.0)])
def test_without_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a", "", 0), (2, None, "", 0), (3, "c", "", 0)], DOCS)
    got = quality_scores(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert all(abs(r["score"] - score) < 0.01 for r in got)
    assert quality_scores(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect() == []


def test_updates_follow_the_formula():
    rng = np.random.default_rng(0)
    rows = [(rng.choice(20, 5, replace=False), rng.random(5), int(rng.integers(2)), 1.0) for _ in range(50)]
    z, n = np.zeros(20), np.zeros(20)
    ftrl(rows, z, n)
    zs, ns = [0.0] * 20, [0.0] * 20
    for place, value, label, _ in rows:
        def w(i):
            if abs(zs[i]) <= quality.L1:
                return 0.0
            return -(zs[i] - np.sign(zs[i]) * quality.L1) / ((quality.BETA + ns[i] ** 0.5) / quality.ALPHA + quality.L2)
        now = {i: w(i) for i in place}
        p = 1 / (1 + np.exp(-sum(now[i] * v for i, v in zip(place, value))))
        for i, v in zip(place, value):
            g = (p - label) * v
            zs[i] += g - ((ns[i] + g * g) ** 0.5 - ns[i] ** 0.5) / quality.ALPHA * now[i]
            ns[i] += g * g
    assert np.allclose(z, zs) and np.allclose(n, ns)


def test_dots_are_sums_over_features():
    texts = pa.array(["Aa bb bb!", None, "", "Été 12,5 x-y\tZZ"])
    w = np.random.default_rng(1).standard_normal(1 << quality.BITS)
    place, row, words = features(texts)
    want = [quality.SCALE * w[place[row == i]].sum() / max(1, words[i]) for i in range(4)]
    assert np.allclose(dots(texts, w), want) and words.tolist() == [3, 0, 0, 4]
    assert np.bincount(row, minlength=4).tolist() == [3 + 2 + 3 + 2 + 2, 0, 0, 4 + 3 + 4 + 3 + 3]
    assert (weights_of(np.zeros(3), np.ones(3)) == 0).all()


def test_the_sample_is_bounded_in_rows_and_bytes(spark):
    docs = [(1, f"text {i}") for i in range(3000)] + [(2, "other words")] * 500 + [(i, "long " * 200) for i in range(10, 60)]
    labels = [(1, 1), (2, 0), *[(i, i % 2) for i in range(10, 60)]]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    found = labelled.sample(docs, labels, "quality", F.lit(True), 64, "test").collect()
    assert len(found) < 100 and len({(r.doc_id, r.text) for r in found}) == len(found)
    short = labelled.sample(docs, labels, "quality", F.lit(True), 10_000, "test", most_bytes=20_000).collect()
    assert 0 < sum(len(r.text) for r in short) < 40_000
