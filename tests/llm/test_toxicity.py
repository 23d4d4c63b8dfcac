"""Toxicity scores: the index against all cosines, held-out accuracy, defined results."""
from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from assayframe.llm.toxicity import BlockMaxIndex, Vectors, fit_curve, terms, toxicity_scores, vote

DOCS = "doc_id long, text string, evidence string, label int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900):
    rng = random.Random(9)
    words = [f"word{k}" for k in range(400)]
    bad = [f"nasty{c}" for c in "abcdefgh"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 7 == 0
        text = [rng.choice(words) for _ in range(rng.randrange(10, 60))]
        if toxic:
            text += [rng.choice(bad) for _ in range(rng.randrange(2, 5))]
        rng.shuffle(text)
        docs.append((i, " ".join(text).capitalize() + ".", "clash", 1))
        labels.append((i, 1, int(toxic)))
    docs += [(9001, None, None, None), (9002, "", "", 0), (9003, "plain words " * 30_000, "", 0), (None, "Nastya, nastyb!", "", 0)]
    return docs, labels + [(3, 1, 0), (4, 1, None), (None, 1, 1), (777777, 0, 1)]


def test_held_out_accuracy_and_rows(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs + docs[:2], DOCS).repartition(5)
    rows = toxicity_scores(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == len(docs) + 2 and all(0 <= r["score"] <= 1 for r in rows)
    truth = {i: t for i, _, t in labels[:900]}
    held = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 900 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([(r["score"] >= 0.7) == truth[r["doc_id"]] for r in held]) > 0.97
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[None]["score"] >= 0.7 and by_id[None]["evidence"][0]["label"] == 1
    assert by_id[9001]["score"] == by_id[9002]["score"] and by_id[9001]["score"] < 0.3 and by_id[9001]["evidence"] == []


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = corpus(300)
    flipped = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    one, two = (sorted((str(r["doc_id"]), r["score"]) for r in toxicity_scores(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped))
    assert one == two


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(i, 1, 1) for i in range(9)], 1.0)])
def test_without_both_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a", "", 0), (2, None, "", 0), (3, "c", "", 0)], DOCS)
    label = spark.createDataFrame(labels, LABELS)
    assert [r["score"] for r in toxicity_scores(docs, label).collect()] == [score] * 3
    assert toxicity_scores(docs.limit(0), label).collect() == []


def test_index_equals_all_cosines():
    rng = random.Random(2)
    texts = [" ".join(f"t{min(int(rng.expovariate(0.08)), 79)}" for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    found, row = terms(pa.array(texts))
    vocabulary, df = np.unique(found, return_counts=True)
    vectors = Vectors(vocabulary, df.astype(float), 300)
    listed = vectors.of(pa.array(texts))
    dense = np.zeros((300, len(vocabulary)))
    for i, (t, w) in enumerate(listed):
        dense[i, t] = w
    assert all(abs(np.linalg.norm(d) - 1) < 1e-9 for d in dense if d.any())
    ids = np.array(rng.sample(range(1000), 300))
    index = BlockMaxIndex(listed, ids, np.zeros(300, int), len(vocabulary), block=8)
    for i, (t, w) in enumerate(listed):
        who, score = index.nearest(t, w, 7, ids[i])
        cosine = dense @ dense[i]
        cosine[i] = 0
        want = sorted(((-round(c, 9), int(ids[k])) for k, c in enumerate(cosine) if c > 0))[:7]
        assert np.allclose([-c for c, _ in want], score)
        assert [x for _, x in want] == index.ids[who].tolist() or len({c for c, _ in want}) < len(want)


def test_terms_votes_and_curve():
    assert len(terms(pa.array(["Ab, abcd abcdef!", None]))[0]) == 3 + 1 + 1
    assert vote(np.array([1, 0]), np.array([1.0, 0.0]), 0.5, 2, 0) == 1.0 and vote(np.zeros(0), np.zeros(0), 0.2) == 0.2
    x = np.linspace(0, 1, 200)
    a, b = fit_curve(x, (x > 0.6).astype(float), np.ones(200))
    assert a > 0 and abs(-b / a - 0.2) < 0.1


def test_rare_and_clean_words_count(spark):
    """Labelled words of one document each, and words that lean to no label, still find neighbours."""
    docs, labels = corpus(600)
    rare = [i for i in range(20_000, 20_200) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    docs += [(rare[0], "zyxgrunt qqvile", "", 0), (rare[1], "sunlit meadow", "", 0)]
    labels += [(rare[0], 1, 1), (rare[1], 1, 0)]
    docs += [(30_001, "Zyxgrunt!", "", 0), (30_002, "a meadow", "", 0)]
    rows = toxicity_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[30_001]["evidence"][0]["doc_id"] == rare[0] and by_id[30_001]["score"] > by_id[30_002]["score"]
    assert by_id[30_002]["evidence"][0]["doc_id"] == rare[1]


def test_terms_are_found_without_a_search_for_each_occurrence(monkeypatch):
    rng = np.random.default_rng(3)
    texts = pa.array([" ".join(f"w{k}" for k in rng.integers(0, 900, 200)) for _ in range(20)] + ["", None])
    vocabulary = np.unique(terms(texts.slice(0, 10))[0])
    vectors = Vectors(vocabulary, np.ones(len(vocabulary)), 10)
    edge = np.array([0, 1, 2**63, 2**64 - 2, 2**64 - 1], np.uint64)
    for known in (vocabulary, np.unique(np.append(vocabulary, edge)), np.arange(2**63, 2**63 + 500, dtype=np.uint64), edge[:1]):
        asked = np.concatenate([vocabulary, edge, known + np.uint64(1), rng.integers(0, 2**64, 500, np.uint64)])
        assert (Vectors(known, np.ones(len(known)), 1).numbers(asked) == np.searchsorted(known, asked)).all()
    want, needles, search = vectors.of(texts), [], np.searchsorted

    def counted(a, v, *more, **named):
        needles.append((len(a), np.size(v)))
        return search(a, v, *more, **named)

    monkeypatch.setattr(np, "searchsorted", counted)
    found = vectors.of(texts)
    assert not [n for size, n in needles if size == len(vocabulary) and n > len(texts) + 1]
    assert all((a == c).all() and (b == d).all() for (a, b), (c, d) in zip(want, found))
