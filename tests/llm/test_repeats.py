"""Removed bytes against a set of all earlier 50-byte strings."""
from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from assayframe.llm import repeats
from assayframe.llm.repeats import repeats_report, sort_suffixes, trimmed

SCHEMA = "doc_id long, text string, lang string, part int, n_chars long"


def brute(rows):
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, text, *_ in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - 49):
            w = raw[p:p + 50]
            if w not in first or order(i) < order(first[w]):
                first[w] = i
    out = []
    for i, text, *_ in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - 49):
            if order(first[raw[p:p + 50]]) < order(i):
                gone[p:p + 50] = [True] * 50
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [rng.choice(["the", "of", "and", "é", "other", "word", "xy"]) + rng.choice(["", "er", "ing", "ö"]) for _ in range(40)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [prose(n) for n in (8, 9, 12, 20, 40)] + ["a" * 49, "b" * 50, "c" * 51, "ab" * 60]
    rows = []
    for i in range(90):
        parts = [prose(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(passages)[rng.randrange(0, 6):], prose(rng.randrange(0, 10))]
        rows.append((rng.randrange(0, 10 ** 9) * rng.choice([1, -1]), rng.choice([" ", "", "\n"]).join(parts)))
    rows += [(r[0] + 5, r[1]) for r in rows[:10]] + [(rows[3][0], rows[3][1]), (rows[4][0], rows[5][1])]
    rows += [(None, rows[0][1]), (None, None), (17, ""), (18, None), (19, "é" * 200), (20, "x" + "é" * 100), (21, prose(1500))]
    return [(i, t, "n", 1, 2) for i, t in rows]


@pytest.mark.parametrize("how", [{}, {"part_bytes": 4000, "many": 1}, {"part_bytes": 9000}])
def test_equals_brute_force(spark, monkeypatch, how):
    if how:
        monkeypatch.setattr(repeats, "UNIT_BYTES", 3000)
        monkeypatch.setattr(repeats, "SEGMENT", 700)
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, SCHEMA).repartition(4)
        got = sorted((tuple(r) for r in repeats_report(df, **how).collect()), key=str)
        assert got == sorted((r[:5] for r in brute(rows)), key=str)


def test_trimmed_texts_keep_their_columns(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, SCHEMA)
    got = trimmed(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    want = sorted(((i, kept.decode("utf-8", "ignore"), "n", 1) for i, *_, kept in brute(rows)), key=str)
    found = got.collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == want
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeats_report(empty).collect() == [] and trimmed(empty).collect() == []


def test_sorted_suffixes():
    words = np.random.default_rng(3).integers(0, 3, (500, 7)).astype(np.uint64)
    words[100:160] = words[7]
    order, new = sort_suffixes(words)
    listed = [tuple(r) for r in words[order].tolist()]
    assert listed == sorted(listed)
    assert new.tolist() == [k == 0 or listed[k] != listed[k - 1] for k in range(500)]


def test_texts_without_id_are_many_parts(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 20_000)
    parts = repeats._doc_part(np.full(len(keys), repeats._NO_ID), repeats._salt(keys), 100)
    assert np.bincount(parts, minlength=100).max() < 2 * len(keys) / 100
    rows = [(None if k % 3 else (7 if k % 2 else i), *rest) for k, (i, *rest) in enumerate(corpus(4))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in repeats_report(df, part_bytes=4000).collect()), key=str)
    assert got == sorted((r[:5] for r in brute(rows)), key=str)
