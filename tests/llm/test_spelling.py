"""Spelling variants against comparing all words with each other."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from assayframe.catalog.base import table
from assayframe.llm import spelling
from assayframe.llm.catalog import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_counts(rows, damaged):
    seen = Counter()
    for i, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if damaged and h % damaged == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            seen[word] += 1
    return seen


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, damaged=97, length=5, count=3):
    n = {w: c for w, c in brute_counts(rows, damaged).items() if len(w) >= length and c >= count}
    deleted = {}
    for w in n:
        for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))}:
            deleted.setdefault(key, []).append(w)
    close = {w: {v for key in {w, *(w[:i] + w[i + 1:] for i in range(len(w)))} for v in deleted[key] if near(w, v)} for w in n}
    form = {}
    for w in n:
        best = min(close[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return sorted(out, key=lambda r: r[0])


def run(spark, rows, **options):
    docs = spark.createDataFrame([Row(doc_id=i, text=t, word="x", n=1) for i, t in rows],
                                 "doc_id long, text string, word string, n int")
    return sorted((tuple(r) for r in spelling.variants(docs, **options).collect()), key=lambda r: r[0])


@pytest.mark.parametrize("split,leaf", [(4, 48), (1, 2), (2, 0)])
def test_same_as_comparing_all(spark, split, leaf, monkeypatch):
    monkeypatch.setattr(spelling, "LEAF_WORDS", leaf)
    rng = random.Random(split)
    stems = ["".join(rng.choice("abcdeéÿß") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    text = " ".join(s.upper() if rng.random() < 0.2 else s for s in rng.choices(stems, k=3000))
    rows = [(i, text[i * 97:i * 97 + 400]) for i in range(150)]
    rows += [(None, "straße Straßen STRASSE " * 9), (3, None), (3, ""), (4, "aaaaaa aaaaa aaaab aaaaaaa " * 4)]
    rows += [(5, ("q" * 300 + " " + "q" * 299 + " " + "q" * 150 + "r" + "q" * 149 + " ") * 3)]
    assert run(spark, rows, damaged=7, split=split) == brute(rows, 7)


def test_long_chain_of_forms(spark):
    words = ["a" * (5 + i) for i in range(9)]
    rows = [(i, " ".join(w for k, w in enumerate(words) for _ in range(3 * 2 ** k))) for i in range(1)]
    found = run(spark, rows)
    assert {r[2] for r in found} == {words[-1]} and found == brute(rows, None)


def test_empty(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, "ab")]) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abéx", min_size=1, max_size=9), min_size=1, max_size=30, unique=True), st.integers(0, 3))
def test_trie_finds_every_pair(texts, leaf):
    spelling_leaf, spelling.LEAF_WORDS = spelling.LEAF_WORDS, leaf
    try:
        a, b = spelling.near_pairs(spelling.Words(pa.array(texts)), np.ones(len(texts), bool))
    finally:
        spelling.LEAF_WORDS = spelling_leaf
    wanted = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if near(texts[i], texts[j])}
    assert set(zip(a.tolist(), b.tolist())) == wanted


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("aZÀÿ×Ā ,¿", max_size=12), min_size=1, max_size=6))
def test_runs_and_checksums(texts):
    data, start, end, row = spelling.letter_runs(pa.array(texts))
    found = [(r, data[a:b].tobytes().decode()) for r, a, b in zip(row.tolist(), start, end)]
    assert found == [(i, w.translate(LOWER)) for i, t in enumerate(texts) for w in RUN.findall(t)]
    seeds = np.array([zlib.crc32(str(r).encode()) for r in row], np.uint32)
    assert spelling.run_checksums(data, start, end, seeds).tolist() == [zlib.crc32(f"{r}{w}".encode()) for r, w in found]


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op11_spelling"].run(spark, sf)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted((tuple(r) for r in found.collect()), key=lambda r: r[0]) == brute(rows)
