"""Near-duplicate classes and links against all pairs."""
from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from assayframe.llm import similarity
from assayframe.llm.similarity import near_duplicates, run_recall, runs_needed, without_near_duplicates

SCHEMA = "doc_id long, text string, name string, node int"


def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = [shingle_set(t) for _, t, *_ in rows]
    link = [[bool(a and b) and len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if link[i][j] and root[j] < root[i]:
                    root[i], changed = root[j], True
    members = {}
    for i, r in enumerate(root):
        members.setdefault(r, []).append(rows[i][0])
    low = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        near = [j for j in range(len(rows)) if j != i and link[i][j]]
        out.append((doc_id, low[root[i]] if sets[i] else doc_id, len(near), len({sets[j] for j in near} - {sets[i]})))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(500)]
    base = [[rng.choice(words) for _ in range(rng.randrange(30, 150))] for _ in range(25)]
    shared = [rng.choice(words) for _ in range(25)]
    rows = []
    for text in base:
        for changes in (0, 0, 1, 1, 2, 3, 6):
            copy = list(text)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
        rows.append(" ".join(shared + text[:10]))
    rows += [None, "", "  \n", "two words", "Two  WORDS", "a b c d", "a b c d e", "x " * 400, "x " * 900]
    rng.shuffle(rows)
    out = [(i * 3, t, "n", 1) for i, t in enumerate(rows)]
    return out + [(None, "two words", None, None), (9, "repeated row of some words", "", 0), (9, "repeated row of some words", "", 0)]


def answer(spark, rows):
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_text_links"]) for r in got), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_pairs(spark, monkeypatch, small):
    rows = corpus()
    if small:  # split even small nodes, and cut what is left into blocks
        monkeypatch.setattr(similarity, "NODE_SETS", 2)
        monkeypatch.setattr(similarity.chosen_paths, "__defaults__", (similarity.LEVELS, 2))
        monkeypatch.setattr(similarity.spread, "__defaults__", (3,))
    assert answer(spark, rows) == sorted(brute(rows), key=str)


def test_large_group_of_near_copies(spark):
    rng = random.Random(4)
    text = [f"t{k}" for k in range(80)]
    rows = []
    for i in range(260):
        copy = list(text)
        copy[i % 80] = f"new{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy), "", 0))
    assert answer(spark, rows) == sorted(brute(rows), key=str)


def test_one_row_of_each_class_stays(spark):
    rows = corpus(2)
    df = spark.createDataFrame(rows, SCHEMA)
    kept = without_near_duplicates(df)
    assert kept.columns == df.columns
    want = Counter()
    seen = set()
    for (doc_id, text, *_), (_, class_id, *_) in zip(rows, brute(rows)):
        if shingle_set(text):
            seen.add(class_id)
        else:
            want[doc_id] += 1
    want.update(seen)
    assert Counter(r["doc_id"] for r in kept.collect()) == want


def test_empty_and_recall(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert answer(spark, []) == [] and without_near_duplicates(empty).collect() == []
    assert abs(run_recall(0.8, 1) - 0.84) < 1e-9
    runs = runs_needed()
    assert 1 - (1 - run_recall(0.8, similarity.LEVELS)) ** runs >= similarity.TARGET_RECALL


def test_pairs_of_a_large_group_meet(spark):
    """Near copies of one set at similarity 0.8, more than a node holds: nearly all meet it in some run."""
    n = 10 * similarity.NODE_SETS * 8
    rng = np.random.default_rng(5)
    marks = np.full((n, similarity.PLACES), 7, np.uint32)
    other = rng.random(marks.shape) >= 0.8
    other[0] = False
    marks[other] = rng.integers(1 << 10, 1 << 32, other.sum(), dtype=np.uint32)
    sets = spark.createDataFrame([(i.to_bytes(4, "big"), m.tobytes()) for i, m in enumerate(marks)], "name binary, marks binary")
    members = similarity.chosen_paths(sets, runs_needed())
    mine = members.where(F.col("name") == F.lit(bytes(4))).select("node")
    met = members.join(mine, "node").select("name").distinct().count()
    assert n - met <= 3 * (1 - similarity.TARGET_RECALL) * n


def test_one_place_spoils_one_run_at_most(spark):
    """Sets that differ from the first in one place each lose one of its root nodes at most."""
    marks = np.full((similarity.PLACES + 1, similarity.PLACES), 7, np.uint32)
    for place in range(similarity.PLACES):
        marks[place + 1, place] = 1000 + place
    sets = spark.createDataFrame([(bytes([i]), m.tobytes()) for i, m in enumerate(marks)], "name binary, marks binary")
    nodes = {}
    for r in similarity.chosen_paths(sets, runs_needed()).collect():
        nodes.setdefault(bytes(r["name"]), set()).add(r["node"])
    first = nodes[bytes(1)]
    assert min(len(first & x) for x in nodes.values()) >= len(first) - 1
    assert runs_needed() * similarity.LEVELS <= similarity.PLACES
    assert (1 - 0.8 ** similarity.LEVELS) ** runs_needed() <= 1 - similarity.TARGET_RECALL
