"""Targets, draws and the splitting tree."""
from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from assayframe.llm import mixing
from assayframe.llm.mixing import draw, mix, mix_report, split_quotas, targets, with_sizes

SCHEMA = "doc_id long, text string, source string, size string, copy int"


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected_targets(rows, most=3):
    sizes = Counter()
    for _, text, source, *_ in rows:
        sizes[source] += size_of(text)
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def corpus():
    rows = []
    for i in range(400):
        source = ["src0", "a", None, "Z", "é", ""][min(i % 11, 5)]
        rows.append((i, " ".join(f"w{i}x{k}" for k in range(i % 37)), source, "clash", 1))
    rows += [(900, None, "a", None, None), (901, "", "a", None, None), (902, "x " * 3000, "src0", None, None)]
    rows += [(903, "same text", "Z", "clash", 1)] * 5
    return rows


def test_targets_and_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mix_report(df, shards=5, blocks_per_shard=8).collect()
    want = expected_targets(rows)
    assert len(got) == len(rows)
    source = {}
    for i, text, s, *_ in rows:
        source[i] = s
    taken, largest = Counter(), Counter()
    for r in got:
        s = source[r["doc_id"]]
        assert abs(r["target"] - want[s]) < 1e-6
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        assert all(0 <= x < 5 for x in r["shards"])
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s, words in want.items():
        assert abs(taken[s] - words) <= largest[s]
    again = mix_report(df.repartition(7), shards=5, blocks_per_shard=8)
    assert sorted(map(str, again.select("doc_id", "size", "taken").collect())) == sorted(
        str(x) for x in spark.createDataFrame(got).select("doc_id", "size", "taken").collect())


def test_mixed_rows_match_the_report(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    mixed = mix(df, shards=5, blocks_per_shard=8)
    assert mixed.columns == df.columns + ["mix_shard"]
    copies = Counter(r["doc_id"] for r in mixed.collect())
    words = Counter()
    for r in mix_report(df, shards=5, blocks_per_shard=8).collect():
        words[r["doc_id"]] += r["taken"]
    sizes = {i: size_of(t) for i, t, *_ in rows}
    assert all(words[i] == copies[i] * sizes[i] for i in sizes)


def test_tree_keeps_quotas_and_is_hypergeometric(spark):
    quotas = spark.createDataFrame([(0, 40), (1, 17), (2, 0), (3, 3)], "source_no int, blocks long")
    first = Counter()
    for seed in range(30):
        got = split_quotas(quotas, 6, seed).collect()
        totals, per = Counter(), Counter()
        for r in got:
            totals[r["source_no"]] += r["blocks"]
            per[r["shard"]] += r["blocks"]
        assert totals == {0: 40, 1: 17, 2: 0, 3: 3} and sorted(per) == list(range(6))
        assert max(per.values()) - min(per.values()) <= 2
        first.update({r["source_no"]: r["blocks"] for r in got if r["shard"] == 0})
    assert abs(first[0] / 30 - 40 / 6) < 1 and abs(first[1] / 30 - 17 / 6) < 1


def test_blocks_are_disjoint_between_shards(spark):
    df = spark.createDataFrame(corpus(), SCHEMA)
    drawn = draw(with_sizes(df), 5, 8).where("copy is not null")
    assert drawn.groupBy("source", "block").agg(F.countDistinct("shard").alias("n")).where("n > 1").isEmpty()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mix_report(empty).collect() == [] and mix(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, " ", "a", None, None)], SCHEMA)
    assert {(r["doc_id"], r["taken"], r["target"]) for r in mix_report(blank).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
    assert targets(with_sizes(empty)).collect() == []


def test_columns_of_the_user_survive(spark):
    """Every name that the operator and its helpers use, as a column of the input."""
    names = ["whole", "place", "rows", "draw", "shard", "mix_shard", "mix_key_1", "mix_key_2", "mix_no", "mix_rows",
             "size", "row", "row_no", "row_key_1", "row_key_2", "_quality_score"]
    rows = [(i % 40 or None, f"text {i % 30} of some words", "ab"[i % 2], *[f"{n}-{i}" for n in names]) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{n} string" for n in names))
    from assayframe.llm.rows import KEYS, keep_one, row_keys

    for made in (mixing.mix(docs), mixing.mix(docs, shard=None), keep_one(docs, docs.select(*[k.alias(n) for n, k in row_keys().items()]).distinct())):
        found = made.select(*docs.columns).collect()
        assert found and {tuple(r) for r in found} <= set(rows)
    assert mixing.mix(docs).columns == [*docs.columns, "mix_shard_"] and KEYS
    assert mixing.mix(docs, shard=None).columns == docs.columns


def test_equal_rows_and_rows_without_id(spark):
    rows = [(None, f"{i} word", "a") for i in range(300)] + [(7, "same words here", "b")] * 200 + [(i, "x y z", "c") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    report = mixing.mix_report(docs).collect()
    mixed = mixing.mix(docs, shard=None).collect()
    assert sum(r.taken for r in report) == sum(len(r.text.split()) for r in mixed)
