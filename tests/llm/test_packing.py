"""Packed sequences hold every id of every document once."""
from __future__ import annotations

import itertools

import numpy as np
import public_tokenizers as files
from tokenizers import Tokenizer

from assayframe.llm.packing import Tokens, hilbert, pack

SCHEMA = "doc_id long, text string, part string, key string"
BPE = files.path("byte_bpe_50k.json")
RANKS = files.path("byte_bpe_50k.tiktoken")


def corpus():
    rows = [(i, " ".join(["alpha", "beta", "gämma", "don't", "12,5"][(i * k) % 5] for k in range(i % 90))) for i in range(200)]
    rows += [(900, None), (901, ""), (902, "long text " * 6000), (903, "a<|endoftext|>b"), (None, "no id"),
             (904, "日本語   \x1c tab\tend  \n\n x"), (905, "same"), (905, "same")]
    rows += [(1000 + i, "hot copy of one text " * 40) for i in range(60)]
    return [r + ("clash", "clash") for r in rows]


def check(rows, pieces, length):
    full = Tokenizer.from_file(BPE)
    want = sorted((i is None, i or 0, tuple(full.encode(t or "", add_special_tokens=False).ids) + (0,)) for i, t, *_ in rows)
    parts = {}
    for p in pieces:
        assert p["length"] * 4 == len(p["ids"]) and p["length"] > 0
        parts.setdefault(p["doc_id"], []).append(p)
    got = []
    for doc_id, own in parts.items():
        own.sort(key=lambda p: (p["start"]))
        open_ = []  # repeated ids: match pieces by where they start
        for p in own:
            ids = tuple(np.frombuffer(p["ids"], "<u4").tolist())
            for x in open_:
                if len(x[0]) == p["start"] and x[1] == p["doc_tokens"] and len(x[0]) < x[1]:
                    x[0] += ids
                    break
            else:
                assert p["start"] == 0
                open_.append([ids, p["doc_tokens"]])
        assert all(len(ids) == n for ids, n in open_)
        got += [(doc_id is None, doc_id or 0, ids) for ids, _ in open_]
    assert sorted(got) == want
    padding = 0
    by_sequence = itertools.groupby(sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])), key=lambda p: p["sequence_id"])
    for _, own in by_sequence:
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0


def test_every_id_once(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for part_bytes, length in ((1 << 24, 1024), (9_000, 64)):
        pieces = pack(df, BPE, RANKS, files.PATTERN, length=length, part_bytes=part_bytes).collect()
        check(rows, pieces, length)
    again = pack(df.repartition(3), BPE, RANKS, files.PATTERN, length=64, part_bytes=9_000).collect()
    assert sorted(map(str, again)) == sorted(map(str, pieces))


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], SCHEMA), BPE).collect() == []


def test_fast_path_has_equal_ids():
    fast, full = Tokens(BPE, RANKS, files.PATTERN), Tokenizer.from_file(BPE)
    texts = ["", " ", "a  b\n\n\tc ", "it's we'll DON'T", " x\u0085y", "ñ Ω я 漢 🙂", "x" * 300, "1234 5.6e7 --- ***",
             "<|endoftext|>", "tab\t\t end \r\n", "’s — €5", "ŉǅ ª²½"]
    for text in texts:
        assert fast.ids(text) == full.encode(text, add_special_tokens=False).ids, text


def test_curve_visits_every_cell_by_neighbours():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    key = hilbert(cells, bits=3)
    assert sorted(key.tolist()) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_are_alike(spark):
    rows = [(i, " ".join(f"{'uvw'[i % 3]}{(i * 7 + k) % 50}" for k in range(80)), "", "") for i in range(300)]
    pieces = pack(spark.createDataFrame(rows, SCHEMA), BPE).orderBy("sequence_id", "offset").collect()
    order = [p["doc_id"] % 3 for p in pieces if p["start"] == 0]
    assert sum(a != b for a, b in zip(order, order[1:])) < 30
