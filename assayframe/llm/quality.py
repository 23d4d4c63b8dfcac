"""Quality scores: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features are hashed to 2^18 places: words, pairs of words, shapes of words (runs of upper
case, lower case, digits and each kind of mark, as in ``Aa.``), pairs of shapes, and whether
a word repeats the one before it.  A feature's value is its share of the text's words times
a constant, so a score is one sparse dot product and whole texts of any length are scored.

Training runs on a bounded sample of labelled documents.  It is dealt to a fixed number of
shards; in each round every shard updates the common weights with follow-the-regularised-
leader steps over its documents, and the results are averaged block by block in tasks
(iterative parameter mixing).  The driver sees the averages alone, whatever the corpus holds.

Defined results: null text is empty; a text without words scores by the intercept alone;
repeated rows are scored each; without labels of both classes every score is their share,
or one half without any.  Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import labelled
from assayframe.llm.words import chunks, mix64, span_hashes, texts_of, tidied, word_spans

BITS = 18
TRAIN_ROWS = 16_384
SHARDS = 8
BLOCKS = 8
ROUNDS = 3
SCALE = 12.0
ALPHA, BETA, L1, L2 = 0.3, 1.0, 1e-4, 1e-3


def _shape_classes() -> np.ndarray:
    kind = np.arange(256, dtype=np.uint8)
    kind[ord("A"):ord("Z") + 1] = ord("A")
    kind[ord("a"):ord("z") + 1] = ord("a")
    kind[ord("0"):ord("9") + 1] = ord("0")
    kind[128:] = ord("a")
    return kind


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, row and the words of each row: one entry for every occurrence of a feature."""
    data, at = texts_of(column)
    first, last, row = word_spans(data, at)
    word = span_hashes(data, first, last)
    kind = _shape_classes()[data]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[first] = True
    place = np.concatenate([[0], np.cumsum(new)])
    shape = span_hashes(kind[new], place[first], place[last], lower=False)
    after = np.zeros(len(word), bool)
    after[1:] = row[1:] == row[:-1]
    pair = np.flatnonzero(after)
    rows = [row, row[pair], row, row[pair], row[pair]]
    found = [
        word, mix64(word[pair] + np.uint64(3) * word[pair - 1]), mix64(shape + np.uint64(1)),
        mix64(shape[pair] + np.uint64(5) * shape[pair - 1]),
        mix64((word[pair] == word[pair - 1]).astype(np.uint64) + np.uint64(77)),
    ]
    places = (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)
    return places, np.concatenate(rows), np.bincount(row, minlength=len(column))


def dots(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Weights times features of every text."""
    place, row, words = features(column)
    total = np.bincount(row, weights=weights[place], minlength=len(column))
    return SCALE * total / np.maximum(words, 1)


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int, float]], z: np.ndarray, n: np.ndarray) -> None:
    """One pass of updates, in place; the last entry of z and n is the intercept.

    A row has the places of its features, their values, its label and its weight.
    """
    for place, value, label, weight in rows:
        zi, ni = z[place], n[place]
        w = weights_of(zi, ni)
        p = 1.0 / (1.0 + np.exp(-np.clip(w @ value, -35, 35)))
        g = weight * (p - label) * value
        gg = g * g
        z[place] = zi + g - (np.sqrt(ni + gg) - np.sqrt(ni)) / ALPHA * w
        n[place] = ni + gg


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The leader: weights that the sums of gradients and their squares call for."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(sample: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of all places, and the intercept at the end, from (doc_id, text, label, rate)."""
    size = (1 << BITS) + 1
    counts = {r["label"]: (r["n"], r["m"]) for r in sample.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(1.0 / F.col("rate")).alias("m")).collect()}
    if len(counts) < 2:
        share = float(next(iter(counts), 0.5))
        out = np.zeros(size)
        out[-1] = np.log((share + 1e-3) / (1 - share + 1e-3))
        return out
    dealt = sample.repartitionById(shards, F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")) \
        .sortWithinPartitions(F.xxhash64("doc_id", F.lit(1)), "text")
    z, n = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for _ in range(rounds):
        def one_shard(batches: Iterator[pa.RecordBatch], z=z, n=n) -> Iterator[pa.RecordBatch]:
            z, n, seen = z.astype(np.float64), n.astype(np.float64), 0
            for batch in batches:
                for piece in chunks(batch, "text"):
                    rows = _rows(piece, size)
                    ftrl(rows, z, n)
                    seen += len(rows)
            if seen:
                yield pa.record_batch([
                    pa.array(range(BLOCKS), pa.int32()),
                    *[pa.array([part.tobytes() for part in np.array_split(x.astype(np.float32), BLOCKS)])
                      for x in (z, n)], pa.array([seen] * BLOCKS)], names=["block", "z", "n", "seen"])

        made = dealt.mapInArrow(tidied(one_shard), "block int, z binary, n binary, seen long") \
            .groupBy("block").applyInArrow(_averaged, "block int, z binary, n binary").collect()
        made.sort(key=lambda r: r["block"])
        z, n = (np.concatenate([np.frombuffer(r[c], np.float32) for r in made]) for c in ("z", "n"))
    return weights_of(z.astype(np.float64), n.astype(np.float64))


def _averaged(shards: pa.Table) -> pa.Table:
    """One block of the common weights: the shards' mean by rows seen, added in an order of content."""
    rows = sorted(zip(*(shards.column(c).to_pylist() for c in ("z", "n", "seen"))))
    total = sum(seen for *_, seen in rows)
    mean = [sum(np.frombuffer(r[i], np.float32).astype(np.float64) * (r[2] / total) for r in rows) for i in (0, 1)]
    return pa.table({"block": shards.column("block").slice(0, 1),
                     **{c: pa.array([x.astype(np.float32).tobytes()]) for c, x in zip("zn", mean)}})


def _rows(piece: pa.RecordBatch, size: int) -> list[tuple[np.ndarray, np.ndarray, int, float]]:
    place, row, words = features(piece.column("text"))
    key = row * size + place
    key, count = np.unique(key, return_counts=True)
    row, place = key // size, key % size
    bound = np.searchsorted(row, np.arange(piece.num_rows + 1))
    labels = piece.column("label").to_pylist()
    out = []
    for i, label in enumerate(labels):
        a, b = bound[i], bound[i + 1]
        out.append((np.append(place[a:b], size - 1), np.append(SCALE * count[a:b] / max(words[i], 1), 1.0), label, 1.0))
    return out


def scored(docs: DataFrame, weights: np.ndarray, shift: float = 0.0, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name`` (replacing one of that name), by one pass without a shuffle.

    Texts go through the task one slice of some megabytes at a time; the other columns are
    carried along unchanged.
    """
    docs = docs.drop(name)
    names = docs.columns
    light = weights.astype(np.float32)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                value = logistic(dots(piece.column("text"), light[:-1]) + float(light[-1]) + shift)
                yield pa.record_batch([*piece.columns, pa.array(value)], names=[*names, name])

    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(tidied(task), kinds + f", `{name}` double")


def prior_shift(sample: DataFrame) -> float:
    """What to add to log odds so that classes sampled at different rates count in full."""
    rates = {r["label"]: r["r"] for r in sample.groupBy("label").agg(F.max("rate").alias("r")).collect()}
    return float(np.log(rates.get(0, 1.0) / rates.get(1, 1.0)))


def quality_scores(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, folds: int = 5,
                   name: str = "score") -> DataFrame:
    """``docs`` with the score in column ``name``: how likely label 1 of ``quality`` is.

    Learns from labels whose ids have a crc32 that is no multiple of ``folds``, from about
    ``train_rows`` of them at most.
    """
    sample = labelled.sample(docs, labels, "quality", labelled.fold("doc_id", folds) != 0, train_rows, "quality")
    return scored(docs, train(sample), prior_shift(sample), name)
