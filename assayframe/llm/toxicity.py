"""Toxicity scores: nearest labelled examples by exact cosine over all terms of the examples.

Examples are a bounded sample of labelled documents.  Terms are words (letters and digits,
lower case) and their first four and five bytes.  Every term of an example is in the
vocabulary; none is left out for being rare, frequent or weak.  Vectors are
(1 + log count) * idf * evidence, of length 1.  The evidence of a term that leans to label 1
is 1 + its likelihood ratio, of others 1, so common words do not decide who is near where
words speak for the label, and decide where none does.

The index is a block-max inverted index over all those terms: blocks of like examples are
bounded for each query and scored only where the bound reaches the k-th cosine, so the
neighbours are exact.  The vote of the neighbours, each weighing its cosine to a power and
shrunk towards the base rate, is turned into a probability by a logistic curve that is fitted
to the votes the examples get from each other, counted in tasks.

Weights of examples are in single precision.  Examples are bounded in number and in bytes of
text by parameters; their vectors, some bytes for each byte of text at most, are brought
to the driver and go to the tasks with the code.

Defined results: null text is empty; a text without terms of the vocabulary has no
neighbours and gets the score of the base rate among such examples; equal cosines are
ordered by doc_id; repeated rows are scored each; without labels of both classes every score
is their share, or one half without any.  Extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import labelled
from assayframe.llm.words import chunks, mix64, one_thread, span_hashes, texts_of, tidied, tidy, word_spans

EXAMPLES = 8192
NEIGHBOURS = 16
POWER = 2.0
SHRINK = 0.25
BLOCK = 32  # examples
BATCH = 256  # queries that meet the matrix in one product
COMMON_SHARE = 0.05  # terms of more examples than this are held as a matrix
PIVOTS = 48
SLACK = 1e-5  # more than single precision can lose in a cosine
EVIDENCE = 3
PREFIXES = (4, 5)


def _letters() -> np.ndarray:
    out = np.zeros(256, bool)
    out[128:] = True
    for a, b in (("0", "9"), ("A", "Z"), ("a", "z")):
        out[ord(a):ord(b) + 1] = True
    return out


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every occurrence of a term."""
    data, at = texts_of(column)
    first, last, row = word_spans(data, at, _letters())
    found, rows = [span_hashes(data, first, last)], [row]
    for n in PREFIXES:
        longer = np.flatnonzero(last - first > n)
        found.append(mix64(span_hashes(data, first[longer], first[longer] + n) + np.uint64(n)))
        rows.append(row[longer])
    return np.concatenate(found), np.concatenate(rows)


def all_terms(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The terms of all examples, their document frequencies and evidence, and the documents."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                found, row = terms(piece.column("text"))
                order = np.lexsort((found, row))
                found, row = found[order], row[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
                label = np.array(piece.column("label").to_pylist(), np.int32)
                yield pa.record_batch([pa.array(found[new].view(np.int64)), pa.array(label[row[new]])],
                                      names=["term", "label"])

    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    if not ones or not zeros:
        return np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), ones + zeros
    found = sample.select("text", "label").mapInArrow(tidied(distinct), "term long, label int").groupBy("term").agg(
        F.sum("label").alias("a"), F.count("*").alias("df"))
    a, b, df = F.col("a"), F.col("df") - F.col("a"), F.col("df")

    def part(seen, of, share):
        return F.when(seen > 0, seen * F.log(seen / (of * share))).otherwise(0.0)

    p = df / float(ones + zeros)
    ratio = part(a, ones, p) + part(ones - a, ones, 1 - p) + part(b, zeros, p) + part(zeros - b, zeros, 1 - p)
    leans = a / float(ones) > b / float(zeros)
    known = found.select("term", "df", F.when(leans, 1.0 + F.greatest(2.0 * ratio, F.lit(0.0))).otherwise(1.0).alias("g")).toPandas()
    term = known["term"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(term)
    return term[order], known["df"].to_numpy(np.float64)[order], known["g"].to_numpy(np.float64)[order], ones + zeros


class Vectors:
    """Weights of texts over a vocabulary."""

    def __init__(self, vocabulary: np.ndarray, df: np.ndarray, documents: int, evidence: np.ndarray | None = None):
        self.vocabulary = vocabulary
        self.idf = np.log((1.0 + documents) / (1.0 + df)) + 1.0
        if evidence is not None:
            self.idf = self.idf * evidence
        self.first = self.ended = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"first": None, "ended": None}  # made again where it is used

    def _prepare(self) -> None:
        """Where the terms of each leading bit pattern begin: hashes are even, so about one of each."""
        bits = len(self.vocabulary).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        heads = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.searchsorted(self.vocabulary, heads).astype(np.int32)
        self.ended = np.append(self.vocabulary, np.uint64(2**64 - 1))

    def numbers(self, found: np.ndarray) -> np.ndarray:
        """The place of each hash in the vocabulary, or of the next one above it."""
        if self.first is None:
            self._prepare()
        term = self.first.take((found >> self.shift).view(np.int64)).astype(np.int64)
        late = np.flatnonzero(self.ended.take(term) < found)
        while len(late):
            term[late] += 1
            late = late[self.ended.take(term[late]) < found[late]]
        return term

    def of(self, column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Term numbers and weights of every text."""
        size = max(1, len(self.vocabulary))
        found, row = terms(column)
        term = self.numbers(found)
        real = np.flatnonzero((self.ended.take(term) == found) & (term < len(self.vocabulary)))
        key, count = np.unique(row[real] * size + term[real], return_counts=True)
        row, term = key // size, key % size
        weight = (1.0 + np.log(count)) * self.idf[term] if len(key) else np.zeros(0)
        length = np.sqrt(np.bincount(row, weights=weight * weight, minlength=len(column)))
        weight = weight / length[row]
        bound = np.searchsorted(row, np.arange(len(column) + 1))
        return [(term[a:b], weight[a:b]) for a, b in zip(bound[:-1], bound[1:])]


def _stretches(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of stretches one after the other, and their sizes."""
    end = np.cumsum(size)
    at = np.arange(end[-1] if len(end) else 0)
    at += np.repeat(start - (end - size), size)
    return at, size


def _paired(number: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A number and a weight side by side, so that one look into memory finds both."""
    out = np.empty((len(number), 2), np.int32)
    out[:, 0] = number
    out[:, 1] = weight.astype(np.float32).view(np.int32)
    return out.view(np.int64).ravel()


def _parts(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = pairs.view(np.int32).reshape(-1, 2)
    return both[:, 0], both.view(np.float32)[:, 1]


class BlockMaxIndex:
    """Examples in blocks of near ones, and the most that a block can add to a cosine.

    Examples are ordered by label and by the closest of a few pivot examples, so a block holds
    like texts.  A rare term has a posting list cut at block borders, with its largest weight
    in each block.  The common terms are a matrix by example: one product with a batch of
    queries gives their whole part of every cosine, and its largest value in a block is as
    tight as a maximum can be.  Both together bound a block.  The blocks of the largest
    bounds are scored first; of the rest only those whose bound reaches the k-th cosine so
    far.  The cosines of the winners are added up once more in double precision, so results
    do not depend on which queries share a batch.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, labels: np.ndarray,
                 size: int, block: int = BLOCK):
        order = self._order(vectors, labels, ids, size)
        self.ids, self.labels, self.size, self.block = ids[order], labels[order], size, block
        self.start = np.append(0, np.cumsum([len(vectors[i][0]) for i in order])).astype(np.int64)
        self.term = np.concatenate([vectors[i][0] for i in order]).astype(np.int32) if len(order) else np.zeros(0, np.int32)
        self.weight = np.concatenate([vectors[i][1] for i in order]).astype(np.float32) if len(order) else np.zeros(0, np.float32)
        self.inverted = None
        self.scored_blocks = self.seen_blocks = 0

    @staticmethod
    def _order(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
        pivots = np.argsort(mix64(ids.astype(np.int64).view(np.uint64)), kind="stable")[:PIVOTS]
        dense = np.zeros((size, len(pivots)), np.float32)
        for column, i in enumerate(pivots.tolist()):
            dense[vectors[i][0], column] = vectors[i][1]
        near = np.zeros(len(ids), np.int64)
        close = np.zeros(len(ids))
        for i, (term, weight) in enumerate(vectors):
            if len(term):
                likeness = weight.astype(np.float32) @ dense[term]
                near[i] = int(likeness.argmax())
                close[i] = float(likeness[near[i]])
        return np.lexsort((ids, close, near, labels))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"inverted": None}  # made again where it is used

    def _prepare(self) -> None:
        if self.inverted is not None:
            return
        n = len(self.ids)
        self.blocks = -(-n // self.block)
        example = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.start))
        many = np.bincount(self.term, minlength=self.size) > COMMON_SHARE * n
        self.place = np.full(self.size, -1, np.int32)
        self.place[many] = np.arange(many.sum())
        common = many[self.term]
        self.matrix = np.zeros((self.blocks * self.block, int(many.sum())), np.float32)
        self.matrix[example[common], self.place[self.term[common]]] = self.weight[common]
        term, example, weight = self.term[~common], example[~common], self.weight[~common]
        by_term = np.argsort(term, kind="stable")
        term, example, weight = term[by_term], example[by_term], weight[by_term]
        self.postings = _paired(example, weight)
        block = example // self.block
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        first = np.flatnonzero(new)
        self.entry_start = np.append(first, len(term))
        self.entry_size = np.diff(self.entry_start)
        self.entries = _paired(block[first], np.maximum.reduceat(weight, first) if len(first) else np.zeros(0, np.float32))
        self.term_entry = np.searchsorted(term[first], np.arange(self.size + 1))
        self.term_entries = np.diff(self.term_entry)
        self.inverted = True

    def _rare(self, entries: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What the postings of some entries add to each example, in order of terms."""
        # ``take`` with places of the machine's own width: numpy copies others first
        at, size = _stretches(self.entry_start.take(entries), self.entry_size.take(entries))
        example, weight = _parts(self.postings.take(at))
        return np.bincount(example, np.repeat(weights, size) * weight, len(self.ids))

    def nearest_all(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int,
                    not_ids: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the k examples with the largest positive cosines, and those cosines."""
        self._prepare()
        one_thread()
        for low in range(0, len(queries), BATCH):
            part = queries[low:low + BATCH]
            own = np.zeros((len(part), self.matrix.shape[1]), np.float32)
            for i, (term, weight) in enumerate(part):
                place = self.place[term]
                own[i, place[place >= 0]] = weight[place >= 0]
            exact = own @ self.matrix.T
            most = exact.reshape(len(part), self.blocks, self.block).max(axis=2) if self.blocks else exact
            for i, (term, weight) in enumerate(part):
                yield self._nearest(term, weight, k, exact[i], most[i], None if not_ids is None else not_ids[low + i])

    def _nearest(self, term: np.ndarray, weight: np.ndarray, k: int, exact: np.ndarray, most: np.ndarray,
                 not_id) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        rare = np.flatnonzero(self.place[term] < 0)
        listed = term[rare].astype(np.int64)
        entries, size = _stretches(self.term_entry.take(listed), self.term_entries.take(listed))
        weights = np.repeat(weight[rare].astype(np.float32), size)
        block, most_of = _parts(self.entries.take(entries))
        block = block.astype(np.int64)
        bound = most + np.bincount(block, weights * most_of, self.blocks) + SLACK
        ahead = min(self.blocks, max(1, 4 * k // self.block))
        chosen = np.zeros(self.blocks, bool)
        chosen[np.argpartition(-bound, ahead - 1)[:ahead]] = True
        held, rest, kth = np.zeros(0, np.int64), np.zeros(0), 0.0
        while True:
            here = np.flatnonzero(chosen.take(block))
            inside = (np.flatnonzero(chosen)[:, None] * self.block + np.arange(self.block)).ravel()
            inside = inside[inside < n]
            if not_id is not None:
                inside = inside[self.ids[inside] != not_id]
            held, rest = np.append(held, inside), np.append(rest, self._rare(entries.take(here), weights.take(here))[inside])
            self.scored_blocks += int(chosen.sum())
            bound[chosen] = -1.0
            total = exact[held] + rest
            kth = max(0.0, float(np.partition(total, len(total) - k)[len(total) - k])) if k < len(total) else 0.0
            chosen = bound >= max(kth, SLACK)
            if not chosen.any():
                break
        self.seen_blocks += self.blocks
        good = total >= max(kth - SLACK, -SLACK)
        held = held[good]
        # once more in double precision, so that cosines do not depend on the batch
        own = np.zeros(self.matrix.shape[1])
        place = self.place[term]
        own[place[place >= 0]] = weight[place >= 0]
        score = np.round((self.matrix[held] * own).sum(axis=1) + rest[good], 12)
        # 1e-12: equal cosines may be rounded apart
        held, score = held[score > 1e-12], score[score > 1e-12]
        best = np.lexsort((self.ids[held], -score))[:k]
        return held[best], score[best]

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, not_id=None) -> tuple[np.ndarray, np.ndarray]:
        """The same for one query."""
        return next(self.nearest_all([(term, weight)], k, None if not_id is None else np.array([not_id])))


def vote(labels: np.ndarray, score: np.ndarray, base: float, power: float = POWER, shrink: float = SHRINK) -> float:
    """Share of label 1 among neighbours that weigh cosine^power, drawn towards the base rate."""
    weight = score ** power
    return float((weight @ labels + shrink * base) / (weight.sum() + shrink))


def fit_curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and intercept of the logistic curve from votes to labels, by Newton steps."""
    a, b = 1.0, 0.0
    x = votes * 2 - 1
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(a * x + b, -35, 35)))
        g, h = weights * (p - labels), weights * np.maximum(p * (1 - p), 1e-6)
        ga, gb = (g * x).sum() + 1e-2 * a, g.sum() + 1e-2 * b
        haa, hab, hbb = (h * x * x).sum() + 1e-2, (h * x).sum(), h.sum() + 1e-2
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 4.0 / max(abs(da), abs(db), 1e-9))
        a, b = a - step * da, b - step * db
    return max(a, 1e-3), b


class Model:
    """Everything a task needs to score texts."""

    def __init__(self, vectors: Vectors | None, index: BlockMaxIndex | None, base: float, k: int):
        self.vectors, self.index, self.base, self.k = vectors, index, base, k
        self.curve = (0.0, float(np.log((base + 1e-3) / (1 - base + 1e-3))))
        self.without = base

    def scores(self, column: pa.Array) -> list[tuple[float, list[dict]]]:
        if self.vectors is None:
            return [(self.base, [])] * len(column)
        listed = self.vectors.of(column)
        keys = [(term.tobytes(), weight.tobytes()) for term, weight in listed]
        asked = {key: query for key, query in zip(keys, listed) if len(query[0])}
        found = self.index.nearest_all(list(asked.values()), self.k)
        known = {key: self._score(who, score) for key, (who, score) in zip(asked, found)}
        return [known.get(key, (self.without, [])) for key in keys]

    def _score(self, who: np.ndarray, score: np.ndarray) -> tuple[float, list[dict]]:
        value = self.probability(vote(self.index.labels[who], score, self.base))
        return value, [{"doc_id": int(self.index.ids[i]), "similarity": float(s), "label": int(self.index.labels[i])}
                       for i, s in zip(who[:EVIDENCE], score)]

    def probability(self, share: float) -> float:
        x = self.curve[0] * (2 * share - 1) + self.curve[1]
        return float(1.0 / (1.0 + np.exp(-np.clip(x, -35, 35))))


def fit(sample: DataFrame, k: int = NEIGHBOURS) -> Model:
    """The model of a sample (doc_id, text, label, rate).

    Only the sample's terms and vectors reach the driver, some kilobytes a document.
    """
    chosen, df, evidence, documents = all_terms(sample)
    if not len(chosen):
        found = sample.agg(F.avg("label")).first()[0]
        return Model(None, None, 0.5 if found is None else float(found), k)
    vectors = Vectors(chosen, df, documents, evidence)

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                rows = vectors.of(piece.column("text"))
                yield pa.record_batch([
                    piece.column("doc_id").cast(pa.int64()), piece.column("label"), piece.column("rate"),
                    pa.array([t.astype(np.int32).tobytes() for t, _ in rows], pa.binary()),
                    pa.array([w.astype(np.float32).tobytes() for _, w in rows], pa.binary())],
                    names=["doc_id", "label", "rate", "term", "weight"])

    rows = sample.select("doc_id", "text", "label", "rate").mapInArrow(
        tidied(vector), "doc_id long, label int, rate double, term binary, weight binary") \
        .toPandas().sort_values("doc_id", kind="stable")
    ids, labels, rate = rows["doc_id"].to_numpy(), rows["label"].to_numpy(), rows["rate"].to_numpy()
    listed = [(np.frombuffer(t, np.int32), np.frombuffer(w, np.float32)) for t, w in zip(rows["term"], rows["weight"])]
    model = Model(vectors, BlockMaxIndex(listed, ids, labels, len(chosen)), float(np.average(labels, weights=1 / rate)), k)
    full = np.array([len(term) > 0 for term, _ in listed])
    votes = own_votes(sample, model).sort_values("doc_id", kind="stable")
    truth, weights = votes["label"].to_numpy(float), 1 / votes["rate"].to_numpy()
    bare = [model.base * 2 + (labels[~full] / rate[~full]).sum(), 2.0 + (1 / rate[~full]).sum()]
    del rows, listed
    tidy()
    model.without = bare[0] / bare[1]
    model.curve = fit_curve(votes["vote"].to_numpy(), truth, weights)
    return model


def own_votes(sample: DataFrame, model: Model) -> pd.DataFrame:
    """(doc_id, label, rate, vote): what the other examples say of each example with terms."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                asked = model.vectors.of(piece.column("text"))
                full = np.flatnonzero([len(term) > 0 for term, _ in asked])
                ids = np.array(piece.column("doc_id").to_pylist(), np.int64)[full]
                found = model.index.nearest_all([asked[i] for i in full.tolist()], model.k, ids)
                told = [vote(model.index.labels[who], score, model.base) for who, score in found]
                take = pa.array(full)
                yield pa.record_batch([pa.array(ids), piece.column("label").take(take), piece.column("rate").take(take),
                                       pa.array(told, pa.float64())], names=["doc_id", "label", "rate", "vote"])

    spread = sample.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "label", "rate").repartition(12, "doc_id")
    return spread.mapInArrow(tidied(task), "doc_id long, label int, rate double, vote double").toPandas()


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, evidence) of every row; no shuffle."""
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                found = model.scores(piece.column("text"))
                yield pa.record_batch([
                    piece.column("doc_id"), pa.array([s for s, _ in found], pa.float64()),
                    pa.array([e for _, e in found], evidence)], names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        tidied(task), "doc_id long, score double, evidence array<struct<doc_id:long,similarity:double,label:int>>")


def toxicity_scores(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, folds: int = 3) -> DataFrame:
    """(doc_id, score, evidence): how likely label 1 of ``toxic`` is, and the nearest examples.

    Learns from labels whose ids have a crc32 that is not 1 modulo ``folds``, from about
    ``examples`` of them at most.
    """
    sample = labelled.sample(docs, labels, "toxic", labelled.fold("doc_id", folds) != 1, examples, "toxic")
    return scored(docs, fit(sample))
