"""Pack documents into training sequences along a space-filling curve.

Each document's words are hashed to a vector, which is projected to a few dimensions; the
cell of the projection gives a place on a Hilbert curve, so documents that stand next to
each other use similar words.  Ranges of the curve, cut by a sample, are the tasks; a task
sorts its documents along the curve, tokenizes them, ends each with one separator id, and
cuts the stream of ids into sequences.  What is left of a stream is cut into sequences
whose lengths are powers of two, which need no padding.

Defined results: null and empty texts are the separator alone; equal texts stand together,
ordered by a hash of their id; repeated rows are packed each; an empty table gives no
pieces; extra columns are ignored.
"""
from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import ranges
from assayframe.llm.words import chunks, tidied, word_hashes

LENGTH = 1024
SEPARATOR = 0
FEATURES = 1024
DIMENSIONS = 6
BITS = 10
PART_BYTES = 16 << 20
SEED = 11
# Characters on which the two tokenizer libraries are known to split words alike.
_PLAIN = re.compile("[^\t\n\r -~ -ɏ‐-‧€]|<\\|")


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((FEATURES, DIMENSIONS)).astype(np.float32)


def projected(column: pa.Array) -> np.ndarray:
    """Each text's hashed word vector (square roots of counts, length 1), projected."""
    words, row = word_hashes(column)
    rows = len(column)
    at = row * FEATURES + (words % np.uint64(FEATURES)).astype(np.int64)
    vectors = np.sqrt(np.bincount(at, minlength=rows * FEATURES).reshape(rows, FEATURES).astype(np.float32))
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return (vectors @ _projection()) / np.maximum(length, 1e-9)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2^bits.

    From the highest bit down: a dimension without that bit swaps the low bits of the first
    dimension with its own, one with it inverts them; then the bits are Gray coded.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    n = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(n):
            on = (x[d] >> b & 1).astype(bool)
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(on, low, 0) ^ swap
            x[d] ^= swap
    for d in range(1, n):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> b & 1, (1 << b) - 1, 0)
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(n):
            key = key << 1 | ((x[d] ^ flip) >> b & 1)
    return key


def cells_of(points: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Cell numbers: the normal scores of each dimension, spread evenly over the cells."""
    z = np.clip((points - mean) / spread, -12, 12)
    return np.minimum((1 << BITS) * (1.0 / (1.0 + np.exp(-1.702 * z))), (1 << BITS) - 1).astype(np.int64)


def curve(docs: DataFrame, part_bytes: int = PART_BYTES,
          sample_rows: int = ranges.SAMPLE_ROWS) -> tuple[DataFrame, int]:
    """(doc_id, text, key, tie, part) of each document, and the number of parts.

    A sample of about ``sample_rows`` documents, chosen by hashed id, gives the scale of the
    dimensions and the cuts of the curve; what it costs the driver does not grow.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64(F.lit(SEED), "doc_id").alias("tie"))
    names = [f"y{d}" for d in range(DIMENSIONS)]

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                y = projected(piece.column("text")).astype(np.float64)
                yield pa.record_batch([piece.column("tie"), piece.column("bytes"), *[pa.array(c) for c in y.T]],
                                      names=["tie", "bytes", *names])

    total = rows.count()
    sample = rows.where(ranges.in_sample(total, sample_rows, "doc_id")).select(
        "text", "tie", F.octet_length("text").cast("double").alias("bytes")).mapInArrow(
        tidied(points), "tie long, bytes double, " + ", ".join(f"{n} double" for n in names)).toPandas()
    y = sample[names].to_numpy()
    mean = y.mean(axis=0) if len(y) else np.zeros(DIMENSIONS)
    spread = np.maximum(y.std(axis=0), 1e-6) if len(y) else np.ones(DIMENSIONS)
    key = hilbert(cells_of(y, mean, spread)) if len(y) else np.zeros(0, np.int64)
    order = np.lexsort((sample["tie"].to_numpy(), key))
    weight = sample["bytes"].to_numpy()[order] + 16
    parts = max(1, int(-(-weight.sum() / min(1.0, sample_rows / max(total, 1)) // part_bytes)))
    at = ranges.cuts(key[order], weight, parts)
    limits = np.zeros(len(at), [("key", np.int64), ("tie", np.int64)])
    limits["key"], limits["tie"] = key[order][at], sample["tie"].to_numpy()[order][at]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                own = np.zeros(piece.num_rows, limits.dtype)
                own["key"] = hilbert(cells_of(projected(piece.column("text")).astype(np.float64), mean, spread))
                own["tie"] = piece.column("tie").to_numpy()
                part = np.searchsorted(limits, own, "right").astype(np.int32)
                yield pa.record_batch([piece.column("doc_id"), piece.column("text"), pa.array(own["key"]),
                                       piece.column("tie"), pa.array(part)],
                                      names=["doc_id", "text", "key", "tie", "part"])

    placed = rows.mapInArrow(tidied(place), "doc_id long, text string, key long, tie long, part int")
    return placed, len(limits) + 1


class Tokens:
    """Ids of texts under a vocabulary file; made once per task.

    ``vocabulary`` is a file of the tokenizers library.  With ``ranks``, the same vocabulary
    as a rank file, plain texts take a faster path with equal ids; texts with other
    characters, or with what could be a special token, are left to the file itself.
    """

    def __init__(self, vocabulary: str, ranks: str | None = None, pattern: str | None = None):
        self.vocabulary, self.full, self.fast = vocabulary, None, None
        if ranks and pattern:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and not _PLAIN.search(text):
            return self.fast.encode_ordinary(text)
        if self.full is None:  # some tens of megabytes that few tasks need
            from tokenizers import Tokenizer

            self.full = Tokenizer.from_file(self.vocabulary)
        return self.full.encode(text, add_special_tokens=False).ids


_PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class _Stream:
    """Cuts documents that arrive one after the other into the sequences of one part."""

    def __init__(self, part: int, length: int):
        self.base, self.length, self.made = part << 32, length, 0
        self.ids = np.zeros(0, np.uint32)
        self.docs = np.zeros((0, 4), np.int64)  # doc number, start, length, tokens
        self.names: list = []

    def add(self, names: list, ids: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        """Pieces of all sequences that are now full; the rest waits."""
        fresh = np.stack([np.arange(len(sizes)) + len(self.names), np.zeros_like(sizes), sizes, sizes], axis=1)
        self.names = self.names + names
        self.ids, self.docs = np.concatenate([self.ids, ids]), np.concatenate([self.docs, fresh])
        full = len(self.ids) // self.length
        return self._cut(np.arange(1, full + 1) * self.length)

    def rest(self) -> pa.RecordBatch:
        """Pieces of what waits, in sequences whose lengths are powers of two."""
        n = len(self.ids)
        powers = [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]
        return self._cut(np.cumsum(np.array(powers, np.int64)))

    def _cut(self, ends: np.ndarray) -> pa.RecordBatch:
        done = int(ends[-1]) if len(ends) else 0
        stop = np.cumsum(self.docs[:, 2])
        bounds = np.union1d(stop[stop < done], ends)
        begin = np.concatenate([[0], bounds[:-1]]) if len(bounds) else bounds
        doc = np.searchsorted(stop, begin, "right")
        seq = np.searchsorted(ends, begin, "right")
        first = np.concatenate([[0], ends])[seq]
        start = self.docs[doc, 1] + begin - (stop - self.docs[:, 2])[doc]
        raw = self.ids.tobytes()
        out = pa.record_batch([
            pa.array([self.names[i] for i in self.docs[doc, 0]], pa.int64()), pa.array(start),
            pa.array(bounds - begin), pa.array([raw[4 * a:4 * b] for a, b in zip(begin, bounds)], pa.binary()),
            pa.array(self.docs[doc, 3]), pa.array(self.base + self.made + seq), pa.array(begin - first)],
            names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
        left = np.searchsorted(stop, done, "right")
        rest = self.docs[left:].copy()
        if len(rest):
            cut = done - (stop[left] - rest[0, 2])
            rest[0, 1] += cut
            rest[0, 2] -= cut
        self.names = [self.names[i] for i in rest[:, 0]]
        rest[:, 0] = np.arange(len(rest))
        self.docs, self.ids = rest, self.ids[done:]
        self.made += len(ends)
        return out


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, pattern: str | None = None,
         length: int = LENGTH, separator: int = SEPARATOR, part_bytes: int = PART_BYTES) -> DataFrame:
    """Pieces of documents with their ids (32-bit little endian) and their place in a sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids, doc_tokens,
    sequence_id, offset.  Texts are shuffled once, into ranges of the curve; ids exist only
    in the packing task, a few megabytes of text at a time.
    """
    placed, parts = curve(docs, part_bytes)
    sorted_ = placed.repartitionById(parts, "part").sortWithinPartitions("key", "tie", "doc_id", "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, stream = None, None
        for batch in batches:
            for piece in chunks(batch, "text"):
                if stream is None:
                    tokens = Tokens(vocabulary, ranks, pattern)
                    stream = _Stream(piece.column("part")[0].as_py(), length)
                ids: list[int] = []
                sizes = []
                for text in piece.column("text").to_pylist():
                    own = tokens.ids(text)
                    ids += own
                    ids.append(separator)
                    sizes.append(len(own) + 1)
                yield stream.add(piece.column("doc_id").to_pylist(), np.array(ids, np.uint32),
                                 np.array(sizes, np.int64))
        if stream is not None:
            yield stream.rest()

    return sorted_.select("doc_id", "text", "part").mapInArrow(tidied(task), _PIECES)
