"""Context-triggered piecewise hashing of whole texts, and how alike two fingerprints are.

A rolling hash of seven bytes marks where chunks end: at block size 2^L where its low L bits
are zero, so the ends for 2^(L+1) are some of those for 2^L.  Every chunk gives one of 64
characters from a hash of its bytes.  A text takes the largest block size with at least 32
chunk ends (4 at least); the fingerprint is ``size:characters:characters at twice the
size``.  A change touches the chunks around it only, so edited texts keep most characters.

Signatures hold 128 and 64 characters at most; the last one stands for all that remains, so
every byte counts.  Likeness is 1 - edit distance / longer length over signatures of equal
block size, the best of those that the two fingerprints share (sizes equal, or one twice the
other), and 0 without a common run of four characters.

Defined results: null text is empty; the empty fingerprint is ``4::``; equal fingerprints
are alike by 1; equal texts have equal fingerprints.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm import ranges
from assayframe.llm.words import chunks, mix64, powers, texts_of, tidied, CHUNK_BYTES

WINDOW = 7
LEAST_LEVEL = 2
ENOUGH = 32
LENGTHS = (128, 64)
RUN = 4
PART_BYTES = 16 << 20
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _signature(total: np.ndarray, at: np.ndarray, ends: np.ndarray, row: np.ndarray, most: int) -> list[bytes]:
    """Characters of the chunks that end after the positions ``ends`` (sorted; row: theirs)."""
    rows = len(at) - 1
    rank = np.arange(len(ends)) - np.searchsorted(row, row)
    keep = (rank < most - 1) & (ends + 1 < at[row + 1])  # an end at the text's end is implied
    ends, row = ends[keep], row[keep]
    filled = np.flatnonzero(at[1:] > at[:-1])
    stop = np.concatenate([ends + 1, at[1:][filled]])
    owner = np.concatenate([row, filled])
    order = np.argsort(stop, kind="stable")
    stop, owner = stop[order], owner[order]
    start = np.empty_like(stop)
    start[1:] = stop[:-1]
    first = np.ones(len(stop), bool)
    first[1:] = owner[1:] != owner[:-1]
    start[first] = at[owner[first]]
    _, q = powers(int(at[-1]))
    value = mix64((total[stop] - total[start]) * q[start] + (stop - start).astype(np.uint64))
    text = ALPHABET[(value >> np.uint64(58)).astype(np.intp)].tobytes()
    bound = np.searchsorted(owner, np.arange(rows + 1)).tolist()
    return [text[a:b] for a, b in zip(bound, bound[1:])]


def _chunk_fingerprints(data: np.ndarray, at: np.ndarray) -> list[str]:
    rows, n = len(at) - 1, len(data)
    p, q = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
    ends = np.zeros(0, np.int64)
    level = np.zeros(0, np.int64)
    if n >= WINDOW:
        rolled = (total[WINDOW:] - total[:-WINDOW]) * q[:n - WINDOW + 1]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0x9FB21C651E98DF25)
        rolled >>= np.uint64(34)  # 30 bits
        ends = np.flatnonzero((rolled & np.uint64((1 << LEAST_LEVEL) - 1)) == 0)
        bits = rolled[ends].astype(np.int64) | 1 << 30
        level = np.frexp((bits & -bits).astype(np.float64))[1].astype(np.int64) - 1
        ends = ends + WINDOW - 1
    row = np.searchsorted(at, ends, "right") - 1
    whole = ends - (WINDOW - 1) >= at[row]
    ends, level, row = ends[whole], level[whole], row[whole]
    width = 32
    held = np.bincount(row * width + level, minlength=rows * width).reshape(rows, width)
    reach = held[:, ::-1].cumsum(axis=1)[:, ::-1]  # chunk ends at each level or above
    chosen = np.maximum((reach >= ENOUGH).sum(axis=1) - 1, LEAST_LEVEL)
    out = []
    for step, most in enumerate(LENGTHS):
        marked = level >= chosen[row] + step
        out.append(_signature(total, at, ends[marked], row[marked], most))
    return [f"{1 << c}:{a.decode()}:{b.decode()}" for c, a, b in zip(chosen.tolist(), *out)]


def fingerprints(texts: list[bytes]) -> list[str]:
    """The fingerprint of each text, worked out for some megabytes of texts at a time."""
    out: list[str] = []
    first, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text)
        if held >= CHUNK_BYTES or i + 1 == len(texts):
            data, at = texts_of(pa.array(texts[first:i + 1], pa.large_binary()))
            out += _chunk_fingerprints(data, at)
            first, held = i + 1, 0
    return out


def _padded(texts: list[bytes], width: int, fill: int) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(t) for t in texts])
    out = np.frombuffer(b"".join(t.ljust(width, bytes([fill])) for t in texts), np.uint8)
    return out.reshape(len(texts), width), length


def _share_run(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether two signatures have a run of RUN characters in common; shorter ones must agree."""
    def runs(x: np.ndarray, n: np.ndarray, side: int) -> np.ndarray:
        wide = x.shape[1] - RUN + 1
        value = np.zeros((len(x), max(wide, 0)), np.int64)
        for k in range(RUN):
            value = value << 8 | x[:, k:k + wide]
        real = np.arange(wide) <= (n - RUN)[:, None]
        return np.where(real, value << 1 | side, -1 - side - 2 * np.arange(wide))

    if a.shape[1] < RUN:
        return np.zeros(len(a), bool)
    both = np.sort(np.concatenate([runs(a, la, 0), runs(b, lb, 1)], axis=1), axis=1)
    return ((both[:, 1:] >> 1 == both[:, :-1] >> 1) & (both[:, 1:] != both[:, :-1]) & (both[:, :-1] >= 0)).any(axis=1)


def edit_distances(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Levenshtein distance of each pair of rows, all pairs at once."""
    place = np.arange(b.shape[1] + 1, dtype=np.int16)
    line = np.broadcast_to(place, (len(a), len(place))).copy()
    out = np.where(la == 0, lb, 0)
    each = np.arange(len(a))
    for i in range(a.shape[1]):
        step = np.empty_like(line)
        step[:, 0] = i + 1
        np.minimum(line[:, 1:] + 1, line[:, :-1] + (b != a[:, i:i + 1]), out=step[:, 1:])
        step -= place  # the cheapest insertion run is a running minimum
        np.minimum.accumulate(step, axis=1, out=step)
        step += place
        line = step
        done = la == i + 1
        if done.any():
            out[done] = line[each[done], lb[done]]
    return out


def _alike(pairs: list[tuple[bytes, bytes]], block: int = 1024) -> np.ndarray:
    out = np.zeros(len(pairs))
    order = sorted(range(len(pairs)), key=lambda i: max(map(len, pairs[i])))
    for k in range(0, len(order), block):
        at = np.array(order[k:k + block])
        width = max(RUN, max(max(map(len, pairs[i])) for i in at))
        a, la = _padded([pairs[i][0] for i in at], width, 1)
        b, lb = _padded([pairs[i][1] for i in at], width, 2)
        some = np.flatnonzero(_share_run(a, la, b, lb))
        if len(some):
            far = edit_distances(a[some], la[some], b[some], lb[some])
            out[at[some]] = 1.0 - far / np.maximum(la[some], lb[some])
    return out


def likeness(one: list[str], two: list[str]) -> np.ndarray:
    """How alike the fingerprints of each pair are, from 0 to 1."""
    out = np.zeros(len(one))
    pairs: list[tuple[bytes, bytes]] = []
    owner: list[int] = []
    for i, (x, y) in enumerate(zip(one, two)):
        if x == y:
            out[i] = 1.0
            continue
        (nx, x1, x2), (ny, y1, y2) = x.encode().split(b":"), y.encode().split(b":")
        nx, ny = int(nx), int(ny)
        use = [(x1, y1), (x2, y2)] if nx == ny else [(x1, y2)] if nx == 2 * ny else [(x2, y1)] if ny == 2 * nx else []
        pairs += use
        owner += [i] * len(use)
    if pairs:
        np.maximum.at(out, owner, _alike(pairs))
    return out


def edited(text: str, following: str) -> str:
    """The text with its last third (rounded down) replaced by as much of the other's start."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint (doc_id, n_chars, fingerprint); no shuffle."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            yield pa.record_batch([
                batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array(fingerprints([t.encode() for t in texts]), pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(tidied(task), "doc_id long, n_chars long, fingerprint string")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
       "near_edited double, near_next double"


def with_neighbours(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """Fingerprints of each text, of its edited form, and how alike it is to that and to the next.

    The next document is the one with the next smaller doc_id (null: after all others;
    equal ids: in order of text), and after the last the first.  Texts are shuffled once
    into ranges of ids; the first document of a range also goes to the range before it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    limits = ranges.id_cuts(rows, "doc_id", F.octet_length("text"), part_bytes)
    part = ranges.range_of(limits)
    low = F.lit(-(1 << 63))
    tops = rows.select(part("doc_id").alias("part"), F.coalesce("doc_id", low).alias("i")) \
        .groupBy("part").agg(F.max("i").alias("top")).collect()
    tops = sorted(((r["part"], r["top"]) for r in tops), reverse=True)
    # The top of each range is wanted by the range above it, that of the highest by the lowest.
    wanted = {tops[i][1]: tops[i - 1][0] for i in range(len(tops))}
    keys = np.array(sorted(wanted), np.int64)
    places = np.array([wanted[int(k)] for k in keys], np.int32)

    @F.pandas_udf("int")
    def extra(ids: pd.Series) -> pd.Series:
        at = np.minimum(np.searchsorted(keys, ids.to_numpy()), len(keys) - 1)
        return pd.Series(np.where(keys[at] == ids.to_numpy(), places[at], -1).astype(np.int32))

    both = rows.select("doc_id", "text", part("doc_id").alias("part"), extra(F.coalesce("doc_id", low)).alias("to"))
    both = both.select("doc_id", "text", F.explode(F.when(F.col("to") < 0, F.array(
        F.struct(F.col("part").alias("part"), F.lit(0).alias("kind")))).otherwise(F.array(
            F.struct(F.col("part").alias("part"), F.lit(0).alias("kind")),
            F.struct(F.col("to").alias("part"), F.lit(1).alias("kind"))))).alias("go"))
    both = both.select("doc_id", "text", "go.part", "go.kind").repartitionById(len(limits) + 1, "part") \
        .sortWithinPartitions("kind", F.col("doc_id").desc_nulls_last(), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row is done once the row after it is known.
        ids, texts, closed = [], [], False
        for batch in batches:
            for piece in chunks(batch, "text", 4 * CHUNK_BYTES):
                for doc_id, text, kind in zip(*(piece.column(c).to_pylist() for c in ("doc_id", "text", "kind"))):
                    if not closed:
                        ids.append(doc_id)
                        texts.append(text)
                        closed = kind == 1
                if len(ids) > 1:
                    yield _compared(ids[:-1], texts)
                    ids, texts = ids[-1:], texts[-1:]

    return both.select("doc_id", "text", "kind").mapInArrow(tidied(task), _OUT)


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """Results for all texts but the last, each next to the one after it."""
    raw = [t.encode() for t in texts]
    changed = [edited(a, b).encode() for a, b in zip(texts, texts[1:])]
    own, other = fingerprints(raw), fingerprints(changed)
    return pa.record_batch([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed]), pa.array(own[:-1]), pa.array(other),
        pa.array(likeness(own[:-1], other)), pa.array(likeness(own[:-1], own[1:]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
