"""Removing word windows that occur more than once, by super-k-mer partitioning.

A word is a longest run of bytes that are none of space and 0x09-0x0D, compared unchanged.
A window is ``window`` consecutive words of one text.  A word goes if a window that covers
it also starts anywhere else, in the same or in another text.

The minimiser of a window is its run of ``run`` words with the smallest hash, the leftmost
among equals.  Consecutive windows that share a minimiser (a super-k-mer) travel as one
packed string, the words with one space between them, to the bucket of that minimiser; so
a word is sent about three times instead of ``window`` times.  Equal windows have equal
minimisers and meet in one bucket.  A bucket makes its strings distinct, sorts its windows
by a 64-bit hash, confirms equal neighbours byte by byte and adds up their counts.  What it returns is one row
per distinct string that holds a repeated window: a 128-bit hash and a mask of its windows.
Texts work out their strings again and join those rows.

Runs of words that many texts share would make large buckets of small minimisers.  Runs
that occur often in a sample of about ``SAMPLE_DOCS`` texts are minimisers only of windows
that have no other run.  The sample changes the balance, never the result.  A string that
repeats within a piece of a task is sent once with its count, and once per task after that.
Texts that are equal (a 128-bit hash stands for them) are answered once; the join of texts
and answers is left to adaptive execution, which splits a text that a third of rows share.

Defined results: null text has no words; a text shorter than a window loses nothing; rows
that repeat, with or without equal ids, are different places; ids may be null or repeat
and come back as they are.  Other columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.ranges import in_sample
from assayframe.llm.words import chunks, mix64, span_hashes, texts_of, tidied, word_spans

WINDOW = 35
RUN = 4
BUCKET_BYTES = 32 << 20
LANES = 16  # parts of a bucket that are sorted one after the other
PIECE_BYTES = 1 << 20
PARCEL_BYTES = 16 << 20  # strings that a task holds before it sends them
SAMPLE_DOCS = 4096
FREQUENT = 8  # texts of the sample that make a run a frequent one
MOST_FREQUENT = 1 << 16
SETTLED = 1 << 20
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_TOP = np.uint64(1 << 63)


def packed_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words one after the other with one space after each: bytes, starts, ends, rows."""
    data, at = texts_of(column)
    first, last, row = word_spans(data, at)
    size = last - first
    end = np.cumsum(size + 1) - 1 if len(size) else np.zeros(0, np.int64)
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, np.uint8)
    place = np.repeat(start, size) + _steps(size)
    out[place] = data[np.repeat(first, size) + _steps(size)]
    return out, start, end, row


def _steps(size: np.ndarray) -> np.ndarray:
    """0 to n - 1 for each n of ``size``, one after the other."""
    total = int(size.sum())
    return np.arange(total) - np.repeat(np.cumsum(size) - size, size)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class Sequences:
    """Hashes of any runs of the given words, by prefix sums."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.parts = []
        for salt, base in enumerate(_BASES):
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(mix64(words + np.uint64(salt)) * _powers(base, n)[:n], out=total[1:])
            self.parts.append((total, _powers(pow(base, -1, 1 << 64), n)))

    def of(self, first: np.ndarray, last: np.ndarray, which: int) -> np.ndarray:
        total, back = self.parts[which]
        return mix64((total[last] - total[first]) * back[first] + (last - first).astype(np.uint64))


def run_hashes(words: np.ndarray, run: int) -> np.ndarray:
    """A hash of the ``run`` words from each word on; the last ones are cut short."""
    total = np.zeros(len(words), np.uint64)
    for k in range(min(run, len(words))):
        total[:len(words) - k] += mix64(words[k:] + np.uint64(k + 1)) * np.uint64(_BASES[k % 2])
    return mix64(total)


def least_places(order: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest of ``width`` values from each place on, leftmost among equals."""
    value, place = order, np.arange(len(order))
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(value) <= step:
            return np.zeros(0, np.int64)
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, value[step:], value[:-step])
        have += step
    return place


class Strings:
    """The super-k-mers of a column of texts."""

    def __init__(self, column: pa.Array, window: int, run: int, frequent: np.ndarray):
        self.data, self.start, self.end, self.row = packed_words(column)
        n = len(self.start)
        words = span_hashes(self.data, self.start, self.end, lower=False)
        grams = run_hashes(words, run)
        order = grams >> np.uint64(1)
        if len(frequent):
            at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
            order |= np.where(frequent[at] == grams, _TOP, np.uint64(0))
        last = np.arange(n - window + 1) if n >= window else np.zeros(0, np.int64)
        whole = last[self.row[last] == self.row[last + window - 1]]
        least = least_places(order, window - run + 1)[whole]
        new = np.ones(len(whole), bool)
        new[1:] = (least[1:] != least[:-1]) | (self.row[whole[1:]] != self.row[whole[:-1]])
        at = np.flatnonzero(new)
        self.first = whole[at]                       # first word of each string
        self.windows = np.diff(np.append(at, len(whole)))
        self.last = self.first + self.windows + window - 1  # behind its last word
        self.minimiser = grams[least[at]]
        sequences = Sequences(words)
        self.h1, self.h2 = sequences.of(self.first, self.last, 0), sequences.of(self.first, self.last, 1)
        begins = np.searchsorted(self.row, np.arange(len(column) + 1))
        self.place = self.first - begins[self.row[self.first]] if n else self.first


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty(len(a), [("a", np.uint64), ("b", np.uint64)])
    out["a"], out["b"] = a, b
    return out


def frequent_runs(docs: DataFrame, run: int, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Hashes of at most ``MOST_FREQUENT`` runs that at least ``FREQUENT`` sampled texts share."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text", PIECE_BYTES):
                data, start, end, row = packed_words(piece.column("text"))
                grams = run_hashes(span_hashes(data, start, end, lower=False), run)
                full = np.zeros(len(row), bool)
                if len(row) >= run:
                    full[:len(row) - run + 1] = row[run - 1:] == row[:len(row) - run + 1]
                found = np.unique(_pairs(grams[full], row[full].astype(np.uint64)))["a"]
                value, count = np.unique(found, return_counts=True)
                yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(count)], names=["g", "n"])

    chosen = docs.where(in_sample(docs.count(), sample_docs, "doc_id", "text")).select("text")
    found = chosen.mapInArrow(tidied(task), "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "g").limit(MOST_FREQUENT).select("g").toPandas()
    return np.sort(rows["g"].to_numpy().astype(np.int64).view(np.uint64))


class Parcel:
    """Strings on their way to one bucket, by lane: the lane is worked on alone there."""

    def __init__(self):
        self.lane, self.size, self.many, self.text = [], [], [], []

    def add(self, lane: np.ndarray, size: np.ndarray, many: np.ndarray, text: bytes) -> None:
        for kept, new in zip((self.lane, self.size, self.many, self.text), (lane, size, many, text)):
            kept.append(new)

    def packed(self) -> bytes:
        """The number of strings, their lanes, sizes and marks, and their bytes, compressed."""
        lane, size, many = map(np.concatenate, (self.lane, self.size, self.many))
        raw = b"".join([np.int64(len(size)).tobytes(), size.astype(np.int32).tobytes(),
                        lane.astype(np.uint8).tobytes(), many.astype(np.uint8).tobytes(), *self.text])
        return np.int64(len(raw)).tobytes() + pa.Codec("zstd", 3).compress(raw, asbytes=True)


def unpacked(parcel: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lanes, sizes, marks and bytes of a parcel."""
    raw = pa.Codec("zstd").decompress(parcel[8:], int(np.frombuffer(parcel[:8], np.int64)[0]), asbytes=True)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    return (np.frombuffer(raw, np.uint8, n, 8 + 4 * n), np.frombuffer(raw, np.int32, n, 8),
            np.frombuffer(raw, np.uint8, n, 8 + 5 * n), np.frombuffer(raw, np.uint8, -1, 8 + 6 * n))


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given stretches of bytes, one after the other."""
    return data[np.repeat(start, size) + _steps(size)]


def sent_strings(docs: DataFrame, window: int, run: int, frequent: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, strings): the distinct super-k-mers of each piece of a task, packed by bucket."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settled = np.zeros(0, np.uint64)  # sent with a count of two before
        parcels: dict[int, Parcel] = {}
        held = 0

        def sent() -> pa.RecordBatch:
            each = sorted(parcels)
            return pa.record_batch([pa.array(each, pa.int32()), pa.array([parcels[i].packed() for i in each], pa.binary())],
                                   names=["bucket", "strings"])

        for batch in batches:
            for piece in chunks(batch, "text", PIECE_BYTES):
                s = Strings(piece.column("text"), window, run, frequent)
                _, at, count = np.unique(_pairs(s.h1, s.h2), return_index=True, return_counts=True)
                new = ~np.isin(s.h1[at] ^ s.h2[at], settled)
                at, many = at[new], count[new] > 1
                if len(settled) < SETTLED:
                    settled = np.union1d(settled, (s.h1[at] ^ s.h2[at])[many])
                goal = mix64(s.minimiser[at])
                bucket = (goal % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                at, many, bucket, lane = at[order], many[order], bucket[order], (goal[order] >> np.uint64(40)) % np.uint64(LANES)
                first, size = s.start[s.first[at]], s.end[s.last[at] - 1] - s.start[s.first[at]]
                each, cut = np.unique(bucket, return_index=True)
                for i, low, high in zip(each.tolist(), cut.tolist(), [*cut[1:].tolist(), len(bucket)]):
                    here = slice(low, high)
                    parcels.setdefault(i, Parcel()).add(
                        lane[here], size[here], many[here], _slices(s.data, first[here], size[here]).tobytes())
                held += int(size.sum())
                if held > PARCEL_BYTES:
                    yield sent()
                    parcels.clear()
                    held = 0
        yield sent()

    return docs.select("text").mapInArrow(tidied(task), "bucket int, strings binary")


def _equal_neighbours(data: np.ndarray, start: np.ndarray, end: np.ndarray, order: np.ndarray,
                      same: np.ndarray) -> np.ndarray:
    """Which of ``order``'s neighbours that ``same`` marks have the same bytes."""
    out = np.zeros(len(same), bool)
    at = np.flatnonzero(same)
    for low in range(0, len(at), 1 << 15):
        here = at[low:low + (1 << 15)]
        a, b = order[here], order[here + 1]
        size = end[a] - start[a]
        alike = size == end[b] - start[b]
        a, b, size, here = a[alike], b[alike], size[alike], here[alike]
        steps = _steps(size)
        equal = data[np.repeat(start[a], size) + steps] == data[np.repeat(start[b], size) + steps]
        out[here] = np.add.reduceat(~equal, np.cumsum(size) - size) == 0 if len(size) else True
    return out


def repeated_windows(data: np.ndarray, size: np.ndarray, many: np.ndarray,
                     window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct strings among those given, and masks of their repeated windows."""
    offsets = np.append(0, np.cumsum(size.astype(np.int64)))
    coded = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]) \
        .dictionary_encode()
    n = np.bincount(coded.indices.to_numpy(), weights=many + 1.0, minlength=len(coded.dictionary))
    data, at = texts_of(coded.dictionary)
    start, end, row = word_spans(data, at)
    sequences = Sequences(span_hashes(data, start, end, lower=False))
    begin = np.searchsorted(row, np.arange(len(n) + 1))
    windows = np.diff(begin) - window + 1
    owner = np.repeat(np.arange(len(n)), windows)
    step = _steps(windows)
    first = begin[owner] + step
    key = sequences.of(first, first + window, 0)
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    same = _equal_neighbours(data, start[first], end[first + window - 1], order, same)
    group = np.append(0, np.cumsum(~same)) if len(order) else np.zeros(0, np.int64)
    total = np.bincount(group, weights=n[owner[order]])
    repeated = np.zeros(len(order), bool)
    repeated[order] = total[group] > 1.5
    bits = np.where(repeated, np.uint64(1) << step.astype(np.uint64), np.uint64(0))
    mask = np.bitwise_or.reduceat(bits, np.cumsum(windows) - windows) if len(bits) else np.zeros(0, np.uint64)
    hit = np.flatnonzero(mask)
    h = [sequences.of(begin[:-1][hit], begin[1:][hit], i) for i in (0, 1)]
    return h[0], h[1], mask[hit]


def found_strings(sent: DataFrame, window: int) -> DataFrame:
    """(h1, h2, mask): distinct super-k-mers that hold a repeated window."""
    def count(table: pa.Table) -> pa.Table:
        parcels = [unpacked(b.as_py()) for b in table.column("strings")]
        ends = [np.cumsum(size, dtype=np.int64) for _, size, _, _ in parcels]
        found = []
        for lane in range(LANES):
            chosen = [np.flatnonzero(p[0] == lane) for p in parcels]
            size = np.concatenate([p[1][i] for p, i in zip(parcels, chosen)])
            if len(size):
                text = np.concatenate([_slices(p[3], e[i] - p[1][i], p[1][i]) for p, e, i in zip(parcels, ends, chosen)])
                many = np.concatenate([p[2][i] for p, i in zip(parcels, chosen)])
                found.append(repeated_windows(text, size, many, window))
        h1, h2, mask = map(np.concatenate, zip(*found)) if found else [np.zeros(0, np.uint64)] * 3
        return pa.table({"h1": h1.view(np.int64), "h2": h2.view(np.int64), "mask": mask.view(np.int64)})

    return sent.groupBy("bucket").applyInArrow(count, "h1 long, h2 long, mask long")


def string_places(docs: DataFrame, window: int, run: int, frequent: np.ndarray) -> DataFrame:
    """(k1, k2, place, h1, h2): the super-k-mers of each distinct text of a piece."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text", PIECE_BYTES):
                k = [piece.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2")]
                _, one = np.unique(_pairs(*(x.view(np.uint64) for x in k)), return_index=True)
                s = Strings(piece.column("text").take(pa.array(one)), window, run, frequent)
                owner = one[s.row[s.first]]
                yield pa.record_batch([
                    pa.array(k[0][owner]), pa.array(k[1][owner]), pa.array(s.place.astype(np.int32)),
                    pa.array(s.h1.view(np.int64)), pa.array(s.h2.view(np.int64))],
                    names=["k1", "k2", "place", "h1", "h2"])

    return docs.select("text", "k1", "k2").mapInArrow(
        tidied(task), "k1 long, k2 long, place int, h1 long, h2 long")


def _covered(marks: pa.Array, begins: np.ndarray, words: int, window: int) -> np.ndarray:
    """Which words of a piece are covered by a marked window."""
    size = np.asarray(marks.value_lengths().fill_null(0))
    flat = marks.flatten()
    owner = np.repeat(np.arange(len(marks)), size)
    place = np.asarray(flat.field(0)).astype(np.int64) + begins[owner]
    mask = np.asarray(flat.field(1)).view(np.uint64)
    edges = np.zeros(words + 1, np.int64)
    for bit in range(64):
        at = place[(mask >> np.uint64(bit)) & np.uint64(1) > 0] + bit
        np.add.at(edges, at, 1)
        np.add.at(edges, at + window, -1)
    return np.cumsum(edges)[:words] > 0


def without_windows(docs: DataFrame, window: int = WINDOW, run: int = RUN,
                    bucket_bytes: int = BUCKET_BYTES, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): the words of each text that no repeated window covers."""
    if not 0 < window - run + 1 <= 64:
        raise ValueError("a window holds 1 to 64 runs")
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumns(
        {f"k{i}": F.xxhash64(F.lit(i), "text") for i in (1, 2)})
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    frequent = frequent_runs(rows, run, sample_docs)
    buckets = max(1, 3 * size // bucket_bytes)
    found = found_strings(sent_strings(rows, window, run, frequent, buckets), window)
    marks = string_places(rows, window, run, frequent).join(found, ["h1", "h2"]).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("place", "mask")).alias("marks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text", PIECE_BYTES):
                data, start, end, row = packed_words(piece.column("text"))
                begins = np.searchsorted(row, np.arange(piece.num_rows + 1))
                gone = _covered(piece.column("marks"), begins, len(row), window)
                size = np.where(gone, 0, end - start + 1)
                text = _slices(data, start, size)
                stop = np.append(0, np.cumsum(size))[begins]
                raw = text.tobytes()
                kept = [raw[a:max(a, b - 1)] for a, b in zip(stop[:-1], stop[1:])]
                removed = np.append(0, np.cumsum(gone))[begins]
                yield pa.record_batch([
                    piece.column("doc_id"), pa.array(np.diff(begins)), pa.array(np.diff(removed)),
                    pa.array(kept, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks").mapInArrow(
        tidied(cut), f"doc_id {kind}, n_words long, n_removed long, kept binary")


def windows_report(docs: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return without_windows(docs, window, **options).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
