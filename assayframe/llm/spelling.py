"""Spelling variants: words one insertion, deletion or replacement apart, by a trie of letter counts.

Words are longest runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case; the words of
a column of texts are counted where they stand and combined before the shuffle.  ``damage``
changes some of them by a rule that depends on id and word alone.  The vocabulary is the words
of at least ``least_length`` code points that occur at least ``least_count`` times.

The letters are dealt into ``GROUPS`` groups.  A word's vector says how many letters it has of
each group.  One edit adds one to one count, takes one from one count, or both; so the vectors
of near words differ by a surplus of at most one and a deficit of at most one.  A trie holds
the words by the counts of successive groups.  A depth-first search carries the queries that
have budget left down the branches and drops a branch when none is left.  Leaves hold few
words, or words that agree in every count; a large leaf compares only words that share their
first or their second half, of which one edit leaves one whole.  What is left is verified
letter by letter.

The first ``SPLIT`` counts are the key of a subtree.  Every word goes to its own subtree and,
as a query, to the later ones that its budget reaches, 1 + SPLIT * (SPLIT + 1) / 2 at
most; a pair is found once and told to both.  A subtree is one group of a task.

``forms`` links a word to its near word of largest count, if that is at least twice its own;
counts double along such links, so following them to the last takes the logarithm of the
logarithm of the largest count in joins.

Defined results: null and empty texts have no words; a null id counts as empty text; repeated
rows count each; words that no longer meet the length after the damage are left out; ties of
counts go to the smallest word in code-point order; very long words are treated like all
others.  Other columns are ignored.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.words import chunks, mix64, texts_of, tidied
from assayframe.session import materialise

LEAST_LENGTH = 5
LEAST_COUNT = 3
DAMAGED = 97
# Letters that prose uses most stand in groups of their own; all others are dealt by their code.
OWN_GROUPS = "eainrotsl"
GROUPS = 16
SPLIT = 4
LEAF_WORDS = 48
SLOW_LENGTH = 64  # pairs of longer words are verified one by one


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1)
    return table


_CRC = _crc_table()


def letter_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z in lower case, and start, end and row of every run of letters."""
    data, at = texts_of(column)
    data = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    letter = (data >= 97) & (data <= 122)
    lead = data == 0xC3  # with the byte after it U+00C0 to U+00FF
    letter |= lead
    letter[1:] |= lead[:-1]
    edge = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
    begins = edge[:-1] == 1
    cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
    begins[cuts] |= letter[cuts]
    start = np.flatnonzero(begins)
    stops = edge[1:] == -1
    cuts = cuts[letter[cuts - 1]]
    stops[cuts - 1] = True
    end = np.flatnonzero(stops) + 1
    return data, start, end, np.searchsorted(at, start, "right") - 1


def run_checksums(data: np.ndarray, start: np.ndarray, end: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """crc32 of each run after what ``begun``, a crc32 for each run, stands for."""
    state = begun.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(start - end, kind="stable")  # longest first
    size, first, state = (end - start)[order], start[order], state[order]
    for step in range(int(size[0]) if len(size) else 0):
        n = np.searchsorted(-size, -step)  # runs longer than step
        part = state[:n]
        state[:n] = _CRC[(part ^ data[first[:n] + step]) & 0xFF] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def counted_words(docs: DataFrame, damaged: int | None = DAMAGED) -> DataFrame:
    """(word, n): occurrences of each word, damaged by rule where ``damaged`` is given."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text", 1 << 20):
                data, start, end, row = letter_runs(piece.column("text"))
                hit, made = np.zeros(0, np.int64), []
                if damaged:
                    seeds = [zlib.crc32(f"{i or ''}:".encode()) for i in piece.column("doc_id").to_pylist()]
                    check = run_checksums(data, start, end, np.array(seeds, np.uint32)[row])
                    hit = np.flatnonzero(check % np.uint32(damaged) == 0)
                    for i in hit.tolist():
                        word = data[start[i]:end[i]].tobytes().decode()
                        gone = int(check[i]) % len(word)
                        made.append(word[:gone] + word[gone + 1:])
                left = np.ones(len(start), bool)
                left[hit] = False
                size = np.where(left, end - start, 0)
                offsets = np.append(0, np.cumsum(size))
                text = data[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
                words = pa.Array.from_buffers(pa.large_binary(), len(size), [
                    None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(text)]).filter(pa.array(left))
                words = pa.concat_arrays([words, pa.array([w.encode() for w in made], pa.large_binary())])
                found = pc.value_counts(words)
                yield pa.record_batch([found.field("values").cast(pa.large_string()).cast(pa.string()),
                                       found.field("counts")], names=["word", "n"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(tidied(task), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def group_table() -> np.ndarray:
    """The group of each of the 256 letters."""
    table = np.arange(256) % (GROUPS - len(OWN_GROUPS)) + len(OWN_GROUPS)
    for i, letter in enumerate(OWN_GROUPS):
        table[ord(letter)] = i
    return table


class Words:
    """Words as one buffer of letters, one byte each, with their vectors."""

    def __init__(self, column: pa.Array):
        raw = [w.encode("latin-1") for w in column.to_pylist()]
        self.size = np.array([len(w) for w in raw], np.int64)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        owner = np.repeat(np.arange(len(raw)), self.size)
        self.vector = np.bincount(owner * GROUPS + group_table()[self.data], minlength=len(raw) * GROUPS) \
            .reshape(-1, GROUPS).astype(np.int32)

    def half_keys(self, at: np.ndarray, half: np.ndarray, back: bool) -> np.ndarray:
        """A hash of the first (or last) ``half`` letters of each word of ``at``."""
        key = half.astype(np.uint64)
        for step in range(int(half.max()) if len(half) else 0):
            live = half > step
            place = self.end[at[live]] - 1 - step if back else self.start[at[live]] + step
            key[live] = mix64(key[live] * np.uint64(257) + self.data[place])
        return key


def one_edit_apart(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one inserted, deleted or replaced letter."""
    swap = words.size[a] > words.size[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    gap = words.size[b] - words.size[a]
    out = np.zeros(len(a), bool)
    slow = (gap <= 1) & (words.size[a] > SLOW_LENGTH)
    for i in np.flatnonzero(slow).tolist():
        x, y = (words.data[words.start[w]:words.end[w]] for w in (a[i], b[i]))
        differ = np.flatnonzero(x != y[:len(x)])
        at = int(differ[0]) if len(differ) else len(x)
        out[i] = len(differ) == 1 if gap[i] == 0 else bool((x[at:] == y[at + 1:]).all())
    rest = np.flatnonzero((gap <= 1) & ~slow)
    a, b, gap = a[rest], b[rest], gap[rest]
    width = int(words.size[a].max()) if len(a) else 0
    lead = np.zeros(len(a), np.int64)  # letters that agree from the front, and from the back
    tail = np.zeros(len(a), np.int64)
    fore, rear = np.ones(len(a), bool), np.ones(len(a), bool)
    for step in range(width):
        live = words.size[a] > step
        ahead, behind = np.where(live, step, 0), np.where(live, step + 1, 1)
        fore &= live & (words.data[words.start[a] + ahead] == words.data[words.start[b] + ahead])
        rear &= live & (words.data[words.end[a] - behind] == words.data[words.end[b] - behind])
        lead += fore
        tail += rear
    size = words.size[a]
    out[rest] = np.where(gap == 1, lead + tail >= size, (lead < size) & (lead + tail >= size - 1))
    return out


class Trie:
    """Words by the counts of successive letter groups, searched with a budget of one each way."""

    def __init__(self, words: Words, held: np.ndarray):
        order = np.lexsort(words.vector[held].T[::-1])
        self.words, self.held = words, held[order]
        self.vector = words.vector[self.held]

    def near(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, word) that may be one edit apart, leaf by leaf."""
        none = np.zeros(len(queries), np.int8)
        stack = [(0, len(self.held), 0, queries, none, none)]
        while stack:
            low, high, depth, alive, surplus, deficit = stack.pop()
            if depth == GROUPS or high - low <= LEAF_WORDS:
                yield from self._leaf(self.held[low:high], alive)
                continue
            counts = self.vector[low:high, depth]
            value, cut = np.unique(counts, return_index=True)
            wanted = self.words.vector[alive, depth]
            order = np.argsort(wanted, kind="stable")
            wanted = wanted[order]
            for count, a, b in zip(value.tolist(), cut.tolist(), [*cut[1:].tolist(), high - low]):
                some = order[np.searchsorted(wanted, count - 1):np.searchsorted(wanted, count + 1, "right")]
                step = count - self.words.vector[alive[some], depth]
                more, less = surplus[some] + (step > 0), deficit[some] + (step < 0)
                kept = (more <= 1) & (less <= 1)
                if kept.any():
                    stack.append((low + a, low + b, depth + 1, alive[some[kept]], more[kept].astype(np.int8),
                                  less[kept].astype(np.int8)))

    def _leaf(self, held: np.ndarray, alive: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if len(held) <= LEAF_WORDS:
            for low in range(0, len(alive), 4096):
                part = alive[low:low + 4096]
                yield np.repeat(part, len(held)), np.tile(held, len(part))
            return
        size = self.words.size
        for length in np.unique(size[held]).tolist():
            here = held[size[held] == length]
            for gap in (-1, 0, 1):
                asked = alive[size[alive] == length + gap]
                half = min(length, length + gap) // 2
                for back in (False, True):
                    # the half behind the edit is one letter longer where the number is odd
                    n = half if not back else min(length, length + gap) - half - (gap == 0)
                    yield from self._alike(asked, here, n, back)

    def _alike(self, asked: np.ndarray, here: np.ndarray, letters: int, back: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that share that many letters at one end."""
        a, b = (self.words.half_keys(x, np.full(len(x), letters), back) for x in (asked, here))
        here, b = here[np.argsort(b, kind="stable")], np.sort(b)
        low, high = np.searchsorted(b, a), np.searchsorted(b, a, "right")
        for first in range(0, len(a), 4096):
            n = (high - low)[first:first + 4096]
            place = np.repeat(low[first:first + 4096], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            yield np.repeat(asked[first:first + 4096], n), here[place]


def near_pairs(words: Words, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words one edit apart of which the second is an ``own`` one; each pair once."""
    trie = Trie(words, np.flatnonzero(own))
    found = []
    for a, b in trie.near(np.arange(len(words.size))):
        first = ~own[a] | (a < b)  # of two own words the first asks
        a, b = a[first], b[first]
        close = np.abs(words.vector[a] - words.vector[b]).sum(axis=1) <= 2 if len(a) else first[:0]
        a, b = a[close], b[close]
        good = one_edit_apart(words, a, b)
        found.append(np.stack([a[good], b[good]]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found, axis=1), axis=1)
    return pairs[0], pairs[1]


def _subtrees(split: int) -> np.ndarray:
    """Steps from a word's key to its own and to the later keys within its budget."""
    steps = {(0,) * split}
    for i in range(split):
        for sign in (1, -1):
            one = [0] * split
            one[i] = sign
            steps.add(tuple(one))
            for j in range(split):
                if j != i:
                    two = list(one)
                    two[j] = -sign
                    steps.add(tuple(two))
    return np.array(sorted(s for s in steps if s >= (0,) * split))


def near_words(vocabulary: DataFrame, split: int = SPLIT) -> DataFrame:
    """(word, n, other, other_n): all pairs of words one edit apart, each both ways."""
    steps = _subtrees(split)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vector = Words(batch.column("word")).vector[:, :split]
                goal = vector[:, None, :] + steps[None, :, :]
                word, step = np.nonzero((goal >= 0).all(axis=2))
                key = np.zeros(len(word), np.int64)
                for i in range(split):
                    key = key * (1 << (60 // split)) + goal[word, step, i]
                take = pa.array(word)
                yield pa.record_batch([
                    pa.array(key), pa.array((steps[step] == 0).all(axis=1)), batch.column("word").take(take),
                    batch.column("n").take(take)], names=["subtree", "own", "word", "n"])

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        text, n = table.column("word"), table.column("n")
        a, b = near_pairs(Words(text), np.asarray(table.column("own")))
        one, two = pa.array(np.append(a, b)), pa.array(np.append(b, a))
        return pa.table({"word": text.take(one), "n": n.take(one), "other": text.take(two), "other_n": n.take(two)})

    sent = vocabulary.mapInArrow(tidied(spread), "subtree long, own boolean, word string, n long")
    return sent.groupBy("subtree").applyInArrow(search, "word string, n long, other string, other_n long")


def roots(linked: DataFrame) -> DataFrame:
    """``root``: the end of the links word -> form; each round of joins doubles the steps taken."""
    most = linked.agg(F.max("form_n")).first()[0] or 0
    links = materialise(linked.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    steps = max(0, int(most).bit_length())  # counts at least double along a link
    for _ in range(max(0, steps - 1).bit_length()):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        links = materialise(links.join(ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root")), "links")
    return linked.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def variants(docs: DataFrame, damaged: int | None = None, least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, split: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary.

    A larger vocabulary gets keys of more counts, so that a subtree stays one task's work.
    """
    words = materialise(counted_words(docs, damaged).where(
        (F.length("word") >= least_length) & (F.col("n") >= least_count)), "vocabulary")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), "other"))
    split = split or min(12, SPLIT + (words.count() >> 18).bit_length())
    near = near_words(words, split).groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("best"))
    linked = words.join(near, "word", "left")
    strong = -F.col("best.minus") >= 2 * F.col("n")
    linked = materialise(linked.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best.other")).alias("form"),
        F.when(strong, -F.col("best.minus")).alias("form_n")), "forms")
    return roots(linked).select("word", "form", "root", "n", "n_near", "form_n")
