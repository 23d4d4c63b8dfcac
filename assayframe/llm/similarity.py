"""Near-duplicate classes by a chosen-path Jaccard join on word shingles.

A text is its set of five-word shingles.  Equal sets are merged first, so copies cost one
row.  Every set gets 80 min-hash values; a value of one place is a sampled token that two
sets share with a chance equal to their similarity.  A run starts with all sets in one node.
A node picks one place, and with a chance of 1/4 a second one (1 / 0.8 places on average),
and sends each set to the child of its value there; children with few sets are compared by
brute force, larger ones split again, up to three levels.  Every run and level picks among
places of its own, so runs are independent: a pair at the threshold meets in one run with a
chance of at least 0.8 ** 3, whatever its nodes pick, and runs are repeated until the target
recall is reached.

What is left at the last level is many sets that share all sampled tokens, as large groups
of near copies do.  Such a node is cut into blocks, and pairs of blocks are compared by
matrix products in tasks of their own, so no node is one task and no pair is written out.

Brute force means: pairs whose min-hash values agree too little are passed over (5 standard
deviations below the threshold), as are pairs that meet in an earlier node; the others are
decided by the exact similarity of their shingle sets.  Each comparison gives back links per
set and one edge to the smallest set of its local group; classes are connected components.

Defined results: case and white space do not matter; a text with one to four words is one
shingle; texts without words (null, empty, blank) link to nothing; repeated rows are copies;
a class is named by its smallest doc_id; extra columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayframe.llm.rows import KEYS, keep_one, row_keys
from assayframe.llm.words import chunks, mix64, sets_of, shingles, tidied, word_hashes
from assayframe.session import materialise

WORDS = 5
THRESHOLD = 0.8
PLACES = 80
LEVELS = 3
NODE_SETS = 512
BLOCK_SETS = 512
TARGET_RECALL = 0.9999
_SLACK = 5.0


def run_recall(similarity: float, levels: int) -> float:
    """Chance that two sets of this similarity meet in one run of so many levels."""
    met = 1.0
    for _ in range(levels):
        one = similarity * met
        met = 0.75 * one + 0.25 * (1 - (1 - one) ** 2)
    return met


def least_recall(similarity: float, levels: int) -> float:
    """The same if no node on the way picks a second place: every pair has this chance at least."""
    return similarity ** levels


def runs_needed(threshold: float = THRESHOLD, target: float = TARGET_RECALL, levels: int = LEVELS) -> int:
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - least_recall(threshold, levels))))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts in rising order, and offsets."""
    words, row = word_hashes(column)
    found, row = shingles(words, row, WORDS)
    return sets_of(found, row, len(column))


def set_names(values: np.ndarray, at: np.ndarray) -> list[bytes]:
    """128 bits that stand for each set; empty for the empty set."""
    total = np.zeros((2, len(values) + 1), np.uint64)
    for k in (0, 1):
        np.cumsum(mix64(values + np.uint64(k * 0x51ED27)), out=total[k, 1:])
    sums = mix64(total[:, at[1:]] - total[:, at[:-1]])
    raw = np.ascontiguousarray(sums.T).tobytes()
    return [raw[16 * i:16 * i + 16] if n else b"" for i, n in enumerate(np.diff(at).tolist())]


def signatures(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Min-hash values of every set, one column per place; zero for empty sets."""
    rng = np.random.default_rng(23)
    factor = rng.integers(1 << 31, size=(PLACES, 2), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    low = (values >> np.uint64(13)).astype(np.uint32)
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, PLACES), np.uint32)
    if not len(full):
        return out
    starts = at[full]
    for place in range(PLACES):
        v = (low ^ factor[place, 0]) * factor[place, 1]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        v ^= v >> np.uint32(13)
        out[full, place] = np.minimum.reduceat(v, starts)
    return out


def described(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, row keys, the name of its set, its number of shingles, its signature."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                values, at = shingle_sets(piece.column("text"))
                marks = signatures(values, at)
                yield pa.record_batch([
                    *[piece.column(c) for c in ("doc_id", *KEYS)], pa.array(set_names(values, at), pa.binary()),
                    pa.array(np.diff(at).astype(np.int32)), pa.array([m.tobytes() for m in marks], pa.binary())],
                    names=["doc_id", *KEYS, "name", "n", "marks"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumns(row_keys())
    return rows.mapInArrow(tidied(task), "doc_id long, row_key_1 long, row_key_2 long, name binary, n int, marks binary")


def chosen_paths(sets: DataFrame, runs: int, levels: int = LEVELS, most: int = NODE_SETS) -> DataFrame:
    """(name, node, size) for every set and final node with at least two sets.

    No place serves two runs or levels, as long as there are ``runs * levels`` places.
    """
    width = max(1, PLACES // (runs * levels))
    now = sets.select("name", "marks", F.posexplode(F.array(*[
        F.xxhash64(F.lit("run"), F.lit(r)) for r in range(runs)])).alias("run", "node"))
    final = None
    for level in range(levels):
        def pick(salt: str, level: int = level):
            own = F.pmod(F.xxhash64("node", F.lit(salt)), F.lit(width)).cast("int")
            return (own + (F.col("run") * levels + level) * width) % PLACES

        two = F.pmod(F.xxhash64("node", F.lit("two")), F.lit(4)) == 0
        places = F.array_distinct(F.when(two, F.array(pick("a"), pick("b"))).otherwise(F.array(pick("a"))))
        child = now.select("name", "run", "node", "marks", F.explode(places).alias("place")).select(
            "name", "run", F.xxhash64("node", "place", F.expr("substring(marks, 4 * place + 1, 4)")).alias("node"))
        sizes = child.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
        child = materialise(child.join(sizes, "node"), f"paths-{level}")
        done = child if level == levels - 1 else child.where(F.col("size") <= most)
        final = done if final is None else final.unionByName(done)
        if level < levels - 1:
            now = child.where(F.col("size") > most).select("name", "run", "node").join(sets.select("name", "marks"), "name")
    return final.drop("run")


def spread(members: DataFrame, block: int = BLOCK_SETS) -> DataFrame:
    """Members with the pair of blocks (left, right) to compare and their own block.

    A node of at most ``block`` sets is one block; larger ones give every set once for each
    block that its own meets.
    """
    blocks = F.ceil(F.col("size") / float(block)).cast("int")
    own = F.pmod(F.xxhash64("name", "node"), F.col("blocks")).cast("int")
    return members.withColumn("blocks", blocks).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({
            "left": F.least("own", "other"), "right": F.greatest("own", "other")}).drop("blocks", "other", "size")


_GROUP = ["node", "left", "right"]


def _groups(batches: Iterator[pa.RecordBatch], most: int = 20_000) -> Iterator[pa.Table]:
    """Tables that hold whole groups, from batches sorted by group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= most:
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in _GROUP]
            other = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
            if len(other):
                cut = int(other[-1]) + 1
                yield table.slice(0, cut)
                rest = table.slice(cut).combine_chunks()
                held, rows = rest.to_batches(), rest.num_rows
    if held:
        yield pa.Table.from_batches(held)


def _matrix(column: pa.ChunkedArray, width: int, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


def candidates(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one group that may be similar and do not meet in an earlier node."""
    node, left, right, own = (table.column(c).to_numpy() for c in (*_GROUP, "own"))
    n = table.column("n").to_numpy().astype(np.float64)
    marks = _matrix(table.column("marks"), PLACES, np.uint32)
    least = threshold - _SLACK * math.sqrt(threshold * (1 - threshold) / PLACES)
    group = np.zeros(len(node), np.int64)
    group[1:] = np.cumsum((node[1:] != node[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    step, here = 1, np.arange(len(node))
    while True:
        here = here[here + step < len(node)]
        here = here[group[here] == group[here + step]]
        if not len(here):
            break
        i, j = here, here + step
        fits = (own[i] != own[j]) | (left[i] == right[i])
        fits &= np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])
        i, j = i[fits], j[fits]
        alike = (marks[i] == marks[j]).mean(axis=1) >= least
        out.append((i[alike], j[alike]))
        step += 1
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = (np.concatenate(x) for x in zip(*out))
    nodes = table.column("nodes").to_pylist()
    first = np.ones(len(i), bool)
    wide = max((len(x) for x in nodes), default=1)
    listed = np.zeros((len(nodes), wide), np.int64)
    real = np.zeros((len(nodes), wide), bool)
    for k, x in enumerate(nodes):
        listed[k, :len(x)], real[k, :len(x)] = x, True
    for a in range(0, len(i), 4096):
        p, q = i[a:a + 4096], j[a:a + 4096]
        common = (listed[p][:, :, None] == listed[q][:, None, :]) & real[p][:, :, None] & real[q][:, None, :]
        earlier = common.any(axis=2) & (listed[p] < node[p][:, None])
        first[a:a + 4096] = ~earlier.any(axis=1)
    return i[first], j[first]


def similar(values: list[np.ndarray], i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sorted sets have a Jaccard similarity of at least ``threshold``."""
    sizes = np.array([len(v) for v in values])
    rows = np.unique(np.concatenate([i, j]))
    if len(i) >= 8 * len(rows):  # many pairs among few sets: one matrix product
        every = np.concatenate([values[r] for r in rows])
        owner = np.repeat(np.arange(len(rows)), sizes[rows])
        _, place, count = np.unique(every, return_inverse=True, return_counts=True)
        shared = count > 1
        number = np.cumsum(shared) - 1
        both = np.zeros(len(i))
        keep = shared[place]
        owner, place = owner[keep], number[place[keep]]
        a, b = np.searchsorted(rows, i), np.searchsorted(rows, j)
        for low in range(0, int(shared.sum()), 8192):
            part = (place >= low) & (place < low + 8192)
            dense = np.zeros((len(rows), 8192), np.float32)
            dense[owner[part], place[part] - low] = 1
            both += (dense @ dense.T)[a, b]
    else:
        both = np.empty(len(i))
        for k, (a, b) in enumerate(zip(i.tolist(), j.tolist())):
            merged = np.concatenate([values[a], values[b]])
            merged.sort(kind="stable")
            both[k] = np.count_nonzero(merged[1:] == merged[:-1])
    return both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9


def _wanted(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches):
        i, j = candidates(table, threshold)
        rows = np.unique(np.concatenate([i, j]))
        if len(rows):
            yield from table.select([*_GROUP, "own", "name"]).take(pa.array(rows)).to_batches()


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches, 4000):
        keys = list(zip(*(table.column(c).to_pylist() for c in (*_GROUP, "name"))))
        fresh = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]  # repeated rows
        table = table.take(pa.array(fresh))
        i, j = candidates(table, threshold)
        if not len(i):
            continue
        node, left, right = (table.column(c).to_numpy() for c in _GROUP)
        values = [np.frombuffer(v, np.uint64) for v in table.column("shingles").to_pylist()]
        names = np.array(table.column("name").to_pylist(), dtype=object)
        copies = table.column("copies").to_numpy()
        group = np.zeros(len(node), np.int64)
        group[1:] = np.cumsum((node[1:] != node[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1]))
        order = np.argsort(group[i], kind="stable")
        i, j = i[order], j[order]
        edges = np.flatnonzero(np.diff(group[i])) + 1
        ok = np.concatenate([similar(values, a, b, threshold) for a, b in zip(np.split(i, edges), np.split(j, edges))])
        i, j = i[ok], j[ok]
        if not len(i):
            continue
        sets = np.bincount(i, minlength=len(names)) + np.bincount(j, minlength=len(names))
        docs = np.bincount(i, copies[j], len(names)) + np.bincount(j, copies[i], len(names))
        root = np.arange(len(names))
        while True:  # the smallest row of each local group of links
            low = root.copy()
            np.minimum.at(low, i, root[j])
            np.minimum.at(low, j, root[i])
            if (low == root).all():
                break
            root = low[low]
        linked = np.flatnonzero(sets)
        yield pa.record_batch([
            pa.array(names[linked].tolist(), pa.binary()), pa.array(sets[linked].astype(np.int64)),
            pa.array(docs[linked].astype(np.int64)), pa.array(names[root[linked]].tolist(), pa.binary())],
            names=["name", "sets", "docs", "root"])


def links(docs: DataFrame, rows: DataFrame, sets: DataFrame, threshold: float, runs: int) -> DataFrame:
    """(name, sets, docs, root): links of each set found in each node, stored."""
    members = chosen_paths(sets, runs)
    nodes = members.groupBy("name").agg(F.sort_array(F.collect_list("node")).alias("nodes"))
    known = sets.join(nodes, "name").select("name", "n", "marks", "nodes", "copies", *KEYS)
    known = materialise(known, "paths-known")
    grouped = members.join(known.select("name", "n", "marks", "nodes"), "name")
    ready = spread(grouped).repartition(*_GROUP).sortWithinPartitions(*_GROUP, "name")
    wanted = materialise(ready.select(*_GROUP, "own", "name", "n", "marks", "nodes").mapInArrow(
        tidied(lambda b: _wanted(b, threshold)), "node long, left int, right int, own int, name binary"), "wanted")
    needed = wanted.select("name").distinct().join(known, "name")

    def with_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                values, at = shingle_sets(piece.column("text"))
                raw = values.tobytes()
                column = pa.array([raw[8 * a:8 * b] for a, b in zip(at[:-1], at[1:])], pa.binary())
                rest = [piece.column(c) for c in piece.schema.names if c != "text"]
                yield pa.record_batch([*rest, column], names=[*[c for c in piece.schema.names if c != "text"], "shingles"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumns(row_keys()).select(*KEYS, "text")
    full = texts.join(needed, KEYS).select("name", "n", "marks", "nodes", "copies", "text").mapInArrow(
        tidied(with_shingles), "name binary, n int, marks binary, nodes array<long>, copies long, shingles binary")
    ready = wanted.join(full, "name").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "name")
    return materialise(ready.select(*_GROUP, "own", "name", "n", "marks", "nodes", "copies", "shingles").mapInArrow(
        tidied(lambda b: _verified(b, threshold)), "name binary, sets long, docs long, root binary"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(name, class): the smallest name of each connected component, from edges (name, root).

    Every round takes the smallest label among a set, its neighbours and its label's own
    label, so labels travel by doubling; sums are combined before they are shuffled.
    """
    pairs = edges.where("name <> root").select("name", "root")
    both = materialise(pairs.unionByName(pairs.select(F.col("root").alias("name"), F.col("name").alias("root")))
                       .distinct(), "edges")
    label = both.groupBy("name").agg(F.min("root").alias("r")).select("name", F.least("name", "r").alias("class"))
    label = materialise(label, "classes")
    while True:
        around = both.join(label.select(F.col("name").alias("root"), "class"), "root").groupBy("name").agg(
            F.min("class").alias("near"))
        above = label.select(F.col("name").alias("class"), F.col("class").alias("top"))
        step = label.join(around, "name").join(above, "class", "left").select(
            "name", F.least("class", "near", "top").alias("next"), "class")
        step = materialise(step, "classes")
        label = step.select("name", F.col("next").alias("class"))
        if step.where("next <> class").isEmpty():
            return label


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, runs: int | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links, n_text_links, and the row's keys.

    n_links counts the other documents whose similarity is at least ``threshold``, copies
    included; n_text_links the different texts (shingle sets) among them.
    """
    rows = materialise(described(docs), "described")
    filled = rows.where("n > 0")
    sets = materialise(filled.groupBy("name").agg(
        F.first("n").alias("n"), F.first("marks").alias("marks"), F.count("*").alias("copies"),
        F.min("doc_id").alias("low"), F.min(F.struct(*KEYS)).alias("k")).select(
            "name", "n", "marks", "copies", "low", "k.*"), "sets")
    found = links(docs, rows, sets, threshold, runs or runs_needed(threshold))
    counts = found.groupBy("name").agg(F.sum("sets").alias("sets"), F.sum("docs").alias("docs"))
    classes = components(found)
    per = sets.select("name", "copies", "low").join(counts, "name", "left").join(classes, "name", "left") \
        .withColumn("class", F.coalesce("class", "name"))
    smallest = per.groupBy("class").agg(F.min("low").alias("class_id"))
    per = per.join(smallest, "class").select(
        "name", "class_id", (F.col("copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links"),
        F.coalesce("sets", F.lit(0)).alias("n_text_links"), F.col("class").alias("class_name"))
    out = rows.select("doc_id", "name", *KEYS).join(per, "name", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"), "class_name", *KEYS)


def without_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest doc_id."""
    found = near_duplicates(docs, threshold)
    one = F.coalesce(F.col("class_name"), F.concat(*[F.col(k).cast("string").cast("binary") for k in KEYS]))
    kept = found.withColumn("one", one).groupBy("one").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEYS)).alias("k")).select("k.*")
    return keep_one(docs, kept.select(*KEYS))
