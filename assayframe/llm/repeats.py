"""Remove passages that an earlier document has: every 50-byte string that also starts in a
document with a smaller id, found with a sampled suffix order.

Sorting all suffixes would move fifty bytes for every byte of text, so suffixes are sampled
first, in a way that loses nothing.  Every 50-byte window takes the smallest hash among its
24-byte grams (the leftmost on ties) as its anchor.  Equal windows have equal anchors at
equal places, so it is enough to compare windows whose anchors have the same gram.  About
one position in fourteen is an anchor; the bytes that its windows cover are its context.

1. Tasks take hashes of (gram, context) with the id of the document, reduce them to the
   smallest id per pair inside some megabytes of text, and send them to buckets, ranges of
   the gram hash.  A bucket sorts its entries.  A context that a smaller document also has
   is repeated as a whole.  If a gram has several contexts, windows at the edges of a
   passage may be equal although the contexts differ; the first owner of each such context
   sends its bytes.
2. Those bytes are range-partitioned by the hashed leading gram of their anchors, so that
   all suffixes that can be equal meet.  Each bucket sorts the suffixes of its contexts by
   multikey quicksort on words of eight bytes and compares neighbours over fifty bytes.
   A gram with very many contexts is sent window by window, ranged by the window's own
   hash instead, so no gram is one task.
3. Documents meet their repeated contexts and windows, and lose the bytes those cover.

Parts of documents are dealt by id and sixteen bits of the text's hash, which travel with the
entries, so many texts with one id, or without one, are many parts.  Texts are shuffled once; steps 2 and 3 read the same shuffle files.  Nothing is collected.

Defined results: null text is empty; texts below 50 bytes lose nothing; a null id counts as
larger than all others; rows with equal ids are one document for the comparison (they do not
shorten each other); an empty table gives no rows.  Other columns are carried along.
"""
from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from assayframe.llm.words import chunks, mix64, powers, texts_of, tidied, tidy

LENGTH = 50
GRAM = 24
UNIT_BYTES = 8 << 20
PIECE_BYTES = 1 << 19  # arrays of a piece fit a core's cache
SEGMENT = 4 << 20
PART_BYTES = 8 << 20
SLICE = 1 << 18
MANY_CONTEXTS = 20_000
_NO_ID = (1 << 63) - 1
_LOW = 24
_HASH = np.uint64((1 << 48) - 1)
RESOLVED, OPEN, OPEN_MANY = 0, 1, 2


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, first and last window, gram hash and context hash of every anchor.

    ``data`` must be shorter than 2^24 bytes.  Windows are numbered by their first byte.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    p, q = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:n], out=total[1:])
    gram = mix64((total[GRAM:] - total[:-GRAM]) * q[:n - GRAM + 1])
    low = np.uint64((1 << _LOW) - 1)
    best = (gram & ~low) | np.arange(len(gram), dtype=np.uint64)
    width, have = LENGTH - GRAM + 1, 1
    while 2 * have <= width:  # minima of 1, 2, 4 ... neighbours
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < width:
        best = np.minimum(best[:len(best) - (width - have)], best[width - have:])
    window = np.arange(len(best))
    row = np.searchsorted(at, window, "right") - 1
    real = np.flatnonzero(window + LENGTH <= at[row + 1])
    if not len(real):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    place, row = (best[real] & low).astype(np.int64), row[real]
    new = np.ones(len(real), bool)
    new[1:] = (place[1:] != place[:-1]) | (real[1:] != real[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(real)) - 1
    begin, end = real[first], real[last]
    stop = end + LENGTH
    context = mix64((total[stop] - total[begin]) * q[begin] + (stop - begin).astype(np.uint64)) & _HASH
    # Anchors are small hashes; mixed again they fall evenly into ranges.
    return row[first], begin, end, mix64(gram[place[first]] + np.uint64(1)), context


def _segments(piece: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, offsets and row starts of a slice; a very long text comes in overlapping parts."""
    data, at = texts_of(piece.column("text"))
    if len(data) <= SEGMENT or len(at) > 2:
        yield data, at, np.zeros(len(at) - 1, np.int64)
        return
    step = SEGMENT - LENGTH + 1
    for low in range(0, max(1, len(data) - LENGTH + 1), step):
        part = data[low:low + SEGMENT]
        yield part, np.array([0, len(part)]), np.array([low])


def all_anchors(piece: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Anchors of all rows of a slice, windows counted from the start of their own text."""
    parts = []
    for data, at, shift in _segments(piece):
        row, begin, end, gram, context = anchors(data, at)
        move = shift[row] - at[row] if len(row) else row
        parts.append((row, begin + move, end + move, gram, context))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _pack(ids: np.ndarray, *planes: np.ndarray) -> bytes:
    """Rising ids as small differences, and other columns byte by byte."""
    deltas = zlib.compress(np.diff(ids, prepend=np.int64(0)).tobytes(), 1)
    out = [len(ids).to_bytes(8, "little"), len(deltas).to_bytes(8, "little"), deltas]
    return b"".join(out + [np.ascontiguousarray(x).tobytes() for x in planes])


def _unpack(raw: bytes, *kinds) -> list[np.ndarray]:
    n, size = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    out = [np.cumsum(np.frombuffer(zlib.decompress(raw[16:16 + size]), np.int64))]
    at = 16 + size
    for kind, width in kinds:
        step = n * width
        out.append(np.frombuffer(raw, kind, n * width // np.dtype(kind).itemsize, at))
        at += step
    return out


def _six(x: np.ndarray) -> np.ndarray:
    """The low six bytes of each number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.view("<u8").ravel()


def _entries(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Step 1: the smallest id per (gram, context) of some megabytes of text, by gram range."""
    def flush(held: list, size: int) -> Iterator[pa.RecordBatch]:
        ids, salt, gram, context = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((salt, ids, context, gram))
        ids, salt, gram, context = ids[order], salt[order], gram[order], context[order]
        new = np.ones(len(ids), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        known = ids > ids[head]  # a smaller document of this unit has the context
        rows = []
        if known.any():
            by = np.lexsort((context[known], salt[known], ids[known]))
            rows.append((int(gram[0] % np.uint64(parts)), RESOLVED, _pack(
                ids[known][by], _six(context[known][by]), salt[known][by])))
        new[1:] |= salt[1:] != salt[:-1]  # every part of the smallest id has to be told
        new &= ~known
        ids, salt, gram, context = ids[new], salt[new], gram[new], context[new]
        bounds = np.searchsorted(_part_of(gram, parts), np.arange(parts + 1))
        for part in np.flatnonzero(np.diff(bounds)).tolist():
            here = slice(bounds[part], bounds[part + 1])
            by = np.lexsort((salt[here], ids[here]))
            rows.append((part, OPEN, _pack(ids[here][by], gram[here][by], _six(context[here][by]), salt[here][by])))
        yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int32(), pa.int32(), pa.binary()))], names=["part", "kind", "blob"])

    held, size = [], 0
    for batch in batches:
        for piece in chunks(batch, "text", PIECE_BYTES):
            row, _, _, gram, context = all_anchors(piece)
            if len(row):
                held.append((piece.column("id").to_numpy()[row], _salt(piece.column("key").to_numpy())[row], gram, context))
            size += piece.column("text").nbytes
            if size >= UNIT_BYTES and held:
                yield from flush(held, size)
                held, size = [], 0
    if held:
        yield from flush(held, size)


def _part_of(gram: np.ndarray, parts: int) -> np.ndarray:
    """Equal ranges of the gram hash; hashes are even, so no sample is needed."""
    return ((gram >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _salt(keys: np.ndarray) -> np.ndarray:
    return (keys & 0xFFFF).astype(np.uint16)


def _doc_part(ids: np.ndarray, salt: np.ndarray, parts: int) -> np.ndarray:
    return _part_of(mix64(mix64(ids.astype(np.uint64) + np.uint64(99)) + salt.astype(np.uint64)), parts)


def _decide(batches: Iterator[pa.RecordBatch], doc_parts: int, many: int) -> Iterator[pa.RecordBatch]:
    """The bucket of step 1: which contexts are repeated, and which need their bytes."""
    ids, salt, gram, context = [], [], [], []

    def send(ids: np.ndarray, salt: np.ndarray, context: np.ndarray, flag: np.ndarray) -> pa.RecordBatch:
        part = _doc_part(ids, salt, doc_parts)
        order = np.lexsort((context, ids, part))
        ids, context, flag, part = ids[order], context[order], flag[order], part[order]
        bounds = np.searchsorted(part, np.arange(doc_parts + 1))
        full = np.flatnonzero(np.diff(bounds)).tolist()
        return pa.record_batch([
            pa.array(full, pa.int32()),
            pa.array([_pack(ids[a:b], _six(context[a:b]), flag[a:b]) for a, b in ((bounds[i], bounds[i + 1]) for i in full)],
                     pa.binary())], names=["part", "blob"])

    for batch in batches:
        for kind, raw in zip(batch.column("kind").to_pylist(), batch.column("blob").to_pylist()):
            if kind == RESOLVED:
                i, c, x = _unpack(raw, (np.uint8, 6), (np.uint16, 2))
                yield send(i, x, _from_six(c), np.zeros(len(i), np.uint8))
            else:
                i, g, c, x = _unpack(raw, (np.uint64, 8), (np.uint8, 6), (np.uint16, 2))
                ids.append(i)
                salt.append(x)
                gram.append(g)
                context.append(_from_six(c))
    if not ids:
        return
    ids, salt, gram, context = (np.concatenate(x) for x in (ids, salt, gram, context))
    order = np.lexsort((ids, context, gram))
    ids, salt, gram, context = ids[order], salt[order], gram[order], context[order]
    new_gram = np.ones(len(ids), bool)
    new_gram[1:] = gram[1:] != gram[:-1]
    new = new_gram.copy()
    new[1:] |= context[1:] != context[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    group = np.cumsum(new_gram) - 1
    starts = np.flatnonzero(new_gram)
    contexts = np.add.reduceat(new.astype(np.int64), starts)[group]
    spread = (np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts))[group]
    flag = np.full(len(ids), 9, np.uint8)
    flag[ids > ids[head]] = RESOLVED
    first = (ids == ids[head]) & (contexts > 1) & spread
    flag[first] = np.where(contexts[first] > many, OPEN_MANY, OPEN)
    told = flag < 9
    if told.any():
        yield send(ids[told], salt[told], context[told], flag[told])


_RESULT = ["n_bytes", "n_removed", "n_spans", "kept"]


def _cut(raw: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[int, int, int, bytes]:
    """Lengths, runs and remaining bytes of a text that loses the bytes [begin, end)."""
    if not len(begin):
        return len(raw), 0, 0, raw
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
    return len(raw), int(gone.sum()), runs, np.frombuffer(raw, np.uint8)[~gone].tobytes()


_FOUND = pa.schema([("part", pa.int32()), ("id", pa.int64()), ("key", pa.int64()), ("place", pa.int64()),
                    ("bytes", pa.binary()), ("spans", pa.binary())])


def _open_contexts(docs: pa.Table, told: pa.Table, parts: int) -> pa.Table:
    """What the documents of a part lose at once (spans), and the bytes of their open contexts."""
    flags = [_unpack(raw, (np.uint8, 6), (np.uint8, 1)) for raw in told.column("blob").to_pylist()]
    if not flags or not docs.num_rows:
        return _FOUND.empty_table()
    ids, context, flag = (np.concatenate(x) for x in zip(*flags))
    context = _from_six(context)
    order = np.lexsort((flag, context, ids))
    ids, context, flag = ids[order], context[order], flag[order]
    out = [b for batch in docs.to_batches() for piece in chunks(batch, "text", PIECE_BYTES)
           for b in _piece(piece, parts, ids, context, flag)]
    return pa.Table.from_batches(out, _FOUND)


def _piece(piece: pa.RecordBatch, parts: int, ids: np.ndarray, context: np.ndarray,
           flag: np.ndarray) -> Iterator[pa.RecordBatch]:
    row, begin, end, gram, own = all_anchors(piece)
    order = np.argsort(row, kind="stable")
    row, begin, end, gram, own = row[order], begin[order], end[order], gram[order], own[order]
    bound = np.searchsorted(row, np.arange(piece.num_rows + 1)).tolist()
    doc_ids, keys = piece.column("id").to_numpy(), piece.column("key").to_numpy()
    low, high = (np.searchsorted(ids, doc_ids, side).tolist() for side in ("left", "right"))
    data, at = texts_of(piece.column("text"))
    made: list[tuple] = []
    for k in range(piece.num_rows):
        if low[k] == high[k] or bound[k] == bound[k + 1]:
            continue
        here = slice(bound[k], bound[k + 1])
        known, said = context[low[k]:high[k]], flag[low[k]:high[k]]
        place = np.minimum(np.searchsorted(known, own[here]), len(known) - 1)
        told = np.where(known[place] == own[here], said[place], 9)
        b, e = begin[here], end[here]
        gone = told == RESOLVED
        if gone.any():
            spans = _joined(b[gone], e[gone] + LENGTH)
            made.append((int(piece.column("part")[k].as_py()), doc_ids[k], keys[k], None, None, spans.tobytes()))
        raw = data[at[k]:at[k + 1]]
        for i in np.flatnonzero((told == OPEN) | (told == OPEN_MANY)).tolist():
            first, last = int(b[i]), int(e[i])
            if told[i] == OPEN:
                made.append((int(_part_of(gram[here][i:i + 1], parts)[0]), doc_ids[k], keys[k], first,
                             raw[first:last + LENGTH].tobytes(), None))
            else:  # a gram with very many contexts: window by window
                for w in range(first, last + 1):
                    text = raw[w:w + LENGTH].tobytes()
                    made.append((zlib.crc32(text) % parts, doc_ids[k], keys[k], w, text, None))
    if made:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*made), _FOUND)], schema=_FOUND)


def _joined(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rising spans [begin, end) with those that touch made one: pairs of numbers."""
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > np.maximum.accumulate(end)[:-1]
    last = np.append(np.flatnonzero(new)[1:], len(begin)) - 1
    return np.stack([begin[new], np.maximum.accumulate(end)[last]], axis=1).astype(np.int64)


def sort_suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of words and, in that order, where a row differs from the one before.

    Multikey quicksort with eight bytes as one character: rows are ordered by their first
    word, then only runs of equal rows by the next, and so on.
    """
    n, width = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    new = np.ones(n, bool)
    new[1:] = words[order[1:], 0] != words[order[:-1], 0]
    for k in range(1, width):
        alone = new & np.append(new[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        group = np.cumsum(new)[open_]
        rows = order[open_]
        by = np.lexsort((words[rows, k], group))
        order[open_] = rows[by]
        rows = rows[by]
        same = np.zeros(len(open_), bool)
        same[1:] = (group[1:] == group[:-1]) & (words[rows[1:], k] == words[rows[:-1], k])
        new[open_] = ~same
    return order, new


def _word(eight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one number that sorts like them."""
    return np.ascontiguousarray(eight[start]).view(">u8").ravel().astype(np.uint64)


def _compare(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Step 2: spans of the part's contexts that a smaller document has too; known spans pass through."""
    held = []
    for batch in batches:
        known = batch.column("spans").is_valid()
        ready = batch.filter(known)
        if ready.num_rows:
            yield ready.select(["part", "id", "key", "spans"])
        rest = batch.filter(pa.array(~known.to_numpy(zero_copy_only=False)))
        if rest.num_rows:
            held.append(rest)
    if not held:
        return
    table = pa.Table.from_batches(held)
    data, at = texts_of(table.column("bytes").combine_chunks())
    ids, keys, place = (table.column(c).to_numpy() for c in ("id", "key", "place"))
    count = np.diff(at) - LENGTH + 1
    owner = np.repeat(np.arange(len(ids)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = at[owner] + offset
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    found = []
    lead = np.empty(len(start), np.uint64)
    for low in range(0, len(start), SLICE):
        lead[low:low + SLICE] = _word(eight, start[low:low + SLICE])
    turn = mix64(lead) % np.uint64(-(-len(start) // SLICE) or 1)  # equal windows share a turn
    del lead
    for k in range(-(-len(start) // SLICE)):
        here = np.flatnonzero(turn == np.uint64(k))
        if not len(here):
            continue
        at_ = start[here]
        words = np.stack([_word(eight, at_ + step) for step in (0, 8, 16, 24, 32, 40, LENGTH - 8)], axis=1)
        order, new = sort_suffixes(words)
        own = ids[owner[here[order]]]
        least = np.minimum.reduceat(own, np.flatnonzero(new))
        found.append(here[order[own > least[np.cumsum(new) - 1]]])
    repeated = np.concatenate(found) if found else np.zeros(0, np.int64)
    repeated.sort()
    if not len(repeated):
        return
    run = np.ones(len(repeated), bool)
    run[1:] = (owner[repeated[1:]] != owner[repeated[:-1]]) | (offset[repeated[1:]] != offset[repeated[:-1]] + 1)
    first = repeated[run]
    last = repeated[np.append(np.flatnonzero(run)[1:], len(repeated)) - 1]
    who = owner[first]
    spans = np.stack([place[who] + offset[first], place[who] + offset[last] + LENGTH], axis=1).astype(np.int64)
    yield pa.record_batch([
        pa.array(_doc_part(ids[who], _salt(keys[who]), parts).astype(np.int32)), pa.array(ids[who]), pa.array(keys[who]),
        pa.array([x.tobytes() for x in spans], pa.binary())], names=["part", "id", "key", "spans"])


def _finish(docs: pa.Table, lost: pa.Table, schema: pa.Schema) -> pa.Table:
    """The documents of a part without the bytes of their spans."""
    known: dict[tuple[int, int], list[bytes]] = {}
    for doc_id, key, spans in zip(*(lost.column(c).to_pylist() for c in ("id", "key", "spans"))):
        known.setdefault((doc_id, key), []).append(spans)
    data, at = texts_of(docs.column("text").combine_chunks())
    results = []
    for k, pair in enumerate(zip(docs.column("id").to_pylist(), docs.column("key").to_pylist())):
        span = np.frombuffer(b"".join(known.get(pair, [])), np.int64).reshape(-1, 2)
        results.append(_cut(data[at[k]:at[k + 1]].tobytes(), span[:, 0], span[:, 1]))
    made = [pa.array([r[i] for r in results], f.type) for i, f in enumerate(list(schema)[2:])]
    return pa.table([docs.column("id"), docs.column("rest").cast(schema.field("rest").type), *made], schema=schema)


def _tidied_group(task: Callable) -> Callable:
    def run(docs: pa.Table, other: pa.Table) -> pa.Table:
        out = task(docs, other)
        tidy()
        return out

    return run


def without_repeats(docs: DataFrame, part_bytes: int = PART_BYTES, many: int = MANY_CONTEXTS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (bytes), and ``rest``, the other columns."""
    others = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    rest_type = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(others)] + [
        T.StructField("no_id", T.BooleanType())])
    named = [F.col("`" + f.name.replace("`", "``") + "`").alias(f"c{i}") for i, f in enumerate(others)]
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.struct(*named, F.col("doc_id").isNull().alias("no_id")).cast(rest_type).alias("rest")) \
        .withColumn("key", F.xxhash64("text"))
    size = int(rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0])
    parts = max(1, -(-size // part_bytes))
    entries = rows.select("id", "key", "text").mapInArrow(
        tidied(lambda b: _entries(b, parts)), "part int, kind int, blob binary").repartitionById(parts, "part")
    flags = entries.mapInArrow(tidied(lambda b: _decide(b, parts, many)), "part int, blob binary")
    made = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("rest", rest_type),
        *[T.StructField(n, T.LongType()) for n in _RESULT[:3]], T.StructField("kept", T.BinaryType())])
    schema = to_arrow_schema(made)

    @F.pandas_udf("int")
    def doc_part(ids: pd.Series, keys: pd.Series) -> pd.Series:
        return pd.Series(_doc_part(ids.to_numpy(), _salt(keys.to_numpy()), parts).astype(np.int32))

    # Both cogroups shuffle this one plan in the same way, so its texts are shuffled once.
    texts = rows.withColumn("part", doc_part("id", "key")).groupBy("part")
    found = texts.cogroup(flags.groupBy("part")).applyInArrow(
        _tidied_group(lambda docs, told: _open_contexts(docs, told, parts)),
        "part int, id long, key long, place long, bytes binary, spans binary")
    lost = found.repartitionById(parts, "part").mapInArrow(
        tidied(lambda b: _compare(b, parts)), "part int, id long, key long, spans binary")
    done = texts.cogroup(lost.groupBy("part")).applyInArrow(
        _tidied_group(lambda docs, lost: _finish(docs, lost, schema)), made)
    return done.select(F.when(~F.col("rest.no_id"), F.col("id")).alias("doc_id"), *_RESULT, "rest")


def repeats_report(docs: DataFrame, **how) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = without_repeats(docs.select("doc_id", "text"), **how)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def trimmed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with what is left of each text, and n_chars to match where there is one.

    A cut may fall inside a character; bytes that no longer are UTF-8 are left out.
    """
    names = [f.name for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    found = without_repeats(docs, **how)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.decode("utf-8", "ignore") for b in batch.column("kept").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("rest"), pa.array(texts, pa.string())],
                                  names=["doc_id", "rest", "text"])

    kinds = T.StructType([T.StructField("doc_id", T.LongType()), found.schema["rest"], T.StructField("text", T.StringType())])
    left = found.select("doc_id", "rest", "kept").mapInArrow(tidied(decode), kinds)
    columns = {n: F.col(f"rest.c{i}") for i, n in enumerate(names)}
    if "n_chars" in columns:
        columns["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    columns |= {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("text")}
    return left.select(*[columns[c].alias(c) for c in docs.columns])
