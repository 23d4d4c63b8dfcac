"""Exact top-k inner products by blocks of documents, best block first.

Vectors are quantised to integers and stored in blocks of consecutive ids: the forward
index of a block is its matrix, and its summary holds the largest and smallest value of
every component ("term").  A query's bound for a block is the sum over its components of
the larger of the two products.  Each task takes one group of queries and one run of
blocks, goes through the blocks in falling order of their bounds, and stops scoring a
query once the bound is below the query's k-th score.  The best of every run are merged
by (score, id), so results are exact whatever the bounds prune.

Defined results: a vector that is null or holds a null, NaN or infinite component takes no
part; vectors of different length are compared as if padded with zeros; equal vectors are
ordered by id; repeated ids are separate rows, as queries and as candidates: a query row
meets all rows but itself; no queries or no candidates give no rows; extra columns are ignored.  Scores beyond
64 bits wrap, as integer sums do.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.session import materialise

K = 5
SCALE = 256
BLOCK_ROWS = 256
RUN_ROWS = 32_768
QUERY_ROWS = 16_384
_TURN = 1024  # queries of a group that are scored at once
_EXACT = 1 << 53
_MERGED_RUNS = 512  # runs whose results one row of the first merging step brings together
_OUT = pa.schema([("query_row", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, scale: int = SCALE, is_query: Column | None = None) -> DataFrame:
    """Rows (vec_id, asks, q) with q = floor(scale * x) of each component; unusable vectors go."""
    asks = F.lit(True) if is_query is None else F.coalesce(is_query, F.lit(False))
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), asks.alias("asks"),
        F.transform("embedding", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))
        .alias("q"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), np.int64)
    if width:
        out[np.arange(width) < lengths[:, None]] = values
    return out


def _scores(queries: np.ndarray, block: np.ndarray, small: bool) -> np.ndarray:
    if small:  # every partial sum is an integer below 2^53, which doubles hold exactly
        return (queries.astype(np.float64) @ block.astype(np.float64).T).astype(np.int64)
    return np.stack([(queries * row).sum(axis=1) for row in block], axis=1)


def best_of_run(asking: np.ndarray, queries: np.ndarray, numbers: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                k: int, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best rows of one run of documents for each query row of one group."""
    order = np.lexsort((numbers, ids))
    numbers, ids, rows = numbers[order], ids[order], rows[order]
    cuts = np.arange(0, len(ids), block_rows)
    high = np.maximum.reduceat(rows, cuts, axis=0).astype(np.float64)
    low = np.minimum.reduceat(rows, cuts, axis=0).astype(np.float64)
    values = queries.astype(np.float64)
    largest = float(np.abs(values).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, rows.shape[1])
    small = largest < _EXACT
    bounds = np.maximum(values, 0) @ high.T + np.minimum(values, 0) @ low.T
    if not small:
        bounds = np.full_like(bounds, np.inf)  # rounding could make a bound too low
    top = np.full((len(asking), k), np.iinfo(np.int64).min)
    who = np.full((len(asking), k), np.iinfo(np.int64).max)
    found = np.zeros((len(asking), k), bool)
    visits = np.argsort(-bounds, axis=1, kind="stable")
    live = np.arange(len(asking))
    for turn in range(len(cuts)):
        at = visits[live, turn]
        full = found[live, k - 1]
        going = ~full | (bounds[live, at] >= top[live, k - 1])
        live, at = live[going], at[going]  # later bounds are no higher: these queries are done
        if not len(live):
            break
        for b in np.unique(at):
            q = live[at == b]
            here = slice(cuts[b], min(cuts[b] + block_rows, len(ids)))
            score = _scores(queries[q], rows[here], small)
            mine = numbers[here][None, :] != asking[q][:, None]
            every = np.concatenate([top[q], score], axis=1)
            names = np.concatenate([who[q], np.broadcast_to(ids[here], score.shape)], axis=1)
            real = np.concatenate([found[q], mine], axis=1)
            rank = np.lexsort((names, -every.astype(np.float64) if small else ~every, ~real), axis=1)[:, :k]
            line = np.arange(len(q))[:, None]
            top[q], who[q], found[q] = every[line, rank], names[line, rank], real[line, rank]
    line, place = np.nonzero(found)
    return line, who[line, place], top[line, place]


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE,
          block_rows: int = BLOCK_ROWS, run_rows: int = RUN_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` best other rows of each query row.

    Documents are cut into runs of consecutive ids and queries into groups; each pair of a
    group and a run is one small task that holds one run and one group, and gives back at
    most ``k`` rows a query.  Queries are a stated set; no pair of single rows is ever made.
    Every document is copied once per group and every query once per run, so large groups
    and runs keep the copies few; a task holds some tens of megabytes.
    """
    # stored with a number for each row, which tells a query's own row from others of its id
    ready = materialise(quantised(vectors, scale, is_query).withColumn("number", F.monotonically_increasing_id()), "vectors")
    asks = ready.where("asks")
    counts = ready.agg(F.count("*"), F.min("vec_id"), F.max("vec_id"), F.max(F.size("q"))).first()
    total, low, high, width = int(counts[0]), counts[1], counts[2], int(counts[3] or 0)
    runs = max(1, -(-total // run_rows))
    groups = max(1, -(-int(asks.count()) // query_rows))
    # Equal ranges of ids; a range with far too many rows is dealt out further.  Which run
    # a row is in does not change the result.
    span = 1 if low is None else (int(high) - int(low)) // runs + 1
    base = 0 if low is None else int(low)
    ranged = F.floor((F.col("vec_id") - F.lit(base)) / F.lit(span)).cast("long")
    held = ready.groupBy(ranged.alias("r")).count().collect() if total else []
    parts = {r["r"]: -(-r["count"] // run_rows) for r in held if r["count"] > 2 * run_rows}
    part = F.lit(0).cast("long")
    if parts:
        listed = F.create_map(*[F.lit(x).cast("long") for item in parts.items() for x in item])
        part = F.pmod(F.xxhash64("number"),
                      F.coalesce(listed[ranged], F.lit(1).cast("long")))
    run = ranged * F.lit(1 << 20) + part
    every = [(r["r"] << 20) + i for r in held for i in range(parts.get(r["r"], 1))]
    documents = ready.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), run.alias("run"),
        F.lit(False).alias("asks"), "number", "vec_id", "q")
    group = F.pmod(F.xxhash64("number"), F.lit(groups)).cast("int")
    queries = asks.select(
        group.alias("grp"), F.explode(F.lit(every).cast("array<long>")).alias("run"),
        F.lit(True).alias("asks"), "number", "vec_id", "q")

    def task(table: pa.Table) -> pa.Table:
        matrix = _matrix(table.column("q").combine_chunks(), width)
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy()
        if asks.all() or not asks.any():
            return _OUT.empty_table()
        number = table.column("number").to_numpy()
        parts = []
        for a in range(0, int(asks.sum()), _TURN):
            own = np.flatnonzero(asks)[a:a + _TURN]
            line, who, score = best_of_run(number[own], matrix[own], number[~asks], ids[~asks], matrix[~asks], k, block_rows)
            parts.append((number[own][line], ids[own][line], who, score))
        return pa.table([np.concatenate(x) for x in zip(*parts)], schema=_OUT)

    found = documents.unionByName(queries).groupBy("grp", "run").applyInArrow(
        lambda key, table: _with_run(key[1].as_py(), task(table)),
        "query_row long, query_id long, vec_id long, score long, run long")

    def best(rows: DataFrame, *by: str | Column) -> DataFrame:
        held = rows.groupBy("query_row", "query_id", *by).agg(F.slice(F.sort_array(F.collect_list(
            F.struct((-F.col("score")).alias("low"), "vec_id", "score"))), 1, k).alias("best"))
        return held

    # merged in two steps, so that no row gathers the results of all runs
    some = best(found, F.pmod(F.xxhash64("run"), F.lit(-(-len(every) // _MERGED_RUNS) or 1)).alias("part"))
    some = some.select("query_row", "query_id", F.inline("best")).drop("low")
    return best(some).select("query_id", F.posexplode("best").alias("pos", "b")).select(
        "query_id", (F.col("pos") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"),
        F.col("b.score").alias("score"))


def _with_run(run: int, found: pa.Table) -> pa.Table:
    return found.append_column("run", pa.array(np.full(len(found), run, np.int64)))
