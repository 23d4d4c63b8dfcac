"""Repairing the structure of conversations by Knuth's lightest derivations.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Edits and their costs: keep a
turn (K, 0), give it the role user or assistant (R, 1), delete it (D, 2), insert an empty
user or assistant turn anywhere (I, 5).  A turn's first fault counts: blank (nothing but
blanks), duplicate (an earlier turn has its role and text) or truncated (its last
character that is no blank is none of ``.!?``).  Blank and duplicate turns must go; a
truncated turn that stays costs 5 more.  The result is the cheapest list of edits, and of
equal ones the smallest text of edit letters.

Edits are deductions over weighted items: ``row i gives symbol x``, ``x is inserted``, ``the
first i rows lead to state q``, and for long conversations ``block b leads from q to r``.  A
hyperedge joins a state with what comes next; its cost is the sum and its audit the
concatenation of both tails.  The agenda pops items by (cost, rows consumed, audit).  A
deduction adds cost or rows, so no head comes before its tails, and two audits of the same
rows and cost are never one the beginning of the other, so joining keeps their order: popped
items are final, and the search ends when the goal is popped.

Turns that agree in conversation, turn, role and text are one row with a number.  The first
turn of each text is an aggregate that is joined back.  Rows are range-partitioned in order,
so a conversation of any length is spread over tasks, and reduced to one letter a turn.  The
letters of a conversation, as many as its audit has, are cut in blocks; blocks derive all
state changes in their own tasks and one small task a conversation joins them.  The text of
a repaired conversation is hashed from a stream of its sorted turns, one turn at a time.

Defined results: null role and text are one space; rows are ordered by turn (null first),
then role and text; a null conv_id is a conversation of its own; a conversation without
turns, or of which all are deleted, has an empty audit or one of D alone and the hash of the
empty text; roles of other initials can only be changed or deleted.  Other columns are
ignored.
"""
from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayframe.llm.words import tidied
from assayframe.session import materialise

RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLOCK = 1024
_BLANK = " \t\n\x0b\f\r"
# A letter for role and fault of a turn: as it is, truncated, to be deleted.
_KINDS = ("suax", "SUAX", "0123")
# States: nothing yet, after system, after user, after assistant.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_GOALS = (0, 3)
_LEGAL = {"su", "ua", "au"}


def lightest(axioms: Iterable[tuple[tuple[int, int, str], Hashable]],
             deduce: Callable[[Hashable, dict], Iterable[tuple[tuple[int, int, str], Hashable]]],
             is_goal: Callable[[Hashable], bool]) -> dict:
    """Knuth's agenda: the final (cost, rows, audit) of items, until a goal item is final.

    ``deduce`` gives the heads of the hyperedges whose last missing tail is the given item.
    """
    agenda = [(value, item) for value, item in axioms]
    heapq.heapify(agenda)
    best = {item: value for value, item in sorted(agenda, reverse=True)}
    final: dict = {}
    while agenda:
        value, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = value
        if is_goal(item):
            break
        for found, head in deduce(item, final):
            if head not in final and (head not in best or found < best[head]):
                best[head] = found
                heapq.heappush(agenda, (found, head))
    return final


def _joined(a: tuple[int, int, str], b: tuple[int, int, str]) -> tuple[int, int, str]:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def _row_edits(letter: str) -> list[tuple[int, str, str]]:
    """(cost, symbol, edit) of everything that can be done with a turn."""
    found = [(DELETE, "", "D")]
    for extra, kinds in ((0, _KINDS[0]), (TRUNCATED, _KINDS[1])):
        if letter in kinds:
            own = _KINDS[0][kinds.index(letter)]
            found += [(extra, own, "K")] if own != "x" else []
            found += [(extra + RELABEL, x, "R") for x in "ua" if x != own]
    return found


@lru_cache(maxsize=1 << 14)
def derived(letters: str, start: int, goals: tuple[int, ...]) -> tuple[tuple[int, int, str], ...]:
    """(cost, state, audit) of the lightest ways from ``start`` over all turns to the ``goals``.

    One goal state, the lightest, if ``goals`` are the states that end a conversation;
    otherwise all of them that can be reached.
    """
    n = len(letters)
    axioms = [((0, 0, ""), ("at", 0, start))] + [((INSERT, 0, "I"), ("new", 0, x)) for x in "ua"]
    axioms += [((cost, 1, edit), ("row", i, x)) for i, letter in enumerate(letters) for cost, x, edit in _row_edits(letter)]

    def deduce(item, final):
        kind, i, x = item
        if kind == "at":
            tails = [(("row", i, y), i + 1, y) for y in ("", "s", "u", "a")] if i < n else []
            tails += [(("new", 0, y), i, y) for y in "ua"]
            for tail, there, y in tails:
                state = x if y == "" else _NEXT.get((x, y))
                if state is not None and tail in final:
                    yield _joined(final[item], final[tail]), ("at", there, state)
        elif kind == "row":
            for state in range(4):
                head = state if x == "" else _NEXT.get((state, x))
                if head is not None and ("at", i, state) in final:
                    yield _joined(final["at", i, state], final[item]), ("at", i + 1, head)
        # an inserted turn waits for no state that is final before it: states of cost below
        # INSERT are joined when it is popped
        else:
            for (k, j, state), value in list(final.items()):
                if k == "at" and (state, x) in _NEXT:
                    yield _joined(value, final[item]), ("at", j, _NEXT[state, x])

    single = goals == _GOALS
    final = lightest(axioms, deduce, lambda item: single and item[0] == "at" and item[1] == n and item[2] in goals)
    ends = [(final["at", n, q][0], q, final["at", n, q][2]) for q in goals if ("at", n, q) in final]
    return (min(ends, key=lambda e: (e[0], e[2])),) if single else tuple(ends)


def joined_blocks(blocks: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """Cost and audit of the lightest way through blocks of (from, to, cost, audit).

    States are joined with one block after the other, which is the order of rows consumed.
    Audits stay in their blocks: a state's audit is the chain of blocks it came through, and
    only ties compare letters, back to where their chains meet.
    """
    best: dict[int, tuple[int, tuple | None]] = {0: (0, None)}
    for block in blocks:
        ahead: dict[int, tuple[int, tuple | None]] = {}
        for state, to, cost, audit in block:
            if state in best:
                offered = (best[state][0] + cost, (best[state][1], audit))
                if to not in ahead or _before(offered, ahead[to]):
                    ahead[to] = offered
        best = ahead
    ends = [best[q] for q in _GOALS if q in best]
    chosen = ends[0] if len(ends) < 2 or _before(ends[0], ends[1]) else ends[1]
    parts, chain = [], chosen[1]
    while chain is not None:
        chain, audit = chain
        parts.append(audit)
    return chosen[0], "".join(reversed(parts))


def _before(a: tuple, b: tuple) -> bool:
    """Whether (cost, chain of audits) a is less than b; chains have equally many blocks."""
    if a[0] != b[0]:
        return a[0] < b[0]
    one, two, x, y = [], [], a[1], b[1]
    while x is not y:
        (x, first), (y, second) = x, y
        one.append(first)
        two.append(second)
    return "".join(reversed(one)) < "".join(reversed(two))


def _first_fault(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character that is no blank ends no sentence."""
    bare = F.rtrim(text, F.lit(_BLANK))
    return bare == "", ~F.substring(bare, -1, 1).isin(".", "!", "?")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Every distinct turn in order: its place, letters and faults; stored."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    ).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("times")).withColumns(
        {f"h{i}": F.xxhash64(F.lit(i), F.length("role"), "role", "text") for i in (1, 2)})
    asked = [F.col("conv_id").isNull().alias("no_id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("id"), "h1", "h2"]
    first = rows.select(*asked, F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("at")).groupBy(
        "no_id", "id", "h1", "h2").agg(F.min("at.known").alias("known"), F.min("at.turn").alias("least"),
                                       F.count("*").alias("turns")).where("turns > 1")
    rows = rows.select("*", *asked[:2]).join(first, ["no_id", "id", "h1", "h2"], "left")
    # a turn without number comes first, else the smallest number
    later = F.col("turns").isNotNull() & F.when(F.col("known"), F.col("turn") > F.col("least")).otherwise(F.col("turn").isNotNull())
    blank, open_end = _first_fault(F.col("text"))
    role = F.coalesce(F.nullif(F.instr(F.lit("sua"), F.substring("role", 1, 1)), F.lit(0)), F.lit(4))
    role = F.when(F.col("role") == "", 4).otherwise(role)
    fault = F.when(F.col("blank") | F.col("later"), 3).when(F.col("open_end"), 2).otherwise(1)
    letter = [F.substring(F.element_at(F.array(*map(F.lit, _KINDS)), kind), F.col("kind").cast("int"), F.lit(1))
              for kind in (F.col("fault"), F.lit(3))]
    found = rows.withColumns({"later": later, "blank": blank, "open_end": open_end, "kind": role}) \
        .withColumn("fault", fault).select(
            "conv_id", "turn", "role", "text", "times",
            F.concat(letter[0], F.repeat(letter[1], (F.col("times") - 1).cast("int"))).alias("letters"),
            F.when(F.col("blank"), F.col("times")).otherwise(0).alias("n_blank"),
            F.when(F.col("blank"), 0).when(F.col("later"), F.col("times")).otherwise(F.col("times") - 1).alias("n_duplicate"),
            (F.col("fault") == 2).cast("long").alias("n_truncated"))
    order = ["conv_id", "turn", "role", "text"]
    width = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # beginnings only: Spark brings a sample of the keys to the driver
    ranged = found.repartitionByRange(width, *order[:2], *[F.substring(c, 1, 64) for c in order[2:]])
    return materialise(ranged.sortWithinPartitions(*order).withColumns(
        {"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()}), "turns")


def conversation_letters(ordered: DataFrame) -> DataFrame:
    """(conv_id, letters): one letter a turn, in order."""
    block = F.shiftright("place", 10).alias("block")
    pieces = ordered.groupBy("conv_id", block).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "letters"))), lambda x: x["letters"]), "").alias("letters"))
    return pieces.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "letters"))), lambda x: x["letters"]), "").alias("letters"))


def edits(letters: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, illegal, cost, audit) of conversations of one letter a turn; stored."""
    kind = letters.schema["conv_id"].dataType.simpleString()
    step = "struct<a:int,b:int,cost:long,audit:string>"
    starts = F.sequence(F.lit(0), F.greatest(F.length("letters") - 1, F.lit(0)), F.lit(block))
    cut = letters.select("conv_id", F.size(starts).alias("blocks"), "letters", F.posexplode(starts)).select(
        "conv_id", "blocks", F.col("pos").alias("no"), F.substring("letters", F.col("col") + 1, F.lit(block)).alias("letters"),
        F.when(F.col("col") > 0, F.substring("letters", F.col("col"), F.lit(1))).otherwise("").alias("before"))

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = str.maketrans("".join(_KINDS[1:]), _KINDS[0] * 2)
        for batch in batches:
            steps, illegal = [], []
            for blocks, text, before in zip(*(batch.column(c).to_pylist() for c in ("blocks", "letters", "before"))):
                roles = (before + text).translate(plain)
                illegal.append(sum(roles[i:i + 2] not in _LEGAL for i in range(len(roles) - 1)))
                if blocks == 1:
                    found = [(0, q, cost, audit) for cost, q, audit in derived(text, 0, _GOALS)]
                else:
                    found = [(p, q, cost, audit) for p in range(4) for cost, q, audit in derived(text, p, (0, 1, 2, 3))]
                steps.append([dict(zip(("a", "b", "cost", "audit"), f)) for f in found])
            yield pa.record_batch([
                batch.column("conv_id"), batch.column("blocks"), batch.column("no"), pa.array(illegal, pa.int64()),
                pa.array(steps, pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))],
                names=["conv_id", "blocks", "no", "illegal", "steps"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        blocks = [[tuple(s.values()) for s in steps] for steps in table.column("steps").to_pylist()]
        cost, audit = joined_blocks(blocks)
        return pa.table({"conv_id": table.column("conv_id").slice(0, 1), "illegal": pa.array([sum(table.column("illegal").to_pylist())]),
                         "cost": pa.array([cost]), "audit": pa.array([audit])})

    out = f"conv_id {kind}, illegal long, cost long, audit string"
    found = materialise(cut.mapInArrow(tidied(derive), f"conv_id {kind}, blocks int, no int, illegal long, steps array<{step}>"), "steps")
    short = found.where("blocks = 1").select("conv_id", "illegal", F.col("steps")[0]["cost"].alias("cost"), F.col("steps")[0]["audit"].alias("audit"))
    return materialise(short.unionByName(found.where("blocks > 1").groupBy("conv_id").applyInArrow(join, out)), "edits")


class Rewriter:
    """Applies an audit to the turns of one conversation, one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last, self.hash, self.turns = audit, 0, "", hashlib.sha256(), 0

    def _put(self, role: str, text: str) -> None:
        self.hash.update((b"\n" if self.turns else b"") + f"{role}:{text}".encode())
        self.turns += 1
        self.last = role[:1]

    def _due(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._put(self._due(), "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._put(role, text)
        elif edit == "R":
            self._put(self._due(), text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


def repaired_hashes(ordered: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256), from turns in order behind their conversation's audit."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    rows = found.select("conv_id", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"),
                        F.lit(0).cast("long").alias("times")).unionByName(
        ordered.select("conv_id", "place", "role", "text", "times"))
    rows = rows.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "place")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, who = None, None

        def row(ids: list, digests: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array(ids, id_type), pa.array(digests, pa.string())], names=["conv_id", "repaired_sha256"])

        id_type = None
        for batch in batches:
            id_type = batch.column("conv_id").type
            ids, digests = [], []
            for i, place, role, text, times in zip(*(c.to_pylist() for c in batch.columns)):
                if place < 0:
                    if now is not None:
                        ids.append(who)
                        digests.append(now.digest())
                    now, who = Rewriter(text), i
                for _ in range(times):
                    now.turn(role, text)
            yield row(ids, digests)
        if now is not None:
            yield row([who], [now.digest()])

    return rows.mapInArrow(tidied(task), f"conv_id {kind}, repaired_sha256 string")


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation: faults, gaps, cost and audit of its repair, hash of the result."""
    ordered = ordered_turns(turns)
    by_turn = ordered.groupBy("conv_id", "turn").agg(*[F.sum(c).alias(c) for c in ("n_blank", "n_duplicate", "n_truncated")])
    counts = by_turn.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.sum(f"n_{c}").alias(c) for c in ("blank", "duplicate", "truncated")])
    found = edits(conversation_letters(ordered), block)
    same = [("counts", counts), ("hashes", repaired_hashes(ordered, found))]
    out = found.alias("found")
    for name, other in same:
        out = out.join(other.alias(name), F.col("found.conv_id").eqNullSafe(F.col(f"{name}.conv_id")))
    return out.select("found.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns spoilt by a rule on crc32 of ``conv_id:turn``; nulls count as one space.

    Of 20 remainders 0 drops a turn, 1 empties it, 2 takes ``.!?`` out, 3 repeats it and 4
    makes it the user's.
    """
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    rule = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"]).cast("binary")) % 20
    return turns.select(
        "conv_id", "turn", F.when(rule == 4, "user").otherwise(text["role"]).alias("role"),
        F.when(rule == 1, "").when(rule == 2, F.regexp_replace(text["text"], "[.!?]", "")).otherwise(text["text"]).alias("text"),
        F.explode(F.when(rule == 0, F.array().cast("array<int>")).when(rule == 3, F.array(F.lit(1), F.lit(2)))
                  .otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_report(turns: DataFrame, damage: Callable[[DataFrame], DataFrame] = damaged, block: int = BLOCK) -> DataFrame:
    """``repair`` of damaged turns, with every conversation of the given ones."""
    found = repair(damage(turns), block)
    all_ids = turns.select(F.col("conv_id").alias("asked")).distinct()
    rows = all_ids.join(found, F.col("asked").eqNullSafe(F.col("conv_id")), "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.col("asked").alias("conv_id"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
