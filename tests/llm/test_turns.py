"""Repair of conversations against trying all edits, and against a slow version of the query."""
import hashlib
import itertools
import random
import re
import zlib

import pytest

from assayframe.catalog.base import table
from assayframe.llm import turns
from assayframe.llm.catalog import QUERIES

GOOD = re.compile(r"(s?(ua)+)?\Z")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def row_options(role, fault):
    yield 2, "D", ""
    if fault not in ("blank", "duplicate"):
        extra = 5 if fault == "truncated" else 0
        yield extra, "K", role[:1] or "-"
        yield from ((1 + extra, "R", x) for x in "ua")


def by_all_edits(rows, most=2):
    """Every choice of edits with up to ``most`` insertions at each place."""
    inserted = [list(x) for n in range(most + 1) for x in itertools.product("ua", repeat=n)]
    best = None
    for gaps in itertools.product(inserted, repeat=len(rows) + 1):
        for chosen in itertools.product(*[list(row_options(*r)) for r in rows]):
            audit, out, cost = "", "", 0
            for i, gap in enumerate(gaps):
                audit, out, cost = audit + "I" * len(gap), out + "".join(gap), cost + 5 * len(gap)
                if i < len(rows):
                    c, letter, x = chosen[i]
                    audit, out, cost = audit + letter, out + x, cost + c
            if GOOD.match(out) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def by_states(rows):
    """Least (cost, audit) of each state after each row, relaxed until nothing changes."""
    now = {"": (0, "")}
    for step in range(len(rows) + 1):
        for _ in range(4):
            for state, (cost, audit) in list(now.items()):
                for x in "ua":
                    to = NEXT.get((state, x))
                    if to and (to not in now or (cost + 5, audit + "I") < now[to]):
                        now[to] = (cost + 5, audit + "I")
        if step < len(rows):
            ahead = {}
            for state, (cost, audit) in now.items():
                for c, letter, x in row_options(*rows[step]):
                    to = state if x == "" else NEXT.get((state, x))
                    if to is not None and (to not in ahead or (cost + c, audit + letter) < ahead[to]):
                        ahead[to] = (cost + c, audit + letter)
            now = ahead
    return min(now[q] for q in ("", "a") if q in now)


LETTERS = {(r, f): turns._KINDS[k][i] for i, r in enumerate(["system", "user", "assistant", "tool"])
           for k, f in enumerate([None, "truncated", "blank"])}


@pytest.mark.parametrize("length", [0, 1, 2])
def test_derivation_is_the_least_of_all_edits(length):
    for rows in itertools.product(list(LETTERS), repeat=length):
        (cost, _, audit), = turns.derived("".join(LETTERS[r] for r in rows), 0, turns._GOALS)
        assert (cost, audit) == by_all_edits(rows) == by_states(rows)


def test_longer_derivations_and_blocks():
    rng = random.Random(4)
    for _ in range(400):
        rows = rng.choices(list(LETTERS), k=rng.randrange(1, 25))
        text = "".join(LETTERS[r] for r in rows)
        (cost, _, audit), = turns.derived(text, 0, turns._GOALS)
        assert (cost, audit) == by_states(rows)
        size = rng.randrange(1, 6)
        blocks = [[(p, q, c, a) for p in range(4) for c, q, a in turns.derived(text[i:i + size], p, (0, 1, 2, 3))]
                  for i in range(0, len(text), size)]
        assert turns.joined_blocks(blocks) == (cost, audit)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        rule = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if rule == 1:
            text = ""
        if rule == 2:
            text = re.sub("[.!?]", "", text)
        out += [] if rule == 0 else [(conv, turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    return out


def brute(rows, damaged=True):
    groups = {r[0]: [] for r in rows}
    for row in damage(rows) if damaged else rows:
        groups[row[0]].append(row)
    out = []
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults = set(), []
        for _, _, role, text in found:
            bare = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else None)
            seen.add((role, text))
        numbers = [r[1] for r in found if r[1] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        first = [r[2][:1] for r in found]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
        cost, audit = by_states([(r[2], f) for r, f in zip(found, faults)])
        left, text, last = iter(found), [], ""
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            made = "assistant" if last == "u" else "user"
            role = row[2] if letter == "K" else made
            text.append(f"{role}:{row[3] if row else ''}")
            last = role[:1]
        sha = hashlib.sha256("\n".join(text).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


SCHEMA = "conv_id long, turn long, role string, text string, place int, letters string"


@pytest.mark.parametrize("block", [1024, 3])
def test_odd_rows(spark, block):
    rng = random.Random(block)
    texts = ["Yes.", "No!", "open", "Why? ", "", "\t ", "ä.\n", " ", "end. ", None, "Yes."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    weights = [8, 8, 2, 1, 1, 1, 1]
    rows = [(c, rng.choice([None, *range(8)]), rng.choices(roles, weights)[0], rng.choice(texts))
            for c in [None, *range(60)] for _ in range(rng.randrange(1, 14))]
    rows += [(900, i, "user" if i % 2 else "assistant", f"{i % 50}.") for i in range(300)]
    rows += [(901, 5, "user", "same.")] * 40 + [(902, None, None, None)] * 3
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert found(turns.repair_report(df, block=block)) == brute(rows)
    plain = [(c, t, r or " ", " " if x is None else x) for c, t, r, x in rows if r != ""]
    df = spark.createDataFrame([(*r, 1, "x") for r in plain], SCHEMA)
    assert found(turns.repair(df, block)) == brute(plain, damaged=False)


def test_dropped_conversations_and_no_rows(spark):
    gone = [(c, 0, "user", "Hi.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    df = spark.createDataFrame([(*r, 1, "x") for r in gone], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert gone and found(turns.repair_report(df)) == [(r[0], 0, 0, 0, 0, 0, 0, "", nothing) for r in gone]
    assert turns.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    df = QUERIES["op13_repair"].run(spark, sf)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found(df) == brute(rows)
