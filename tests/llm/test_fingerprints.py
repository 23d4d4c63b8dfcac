"""Fingerprints against a byte-by-byte version, and likeness against plain edit distance."""
from __future__ import annotations

import hashlib
import random

import numpy as np

from assayframe.llm import fingerprints as fp
from assayframe.llm.words import mix64

SCHEMA = "doc_id long, text string, part string, kind string"
BASE = 0x9E3779B97F4A7C15
FULL = (1 << 64) - 1


def poly(data):
    return sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(data)) & FULL


def slow(text):
    data = text.encode()
    levels = {}
    for i in range(fp.WINDOW - 1, len(data)):
        h = poly(data[i - fp.WINDOW + 1:i + 1])
        h ^= h >> 29
        h = h * 0x9FB21C651E98DF25 & FULL
        h = h >> 34 | 1 << 30
        levels[i] = (h & -h).bit_length() - 1
    level = fp.LEAST_LEVEL
    while sum(v >= level + 1 for v in levels.values()) >= fp.ENOUGH:
        level += 1
    out = [str(1 << level)]
    for step, most in enumerate(fp.LENGTHS):
        ends = [i + 1 for i in sorted(levels) if levels[i] >= level + step][:most - 1]
        bounds = [0, *[e for e in ends if e < len(data)], len(data)]
        out.append("".join(
            chr(fp.ALPHABET[int(mix64(np.array([(poly(data[a:b]) + b - a) & FULL], np.uint64))[0]) >> 58])
            for a, b in zip(bounds, bounds[1:]) if b > a))
    return ":".join(out)


def lev(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(line[j + 1] + 1, new[j] + 1, line[j] + (x != y)))
        line = new
    return line[-1]


def slow_likeness(x, y):
    if x == y:
        return 1.0
    (nx, x1, x2), (ny, y1, y2) = x.split(":"), y.split(":")
    nx, ny = int(nx), int(ny)
    pairs = [(x1, y1), (x2, y2)] if nx == ny else [(x1, y2)] if nx == 2 * ny else [(x2, y1)] if ny == 2 * nx else []
    best = 0.0
    for a, b in pairs:
        if {a[i:i + 4] for i in range(len(a) - 3)} & {b[i:i + 4] for i in range(len(b) - 3)}:
            best = max(best, 1 - lev(a, b) / max(len(a), len(b)))
    return best


def texts():
    rng = random.Random(5)
    words = [f"w{rng.randrange(10 ** 6)}é" for _ in range(400)]
    out = ["", "a", "abcdefg", "x" * 5000, "one line\n" * 900, " ", "\x00\x00"]
    out += [" ".join(rng.choice(words) for _ in range(n)) for n in (3, 20, 90, 300, 1200, 6000)]
    return out


def test_fingerprints_equal_the_slow_version():
    all_ = texts()
    got = fp.fingerprints([t.encode() for t in all_])
    assert got == [slow(t) for t in all_]
    assert got[0] == "4::" and fp.fingerprints([]) == []


def test_likeness_equals_plain_edit_distance():
    rng = random.Random(6)
    base = [t for t in texts() if len(t) > 50]
    pairs = [(t, t[:len(t) - n] + "other " * (n // 6)) for t in base for n in (10, len(t) // 10, len(t) // 3)]
    pairs += [(rng.choice(base), rng.choice(base)) for _ in range(10)] + [("", "a"), ("", "")]
    one, two = ([slow(p[i]) for p in pairs] for i in (0, 1))
    assert np.allclose(fp.likeness(one, two), [slow_likeness(a, b) for a, b in zip(one, two)])


def test_neighbours(spark):
    rows = [(i * 3, t, "x", "y") for i, t in enumerate(texts() * 3)] + [
        (None, "no id at all", None, None), (7, None, None, None), (12, "again", None, None), (12, "again", None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    want = []
    for k, (i, t, *_) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        changed = t[:len(t) - n] + nxt[:n]
        a, b, c = slow(t), slow(changed), slow(nxt)
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b,
                     round(slow_likeness(a, b), 9), round(slow_likeness(a, c), 9)))
    for size in (1 << 24, 20_000):
        got = [(*tuple(r)[:5], round(r[5], 9), round(r[6], 9)) for r in fp.with_neighbours(df, size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    plain = {(r["doc_id"], r["n_chars"], r["fingerprint"]) for r in fp.fingerprinted(df).collect()}
    assert plain == {(w[0], w[1], w[3]) for w in want}


def test_one_row_and_none(spark):
    assert fp.with_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
    row = fp.with_neighbours(spark.createDataFrame([(5, "abcdef", "", "")], SCHEMA)).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0
