"""Windows that occur more than once, against counting them one by one."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from assayframe.catalog.base import table
from assayframe.llm import superkmers
from assayframe.llm.catalog import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def run(spark, texts, window, ids=None, **options):
    ids = ids or list(range(len(texts)))
    docs = spark.createDataFrame([Row(doc_id=i, text=t) for i, t in zip(ids, texts)],
                                 "doc_id long, text string")
    rows = superkmers.windows_report(docs, window, **options).collect()
    return sorted((r.doc_id is not None, r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows)


def wanted(texts, window, ids=None):
    ids = ids or list(range(len(texts)))
    return sorted((i is not None, i, *x) for i, x in zip(ids, brute(texts, window)))


@pytest.mark.parametrize("window,run_words,bucket", [(5, 2, 200), (6, 3, 1 << 20), (4, 4, 300)])
def test_same_as_counting_every_window(spark, window, run_words, bucket):
    rng = random.Random(window)
    base = [" ".join(rng.choice("a b cc ä d e Ff ff".split(" ")) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts = base + rng.sample(base, 20) + [base[1] + "\n" + base[2], None, "", "a " * 50, "a " * 30, "one\ttwo\x0bthree"]
    assert run(spark, texts, window, run=run_words, bucket_bytes=bucket, sample_docs=50) == wanted(texts, window)


def test_long_window_with_copies_and_long_text(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(20, 120))) for _ in range(50)]
    texts += [t + " " + shared + " " + u for t, u in zip(texts[:10], texts[10:20])]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(40_000)) + " " + shared] + [texts[3]] * 30
    assert run(spark, texts, 35) == wanted(texts, 35)


def test_ids_null_repeated_and_extra_columns(spark):
    texts = ["a b c d e f", "a b c d e f", "x y z", None]
    ids = [None, None, 7, 7]
    docs = spark.createDataFrame(
        [Row(doc_id=i, text=t, k1="u", marks=1, n_words=2) for i, t in zip(ids, texts)],
        "doc_id long, text string, k1 string, marks int, n_words int")
    rows = superkmers.windows_report(docs, 4, run=2).collect()
    found = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in rows)
    assert found == [(0, 6, 6), (0, 6, 6), (7, 0, 0), (7, 3, 0)]


def test_no_rows(spark):
    assert superkmers.windows_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_equal_windows_have_equal_minimisers_and_strings_are_short():
    text = pa.array([" ".join(str(i % 97 * 31 % 89) for i in range(400))])
    s = superkmers.Strings(text, 35, 4, np.zeros(0, np.uint64))
    assert s.windows.sum() == 400 - 35 + 1 and s.windows.max() <= 32
    frequent = np.sort(s.minimiser[:1])
    other = superkmers.Strings(text, 35, 4, frequent)
    assert s.minimiser[0] not in other.minimiser or other.windows.sum() == s.windows.sum()


def test_registered_query_on_the_smallest_tables(spark, sf):
    docs = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op12_superkmers"].run(spark, sf).collect()
    assert sorted((True, *r) for r in found) == wanted([t for _, t in docs], 35, [i for i, _ in docs])
