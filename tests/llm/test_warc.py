"""Archives are read back by an independent reader, and written alike twice."""
from __future__ import annotations

import base64
import gzip
import hashlib
import json
from pathlib import Path

from assayframe.llm.warc import member, page_of, read_archives, record_id, write_archives

SCHEMA = "page_id long, url string, html string, payload string, shard int, p long"


def corpus():
    rows = [(i, f"http://h/{i}", f"<p>{i % 40} é\x00\r\n\r\nWARC/1.1</p>" * (i % 9), "clash", 1, 2) for i in range(300)]
    rows += [(-5, None, None, None, None, None), (-4, "u\r\nX: y", "", None, None, None), (None, "n", "<p>none</p>", "", 0, 0),
             (None, "n", "<p>0 é\x00\r\n\r\nWARC/1.1</p>", "", 0, 0),
             (77, "http://other", "<p>second row of 77</p>", "", 0, 0), (500, "a", "z" * 200_000, "", 0, 0)]
    rows += [(600, "http://again", "<p>twice</p>", "", 0, 0)] * 2
    return rows


def expected(rows):
    order = lambda p: (p is None, p)
    first = {}
    for p, _, html, *_ in rows:
        raw = (html or "").encode()
        if raw not in first or order(p) < order(first[raw]):
            first[raw] = p
    seen, out = set(), []
    for p, url, html, *_ in sorted(rows, key=lambda r: (order(r[0]), r[2] or "", r[1] or "")):
        raw = (html or "").encode()
        kind = "response" if first[raw] == p and raw not in seen else "revisit"
        seen.add(raw)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((p, len(raw), digest, kind, first[raw] if kind == "revisit" else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(corpus(), SCHEMA).repartition(5)
    path = write_archives(df, f"file://{tmp_path}/a", shard_bytes=20_000, file_bytes=3_000)
    got = read_archives(spark, path)
    rows = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=str) == expected(corpus())
    texts = {r["payload"] for r in got.where("record_type = 'response'").collect()}
    assert {bytes(t) for t in texts} == {(r[2] or "").encode() for r in corpus()}
    files = sorted(Path(tmp_path, "a").glob("archive-*.warc.gz"))
    assert len(files) > 10
    listed = json.loads(Path(tmp_path, "a", "manifest.json").read_text())
    assert [(x["file"], x["bytes"]) for x in listed] == [(f.name, f.stat().st_size) for f in files]
    plain = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert plain.count(b"WARC-Type: warcinfo") == len(files)
    assert plain.count(b"WARC-Type: re") == len(corpus())


def test_same_rows_give_same_bytes(spark, tmp_path):
    df = spark.createDataFrame(corpus(), SCHEMA)
    for name, parts in (("a", 3), ("b", 8)):
        write_archives(df.repartition(parts), f"file://{tmp_path}/{name}", shard_bytes=20_000, file_bytes=5_000)
    a, b = ({f.name: f.read_bytes() for f in Path(tmp_path, n).glob("archive-*")} for n in "ab")
    assert a == b and len(a) > 3


def test_empty_table(spark, tmp_path):
    path = write_archives(spark.createDataFrame([], SCHEMA), f"file://{tmp_path}/e")
    assert read_archives(spark, path).collect() == []


def test_members_end_with_zero_and_ids_hold_pages():
    big = bytes(range(256)) * 70_000
    packed = member(big)
    assert packed[-1] == 0 and gzip.decompress(packed) == big
    for page in (0, 1, -7, (1 << 62) + 12345, None):
        assert page_of(record_id(page, 3)) == page
