"""WARC archives: a deterministic sharded writer, and a reader.

Writing: records are ordered by page id.  Splitters from a hash sample of the ids cut that
order into shards; a shard is one task, which builds its records in order, compresses each
as a gzip member of its own and starts a new file when the compressed size reaches the
limit.  Of records with equal payloads the one with the smallest page id is the response;
the others become revisit records without payload.  The file writer of Spark commits the
files under temporary names; the driver then gives them their final names and writes the
manifest last, so a folder without a manifest is not an archive.  Two runs over equal rows
give equal bytes.

The text writer adds one byte after each value.  A gzip member ends with the high byte of
its length, which is zero below 16 MiB, so that byte is cut off and added by the writer;
a longer record is followed by an empty member, which ends with a zero byte too.

Defined results: null html is an empty payload; a null url is left out of the header; a
null page id is written without a number and read back as null, after all others; rows that
repeat a page id are all written, the first in order of payload digest and url counting as
the earliest; an empty table gives an archive without records.  Extra columns are ignored.
"""
from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SHARD_BYTES = 24 << 20
FILE_BYTES = 8 << 20
SAMPLE_ROWS = 20_000
LEAST_REVISIT = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LAST = (1 << 63) - 1
_READ_BYTES = 1 << 14  # what a member leaves over is copied, so little is read at once
_EMPTY_MEMBER = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


def digest_text(raw: bytes) -> str:
    return base64.b32encode(raw).decode("ascii")


def record_id(page_id: int | None, serial: int = 0) -> str:
    """A UUID of version 8 that holds the page id and a serial for repeated ids."""
    number = _LAST if page_id is None else page_id
    number &= (1 << 64) - 1
    value = (number >> 16) << 80 | 8 << 76 | 2 << 62 | (number & 0xFFFF) << 46 | serial
    return f"<urn:uuid:{uuid.UUID(int=value)}>"


def page_of(text: str) -> int | None:
    value = uuid.UUID(text.strip("<>").removeprefix("urn:uuid:")).int
    number = (value >> 80) << 16 | (value >> 46) & 0xFFFF
    number -= (number >> 63) << 64
    return None if number == _LAST else number


def build_record(page_id: int | None, serial: int, url: str | None, payload: bytes,
                 refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record with new headers and digests, as a gzip member."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode("ascii")
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        "WARC-Type: " + ("revisit" if revisit else "response"),
        "WARC-Record-ID: " + record_id(page_id, serial),
        "WARC-Date: " + DATE,
        "Content-Type: application/http; msgtype=response",
        "WARC-Payload-Digest: sha1:" + digest_text(hashlib.sha1(payload).digest()),
        "WARC-Block-Digest: sha1:" + digest_text(hashlib.sha1(block).digest()),
    ]
    if url:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if revisit:
        head += ["WARC-Profile: " + PROFILE, "WARC-Refers-To: " + record_id(refers_to)]
    head.append(f"Content-Length: {len(block)}")
    return member("\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n")


def member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    packed = packer.compress(raw) + packer.flush()
    return packed if packed[-1] == 0 else packed + _EMPTY_MEMBER


def info_record(name: str) -> bytes:
    block = f"format: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
    head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"
            f"\r\nWARC-Date: {DATE}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields"
            f"\r\nContent-Length: {len(block)}\r\n\r\n")
    return member(head.encode("ascii") + block + b"\r\n\r\n")


def file_name(shard: int, roll: int) -> str:
    return f"archive-{shard:06d}-{roll:05d}.warc.gz"


def splitters(pages: DataFrame, shards: int, sample_rows: int) -> list[int]:
    """Ids that cut the order into ``shards`` parts of about equal bytes.

    The sample holds the rows whose hashed id is below a limit, about ``sample_rows`` of
    them whatever the table's size, so it depends on the rows alone.
    """
    if shards < 2:
        return []
    total = pages.count()
    keep = F.pmod(F.xxhash64("p"), F.lit(1 << 30)) < F.lit(min(1 << 30, (sample_rows << 30) // max(total, 1)))
    sample = pages.where(keep).select("p", F.length("payload").alias("n")).toPandas().sort_values(["p", "n"])
    if not len(sample):
        return []
    grown = np.cumsum(sample["n"].to_numpy() + 500)
    at = np.searchsorted(grown, grown[-1] * np.arange(1, shards) / shards)
    return sorted(set(int(x) for x in sample["p"].to_numpy()[at]))


def write_archives(pages: DataFrame, path: str, shard_bytes: int = SHARD_BYTES,
                   file_bytes: int = FILE_BYTES, sample_rows: int = SAMPLE_ROWS,
                   least_revisit: int = LEAST_REVISIT) -> str:
    """Write ``pages`` (page_id, url, html) as archives below ``path``; gives ``path``."""
    spark = pages.sparkSession
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(_LAST)).alias("p"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    size = rows.agg(F.coalesce(F.sum(F.length("payload").cast("long")), F.lit(0))).first()[0]
    cuts = splitters(rows, max(1, -(-size // shard_bytes)), sample_rows)

    @F.pandas_udf("int")
    def shard(p: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(cuts, np.int64), p.to_numpy(), "right").astype(np.int32))

    # Which records revisit: found on digests alone, one row per digest after map-side minimum.
    keys = rows.select("p", F.sha1("payload").alias("digest"), F.length("payload").alias("n")) \
        .where(F.col("n") >= least_revisit)
    first = keys.groupBy("digest").agg(F.min("p").alias("first"), F.max("p").alias("last")).where("last > first")
    marks = keys.select("p", "digest").join(first.drop("last"), "digest").where("p > first").distinct()
    none = F.lit(None)
    todo = marks.select("p", F.unhex("digest").alias("digest"), "first", none.cast("string").alias("url"),
                        none.cast("binary").alias("payload")).unionByName(
        rows.select("p", F.unhex(F.sha1("payload")).alias("digest"), none.cast("long").alias("first"), "url", "payload"))
    placed = todo.withColumn("shard", shard("p")).repartitionById(len(cuts) + 1, "shard").sortWithinPartitions(
        "p", "digest", F.col("first").asc_nulls_last(), "url")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll, filled, serial = -1, file_bytes, 0
        last, mark, written = None, (None, None, None), None
        for batch in batches:
            out: list[tuple[str, bytes]] = []
            held = 0
            for p, digest, first, url, payload, no in zip(*(c.to_pylist() for c in batch.columns)):
                if payload is None:
                    mark = (p, digest, first)
                    continue
                if filled >= file_bytes:
                    roll, filled = roll + 1, 0
                    name = file_name(no, roll)
                    out.append((name, info_record(name)[:-1]))
                page = None if p == _LAST else p
                serial = serial + 1 if last == p else 0
                last = p
                revisit, to = mark[:2] == (p, digest), mark[2]
                if not revisit and written == (p, digest) and len(payload) >= least_revisit:
                    revisit, to = True, p
                written = (p, digest)
                packed = build_record(page, serial, url, payload, None if to == _LAST else to, revisit)
                out.append((name, packed[:-1]))
                filled += len(packed)
                held += len(packed)
                if held > 4 << 20:
                    yield _files(out)
                    out, held = [], 0
            if out:
                yield _files(out)

    made = placed.mapInArrow(build, "file string, value binary")
    temporary = f"{path.rstrip('/')}/_temporary-{uuid.uuid4().hex}"
    made.select(F.col("value").cast("string").alias("value"), "file").write.option(
        "lineSep", "\u0000").partitionBy("file").text(temporary)
    _commit(spark, path, temporary)
    return path


def _files(out: list[tuple[str, bytes]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.binary())],
                           names=["file", "value"])


def _commit(spark: SparkSession, path: str, temporary: str) -> None:
    """Give the files of finished tasks their names, then write the manifest, then rename it."""
    names = spark._jvm.org.apache.hadoop.fs
    root, found = names.Path(path), names.Path(temporary)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = []
    for folder in store.listStatus(found):
        if not folder.isDirectory() or "=" not in folder.getPath().getName():
            continue
        parts = [f for f in store.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
        name = folder.getPath().getName().partition("=")[2]
        if len(parts) != 1 or not store.rename(parts[0].getPath(), names.Path(root, name)):
            raise OSError(f"{name} could not be committed")
        listed.append({"file": name, "bytes": parts[0].getLen()})
    store.delete(found, True)
    draft = names.Path(root, "_manifest.json")
    out = store.create(draft, True)
    out.write(bytearray(json.dumps(sorted(listed, key=lambda x: x["file"])).encode()))
    out.close()
    if not store.rename(draft, names.Path(root, "manifest.json")):
        raise OSError("the manifest could not be committed")


def manifest(spark: SparkSession, path: str) -> list[dict]:
    return json.loads(spark.read.option("wholetext", True).text(f"{path.rstrip('/')}/manifest.json").first()[0])


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an archive's bytes."""
    view, at = memoryview(raw), 0
    while at < len(view):
        parts = []
        unpack = zlib.decompressobj(31)
        while not unpack.eof:
            if at == len(view):
                raise ValueError("an archive ends inside a record")
            piece = view[at:at + _READ_BYTES]
            parts.append(unpack.decompress(piece))
            at += len(piece) - len(unpack.unused_data)
        text = b"".join(parts)
        if not text:
            continue
        head, _, body = text.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("a record without a WARC header")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        if len(body) != length + 4:
            raise ValueError("a record whose length is not what its header says")
        yield fields, body[:length]


_READ = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in the manifest; digests of payloads are checked.

    A revisit has no payload; its payload_bytes and payload_digest are the original's, from
    the headers that it repeats.
    """
    columns = _READ.names if payloads else _READ.names[:-1]
    listed = manifest(spark, path)
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
    kinds += ", payload binary" if payloads else ""
    if not listed:
        return spark.createDataFrame([], kinds)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                rows: list[tuple] = []
                for fields, block in records(raw.as_buffer().to_pybytes()):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    revisit = fields["WARC-Type"] == "revisit"
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.decode("ascii").rpartition("Content-Length: ")[2])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit and digest_text(hashlib.sha1(payload).digest()) != digest:
                        raise ValueError("a payload does not have the digest of its header")
                    to = page_of(fields["WARC-Refers-To"]) if revisit else None
                    rows.append((page_of(fields["WARC-Record-ID"]), size if revisit else len(payload), digest,
                                 fields["WARC-Type"], to, fields.get("WARC-Target-URI"),
                                 None if revisit else payload))
                    if len(rows) >= 2000:
                        yield _batch(rows, columns)
                        rows = []
                if rows:
                    yield _batch(rows, columns)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "archive-*.warc.gz").load(path)
    return files.select("content").mapInArrow(parse, kinds)


def _batch(rows: list[tuple], columns: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([r[i] for r in rows], _READ.field(i).type) for i in range(len(columns))],
                           names=columns)
