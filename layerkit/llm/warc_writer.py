"""Deterministic sharded WARC writer and reader.

1. Splitters: the pages with the smallest hashes (a bottom-k sample, the
   same for the same rows) are sorted, and splitters are taken at equal steps.
   A splitter is an id and a hash, so even one id with many rows is split.
2. Pages are exchanged by splitter range and sorted within it. Each task
   writes one gzip member per record and starts a new file once the
   compressed size reaches ``roll_bytes``.
3. Headers, record ids, dates and digests are generated from the page alone,
   so the same pages give the same bytes.
4. A file is written under a temporary name and renamed when complete; a
   repeated task replaces it with the same bytes. The manifest, written last
   by Spark's own committer, names the files that count; readers open only
   those and check their digests.

Files are opened through ``pyarrow.fs`` by URI, so the output folder can be
on any store that pyarrow knows (file, hdfs, s3, gs); it must be shared by
all executors. Reading uses Spark's binaryFile source.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_count, stored, text_of

MANIFEST_SCHEMA = "file string, shard int, records long, compressed_bytes long, sha256 string"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
HTTP_TYPE = "application/http; msgtype=response"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _urn(*parts: object) -> str:
    digest = hashlib.sha256("\n".join("" if p is None else str(p) for p in parts).encode("utf-8", "surrogatepass")).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def _uri(url: str | None) -> str:
    """The address with blanks and control characters percent-encoded; about:blank for none."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def _record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, first: tuple[int, str | None] | None) -> bytes:
    """A response record, or a revisit one that refers to page ``first``."""
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first else http + payload
    headers: list[tuple[str, object]] = [
        ("WARC-Type", "revisit" if first else "response"), ("WARC-Record-ID", _urn(page_id, url, digest)),
        ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)), ("Page-Id", page_id)]
    if first:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _urn(first[0], first[1], digest)),
                    ("WARC-Refers-To-Target-URI", _uri(first[1])), ("Refers-To-Page-Id", first[0])]
    headers += [("WARC-Payload-Digest", f"sha256:{digest}"),
                ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", HTTP_TYPE)]
    return _record(headers, block)


def _member(record: bytes, level: int) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)  # gzip header without name or time
    return pack.compress(record) + pack.flush()


def _info(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _urn("warcinfo", name)), ("WARC-Date", DATE),
                    ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], block)


def _write(folder: str, roll_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _place(folder)
        held, size, records, shard, number = [], 0, 0, None, 0

        def roll() -> pa.RecordBatch:
            name = f"pages-{shard:06d}-{number:05d}.warc.gz"
            data = b"".join([_member(_info(name), level), *held])
            temporary = f"{base}/temporary/{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(temporary) as f:
                f.write(data)
            store.move(temporary, f"{base}/archives/{name}")
            return pa.RecordBatch.from_pydict({
                "file": [name], "shard": pa.array([shard], pa.int32()), "records": [records],
                "compressed_bytes": [len(data)], "sha256": [hashlib.sha256(data).hexdigest()]})

        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                if held and (row["shard"] != shard or size >= roll_bytes):
                    yield roll()
                    number = number + 1 if row["shard"] == shard else 0
                    held, size, records = [], 0, 0
                shard = row["shard"]
                first = None if row["first_id"] is None else (row["first_id"], row["first_url"])
                held.append(_member(page_record(row["page_id"], row["url"], row["html"].encode(), first), level))
                size, records = size + len(held[-1]), records + 1
        if held:
            yield roll()
    return run


def _splitters(keys: DataFrame, shards: int, per_shard: int) -> list[tuple]:
    """Sorted (id, tie) pairs; at most ``shards * per_shard`` rows are gathered for them."""
    # not by the tie hash itself: it is part of the splitters
    sample = keys.orderBy(F.xxhash64(F.lit(1), "page_id", "tie"), "page_id", "tie").limit(shards * per_shard).collect()
    rows = sorted((r["page_id"], r["tie"]) for r in sample)
    return [rows[i * len(rows) // shards] for i in range(1, shards)] if rows else []


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   revisit_bytes: int = 100, shards: int | None = None, roll_bytes: int = 16 << 20, level: int = 6) -> DataFrame:
    """Write one WARC record per page below ``folder``; returns the manifest.

    Of pages with equal payloads of at least ``revisit_bytes`` bytes, the one
    with the smallest id is written as response, the others as revisit
    records of it.

    * A null payload is empty; a null url is written as about:blank; blanks
      and control characters in a url are percent-encoded.
    * A page without id has a record without Page-Id. It revisits a page with
      an id; payloads that only such pages carry are all responses.
    * Rows that repeat id and payload of a response are responses too.
    * No pages give an empty manifest and no files. Extra columns are
      ignored, whatever their names.

    ``shards`` follows the session's shuffle partitions, so a task holds one
    shard's share and, in memory, one file of ``roll_bytes``.
    """
    spark = pages.sparkSession
    shards = shards or shuffle_count(spark)
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_of(F.col(payload_col).cast("string")).alias("html"))
    sha = F.sha2("html", 256)
    large = base.filter(F.octet_length("html") >= revisit_bytes).select("page_id", "url", sha.alias("same"))
    firsts = stored(large.groupBy("same").agg(F.count("*").alias("n"), F.min(F.when(
        F.col("page_id").isNotNull(), F.struct(F.col("page_id").alias("first_id"), F.col("url").alias("first_url")))).alias("f"))
        .filter("n > 1 and f is not null").select("same", "f.first_id", "f.first_url"), "first-pages")
    id_key, tie = F.coalesce("page_id", F.lit(-(1 << 63))), F.xxhash64("page_id", "url", "html")
    keys = base.select(id_key.alias("page_id"), tie.alias("tie"))
    cuts = _splitters(keys, shards, per_shard=32)

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((bisect_right(cuts, k) for k in zip(page_id, tie)), np.int32, len(page_id)))

    revisit = (F.octet_length("html") >= revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    marked = (base.withColumn("same_", sha).join(firsts, F.col("same_") == F.col("same"), "left")
              .withColumn("tie", tie).withColumn("shard", shard_of(id_key, F.col("tie")))
              .select("shard", "tie", "page_id", "url", "html",
                      *(F.when(revisit, F.col(c)).alias(c) for c in ("first_id", "first_url"))))
    sorted_pages = marked.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_id", "tie")
    store, path = _place(folder)
    for part in ("temporary", "archives"):
        store.create_dir(f"{path}/{part}", recursive=True)
    manifest = f"{folder}/manifest"
    sorted_pages.mapInArrow(_write(folder, roll_bytes, level), MANIFEST_SCHEMA).write.json(manifest)
    return spark.read.schema(MANIFEST_SCHEMA).json(manifest)


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of a .warc.gz file."""
    f = gzip.GzipFile(fileobj=io.BytesIO(data))
    while version := f.readline():
        if version.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {version[:40]!r}")
        headers = {}
        while (line := f.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().partition(":")
            headers[name.lower()] = value.strip()
        block = f.read(int(headers["content-length"]))
        if f.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _read_file(data: bytes, payload: bool) -> Iterator[tuple]:
    for headers, block in parse_archive(data):
        kind = headers["warc-type"]
        if kind == "warcinfo":
            continue
        http, _, body = block.partition(b"\r\n\r\n")
        digest = headers["warc-payload-digest"].removeprefix("sha256:")
        if headers["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}" or (
                kind == "response" and hashlib.sha256(body).hexdigest() != digest):
            raise ValueError(f"record {headers['warc-record-id']} does not match its digest")
        length = int(re.search(rb"(?i)\r\ncontent-length: *([0-9]+)", http)[1])
        page, first = headers.get("page-id"), headers.get("refers-to-page-id")
        yield (int(page) if page else None, headers["warc-target-uri"], headers["warc-record-id"], length, digest, kind,
               int(first) if first else None, body if payload and kind == "response" else None)


RECORD_SCHEMA = ("page_id long, url string, record_id string, payload_bytes long, payload_digest string, "
                 "record_type string, refers_to long, payload binary")
RECORD_TYPES = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())


def _read(payload: bool):
    names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), RECORD_TYPES)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, sha in zip(b.column(0), b.column(1)):
                data = content.as_py()
                if hashlib.sha256(data).hexdigest() != sha.as_py():
                    raise ValueError("an archive does not match the manifest")
                rows = []
                for row in _read_file(data, payload):
                    rows.append(row)
                    if len(rows) == 256:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)
    return run


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives that the manifest below ``folder`` names.

    payload_bytes and payload_digest are those of the full payload: computed
    and checked for responses, as recorded for revisits. ``payload`` is null
    for revisits, and for all records if it isn't asked for. A file or a
    record that differs from its digest fails the read.
    """
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/manifest").select("file", "sha256")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(f"{folder}/archives")
             .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))
    # archives are never more than the manifest's files and leftovers of failed runs; the file bytes stay where they are
    return files.join(manifest, "file").select("content", "sha256").mapInArrow(_read(payload), RECORD_SCHEMA)
