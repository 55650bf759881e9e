"""Writing pages as sharded WARC archives, deterministically, and reading them back.

Records are dealt to shards by ranges of their page id, sorted, and written as gzip members to files
that roll at a compressed size. Bounds of the ranges come from a bounded sample that the data alone
decide, identifiers from ids and digests, and dates are a parameter, so that the same pages give the
same bytes whatever the cluster.

A task writes under a temporary name of its own, and its row of the manifest counts only if the task
does; then the files named there get their names, the manifest itself is written last, and what other
attempts have left is removed. Readers go by the manifest alone.

Of equal payloads of at least ``least_bytes`` the record with the largest page id is the response, the
others are revisits of it, without the payload.

Defined results: a null payload counts as empty; a null page id or URL is left out of the headers, and
a null id is smaller than any other; of repeated rows with the response's id one is the response;
control characters and blanks in URLs are percent-encoded; an empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashloom.llm.storage import drop_path, hash_sample, new_path, stored

#: Payload bytes of a shard, before compression; compressed bytes after which a file is full.
SHARD_BYTES, ROLL_BYTES = 32 << 20, 64 << 20
#: Keys from which the bounds of shards are chosen: so many for each shard, and in all at least. They are
#: sorted on the driver, so a table of very many shards asks for larger ones.
SHARD_KEYS, SAMPLE_KEYS = 8, 20_000
#: Names that Hadoop has for stores which Arrow opens under another.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, temporary string, shard int, records long, bytes long, sha1 string"
RECORDS = "page_id long, url string, record_type string, record_id string, refers_to long, payload_bytes long, payload_digest string"


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder that all tasks reach, and the folder in it: file, hdfs, s3 (s3a, s3n), gs, abfs(s)."""
    scheme, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}{mark}{rest}")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, payload_digest: str, again: int = 0) -> str:
    """The identifier of a page's record; ``again`` counts repeated rows."""
    name = f"page:{page_id}:{payload_digest}:{again}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _member(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    lines = [f"{name}: {value}" for name, value in [*headers, ("WARC-Block-Digest", f"sha1:{digest(block)}"), ("Content-Length", str(len(block)))] if value is not None]
    data = "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def info_member(name: str, date: str) -> bytes:
    block = b"software: cashloom\r\nformat: WARC File Format 1.1\r\n"
    headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _member(headers, block)


def page_member(page_id: int | None, url: str | None, payload: bytes, refers_to: tuple[int | None] | None, again: int, date: str) -> bytes:
    """A response, or with ``refers_to`` (the response's page id) a revisit: the same without payload."""
    payload_digest = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    shown = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    headers: list[tuple[str, str | None]] = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", record_id(page_id, payload_digest, again)),
        ("WARC-Date", date),
        ("WARC-Target-URI", shown),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("X-Page-ID", None if page_id is None else str(page_id)),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if refers_to:
        target = refers_to[0]
        headers += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(target, payload_digest)),
            ("X-Refers-To-Page-ID", None if target is None else str(target)),
        ]
    return _member(headers, http if refers_to else http + payload)


@dataclass
class Archive:
    """The open file of a shard."""

    store: fs.FileSystem
    folder: str
    shard: int
    number: int
    date: str

    def __post_init__(self) -> None:
        self.name = f"pages-{self.shard:06d}-{self.number:04d}.warc.gz"
        self.temporary = f"{self.name}.{uuid.uuid4().hex}.tmp"
        self.file = self.store.open_output_stream(f"{self.folder}/temporary/{self.temporary}", compression=None)
        self.sha1, self.bytes, self.records = hashlib.sha1(), 0, 0
        self.add(info_member(self.name, self.date))
        self.records = 0

    def add(self, member: bytes) -> None:
        self.file.write(member)
        self.sha1.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.file.close()
        return self.name, self.temporary, self.shard, self.records, self.bytes, self.sha1.hexdigest()


def _bounds(keys: DataFrame, count: int, shards: int) -> list[tuple[int, int]]:
    """Keys at which a new shard starts, from those sampled by their hash; a repeated key with the bytes of all its rows."""
    size = max(SAMPLE_KEYS, SHARD_KEYS * shards)
    some = hash_sample(keys, ["page_key", "tie"], count, size)
    some = some.groupBy("page_key", "tie").agg(F.sum("payload_bytes").alias("payload_bytes"))
    rows = some.orderBy(F.xxhash64("page_key", "tie"), "page_key", "tie").limit(size).collect()
    rows = sorted((r["page_key"], r["tie"], r["payload_bytes"]) for r in rows)
    ends = np.cumsum([r[2] + 1 for r in rows])
    wanted = [ends[-1] * k / shards for k in range(1, shards)] if rows else []
    at = sorted({int(i) + 1 for i in np.searchsorted(ends, wanted)})
    return [rows[i][:2] for i in at if i < len(rows)]


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
) -> DataFrame:
    """Writes ``pages`` below ``folder`` (a URI all tasks reach); gives the manifest."""
    spark = pages.sparkSession
    payload = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    source = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    keyed = source.select(
        "*",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_sha1"),
        F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_key"),
        F.xxhash64("url", "payload").alias("tie"),
    )
    light = stored(keyed.drop("url", "payload"), "page-keys")
    groups = light.groupBy(F.col("payload_sha1").alias("s"), F.col("payload_bytes").alias("b")).agg(
        F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n")
    )
    groups = groups.where((F.col("n") > 1) & (F.col("b") >= least_bytes))
    count, total = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("payload_bytes"), F.lit(0))).first()
    bounds = _bounds(light, count, max(1, -(-total // shard_bytes)))

    @F.pandas_udf("int")
    def shard_of(page_key: pd.Series, tie: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(bounds, key) for key in zip(page_key, tie)], dtype="int32")

    # groups of one page are left out, so that this side is small where few pages agree
    typed = keyed.join(stored(groups, "equal-payloads"), (F.col("payload_sha1") == F.col("s")) & (F.col("payload_bytes") == F.col("b")), "left")
    typed = typed.select(
        "page_id", "url", "payload", "page_key", "tie", F.col("n").isNotNull().alias("shared"), "response_id",
        shard_of("page_key", "tie").alias("shard"),
    )
    shards = len(bounds) + 1
    sorted_rows = typed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_key", "tie", "url")
    store, path = _store(folder)
    store.create_dir(f"{path}/temporary", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, place = _store(folder)
        archive: Archive | None = None
        done: list[tuple] = []
        last, again = None, 0
        for batch in batches:
            payloads = (value.as_py() for value in batch.column("payload"))
            light = (batch.column(n).to_pylist() for n in ("page_id", "url", "shared", "response_id", "shard"))
            for data, page, link, shared, response, shard in zip(payloads, *light):
                if archive is None or archive.shard != shard or archive.bytes >= roll_bytes:
                    number = 0
                    if archive is not None:
                        number = archive.number + 1 if archive.shard == shard else 0
                        done.append(archive.close())
                    archive = Archive(target, place, shard, number, date)
                key = (page, hashlib.sha1(data).digest(), len(data))
                again = again + 1 if key == last else 0
                last = key
                revisit = shared and (page != response or again > 0)
                archive.add(page_member(page, link, data, (response,) if revisit else None, again, date))
        if archive is not None:
            done.append(archive.close())
        columns = list(zip(*done)) or [[]] * 6
        types = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["name", "temporary", "shard", "records", "bytes", "sha1"])

    written = stored(sorted_rows.mapInArrow(write, MANIFEST), "written-archives")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, place = _store(folder)
        for batch in batches:
            for name, temporary in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                old, new = f"{place}/temporary/{temporary}", f"{place}/{name}"
                # a task that runs again finds some files named already
                if target.get_file_info(old).type != fs.FileType.NotFound:
                    target.move(old, new)
            yield batch

    written.mapInArrow(rename, MANIFEST).drop("temporary").write.parquet(f"{folder}/manifest")
    drop_path(spark, f"{folder}/temporary")
    return spark.read.parquet(f"{folder}/manifest")


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The records of a compressed archive, one gzip member each."""
    rest, unpack, parts = b"", zlib.decompressobj(31), []
    while data := rest or stream.read(chunk):
        parts.append(unpack.decompress(data))
        rest = b""
        if unpack.eof:
            yield b"".join(parts)
            rest, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def parsed(record: bytes) -> dict | None:
    """The fields of a page's record, with its digests checked; None for other records."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or headers["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"record {headers.get('WARC-Record-ID')} is damaged")
    if headers["WARC-Type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    claimed = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if headers["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != claimed):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-ID"),
        "url": headers.get("WARC-Target-URI"),
        "record_type": headers["WARC-Type"],
        "record_id": headers["WARC-Record-ID"],
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload_bytes": size,
        "payload_digest": claimed,
        "payload": payload if headers["WARC-Type"] == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """One row per record of the archives in the manifest below ``folder``; a file is one task's."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("name")
    names = manifest.repartition(max(1, manifest.count()), "name")
    schema = RECORDS + ", payload binary" * payloads
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()] + [pa.binary()] * payloads
    columns = [f.strip().split(" ")[0] for f in schema.split(",")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, place = _store(folder)

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(columns, kinds)], columns)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[dict] = []
                held = 0
                with target.open_input_stream(f"{place}/{name}", compression=None) as stream:
                    for record in members(stream):
                        if row := parsed(record):
                            rows.append(row)
                            held += len(record) if payloads else 400
                        if held >= 4 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                yield batch_of(rows)

    return names.mapInArrow(read, schema)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives in the shared one."""
    path = new_path(spark, "archives")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
