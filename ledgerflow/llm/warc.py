"""WARC archives without repeated payloads.

Headers (identifier, payload digests, length) are grouped by payload; of equal
payloads the record with the largest page id is the response, the others
become revisit records that refer to it.  Every task writes its records, with
fresh headers, to gzip archives (one member per record) of bounded size in a
shared folder; only archives named in the manifest of successful tasks count,
so a repeated task does no harm.  Reading back parses the archives, checks
every digest and joins revisits to their responses for length and digest.

Null payloads and URLs are empty.  A null page id is smaller than any other.
Repeated rows (same id and payload) that hold the largest id are all responses;
revisits refer to that id.  Payloads shorter than ``min_bytes`` are responses.
Tables without rows give an archive-less manifest and no records.  Columns
other than ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textops import scratch, stored

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive is closed once it holds so many compressed bytes.
ARCHIVE_BYTES = 64 << 20

_RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()),
                     ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
                     ("refers_to_record", pa.string())])
RECORD = ("record_id string, record_type string, page_id long, url string, payload_digest string, "
          "payload_bytes long, refers_to_record string")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha1_hex: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{sha1_hex}')}>"


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]) + "\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(head.encode() + block + b"\r\n\r\n") + deflate.flush()


def _uri(url: str | None) -> str:
    return quote(url or "", safe="%/:?#[]@!$&'()*+,;=~-._")


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def resolve(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, sha1, original, original_url`` per page; ``html`` is null
    where another page's response has the payload (``original`` is then its id)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html")).withColumn("sha256", F.sha2("html", 256)) \
               .withColumn("bytes", F.octet_length("html").cast("long"))
    # narrow headers, combined before the shuffle: a payload that many pages share is one row per task
    originals = (rows.where(F.col("bytes") >= min_bytes).groupBy("sha1", "sha256")
                 .agg(F.max(F.struct("page_id", "url")).alias("o"))
                 .select("sha1", "sha256", F.col("o.page_id").alias("original"), F.col("o.url").alias("original_url")))
    # on one joined key, which is no exchange of the aggregate's: a payload that very many pages
    # share can be split at run time
    originals = originals.select(F.concat("sha1", "sha256").alias("__payload"), "original", "original_url")
    joined = rows.join(originals, F.concat("sha1", "sha256") == F.col("__payload"), "left")
    own = F.col("original").eqNullSafe(F.col("page_id")) | (F.col("bytes") < min_bytes)
    return joined.select("page_id", "url", "sha1", "bytes", F.when(own, F.col("html")).alias("html"), "original", "original_url")


def write_archives(resolved: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every record; returns the manifest ``archive, records`` (stored)."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    names = ["archive", "records"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _filesystem(folder)
        filesystem.create_dir(path, recursive=True)
        name = f"{path}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        out, size, records, number = None, 0, 0, 0
        done: list[tuple[str, int]] = []
        try:
            for batch in batches:
                for at in range(batch.num_rows):
                    row = {k: batch.column(k)[at].as_py() for k in batch.schema.names}
                    if out is None:
                        file = f"{name}-{number:04d}.warc.gz"
                        out, size, records, number = filesystem.open_output_stream(file, compression=None), 0, 0, number + 1
                    member = _record(row, date)
                    out.write(member)
                    size, records = size + len(member), records + 1
                    if size >= archive_bytes:
                        out.close()
                        out = None
                        done.append((file, records))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((file, records))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=names)

    return stored(resolved.mapInArrow(write, "archive string, records long"), "warc-manifest")


def _record(row: dict, date: str) -> bytes:
    digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
    fields = [("WARC-Record-ID", record_id(row["page_id"], row["sha1"])), ("WARC-Date", date),
              ("WARC-Target-URI", _uri(row["url"])), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if row["page_id"] is not None:
        fields.append(("X-Page-ID", str(row["page_id"])))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    if row["html"] is not None:
        block = http + row["html"].encode()
        return _member([("WARC-Type", "response"), *fields, ("WARC-Block-Digest", f"sha1:{payload_digest(block)}")], block)
    return _member([("WARC-Type", "revisit"), *fields, ("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", record_id(row["original"], row["sha1"])),
                    ("WARC-Refers-To-Target-URI", _uri(row["original_url"]))], http)


def _fields(stream: io.BufferedIOBase) -> dict[str, str]:
    found = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def parse(stream) -> Iterator[dict]:
    """Records of one archive; a digest or length that does not fit raises ValueError."""
    with gzip.GzipFile(fileobj=stream) as unzipped, io.BufferedReader(unzipped, 1 << 20) as data:
        while version := data.readline():
            if not re.match(rb"WARC/1\.[01]\r\n", version):
                raise ValueError(f"not a WARC record: {version[:40]!r}")
            head = _fields(data)
            block = data.read(int(head["content-length"]))
            if len(block) != int(head["content-length"]) or data.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {head.get('warc-record-id')} is cut short")
            payload = block[block.index(b"\r\n\r\n") + 4:]
            digest = head["warc-payload-digest"].removeprefix("sha1:")
            response = head["warc-type"] == "response"
            if response and payload_digest(payload) != digest:
                raise ValueError(f"record {head['warc-record-id']}: payload digest differs")
            page = head.get("x-page-id")
            yield {"record_id": head["warc-record-id"], "record_type": head["warc-type"],
                   "page_id": None if page is None else int(page), "url": head.get("warc-target-uri"),
                   "payload_digest": digest, "payload_bytes": len(payload) if response else None,
                   "refers_to_record": head.get("warc-refers-to")}


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the manifest's archives, read in parallel (an archive is a unit)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows: list[dict] = []
                with filesystem.open_input_stream(archive, compression=None) as stream:
                    for record in parse(stream):
                        rows.append(record)
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, _RECORD)

    files = manifest.select("archive")
    return files.repartition(max(1, manifest.count()), "archive").mapInArrow(read, RECORD)


def with_revisits(records: DataFrame) -> DataFrame:
    """``records`` plus ``refers_to`` (page id); revisits take their length from the response they refer to."""
    responses = records.where("record_type = 'response'")
    key = responses.groupBy("record_id").agg(F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("bytes"),
                                             F.max("payload_digest").alias("digest"))
    # joined on a key that is no exchange of the aggregate's: the revisits of one response can be split
    key = key.withColumn("record_id", F.concat(F.lit("="), "record_id"))
    revisits = (records.where("record_type = 'revisit'").alias("v")
                .join(key.alias("r"), F.concat(F.lit("="), F.col("v.refers_to_record")) == F.col("r.record_id"), "left")
                .select("v.page_id", "v.url", F.col("r.bytes").alias("payload_bytes"),
                        F.coalesce("r.digest", "v.payload_digest").alias("payload_digest"), "v.record_type", "r.refers_to"))
    plain = responses.select("page_id", "url", "payload_bytes", "payload_digest", "record_type",
                             F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(revisits)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as deduplicated archives, read these back, resolve the revisits."""
    folder = scratch(pages.sparkSession, "warc")
    manifest = write_archives(resolve(pages, min_bytes), folder)
    return with_revisits(stored(read_archives(manifest, folder), "warc-records"))
