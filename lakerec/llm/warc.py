"""WARC archives of pages, and their deduplication by revisit records.

1. ``write_archives`` writes every page as a ``response`` record, a gzip member each, and gives one header row per
   record: where it lies, its id, payload digest and length.
2. ``resolve`` shuffles the headers by payload digest. The record with the least page id of each digest (ties: the
   first in file order) stays a response; the others are joined with it as its revisits. The least record is found by
   a reduction before the shuffle, so a payload that a third of the pages share is a few rows per task; the join
   is one that adaptive execution splits.
3. ``deduplicate`` reads the archives file by file at the records' places and writes new ones with fresh headers: full
   responses, and for the rest revisit records that name the original (``WARC-Refers-To``, its target and date) and
   keep the page's own HTTP header without the payload.
4. ``read_archives`` parses archives. A payload's length and digest are taken from the payload where there is one,
   checked against the header, and from the header of a revisit.

Payloads are never shuffled; only headers are. Files are written whole or not at all (see ``shards``), with names and
content that a repeated task gives again. Defined cases: a null html is an empty payload; a null url is ``urn:none``; line
breaks in a url are percent-encoded; a null page id sorts last and is read back as null; repeated rows are records
of their own, of which one stays a response; payloads of fewer than ``least_bytes`` bytes are always responses. Extra
columns are not read. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakerec.llm.shards import reading, writing
from lakerec.session import stored

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2000-01-01T00:00:00Z"  # the tables carry no capture time
ROLL = 64 << 20
HEADERS = "file string, offset bigint, page_id bigint, uri string, payload_bytes bigint, payload_digest string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, place: str) -> str:
    """A page's record id, or for a page without one an id made of the record's place."""
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:x-place:{place}>"


def page_of(identifier: str) -> int | None:
    kind, _, value = identifier.strip("<>").removeprefix("urn:").partition(":")
    return int(value) if kind == "x-page" else None


def http_header(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member with a fixed time, so equal records are equal bytes."""
    lines = [VERSION] + [f"{name}: {value}".encode() for name, value in fields]
    lines.append(f"Content-Length: {len(block)}".encode())
    return gzip.compress(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n", compresslevel=6, mtime=0)


def response(page_id: int | None, place: str, uri: str, payload: bytes, digest: str) -> bytes:
    fields = [
        ("WARC-Type", "response"),
        ("WARC-Record-ID", record_id(page_id, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(fields, http_header(len(payload)) + payload)


def revisit(page_id: int | None, place: str, uri: str, length: int, digest: str, origin: str, origin_uri: str) -> bytes:
    fields = [
        ("WARC-Type", "revisit"),
        ("WARC-Record-ID", record_id(page_id, place)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Profile", PROFILE),
        ("WARC-Refers-To", origin),
        ("WARC-Refers-To-Target-URI", origin_uri),
        ("WARC-Refers-To-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record(fields, http_header(length))


def parse(member: bytes) -> tuple[dict[str, str], bytes, dict[str, str], bytes]:
    """A record's fields, its HTTP header lines, and the payload, from the bytes of one record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = dict(line.decode().split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record is cut off")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, block, dict(line.decode().split(": ", 1) for line in http.split(b"\r\n")[1:]), payload


def members(file: pa.NativeFile, block: int = 1 << 20) -> Iterator[bytes]:
    """The records of a file from its position on, one at a time."""
    pending = b""
    while True:
        unpack = zlib.decompressobj(wbits=31)
        parts = []
        while not unpack.eof:
            if not pending:
                pending = file.read(block)
                if not pending:
                    if parts:
                        raise ValueError("an archive is cut off")
                    return
            parts.append(unpack.decompress(pending))
            pending = unpack.unused_data
        yield b"".join(parts)


class _Archive:
    """Archives of one partition, one after the other."""

    def __init__(self, folder: str, stem: str):
        self.folder, self.stem, self.count, self.context = folder, stem, 0, None

    def place(self) -> tuple[str, int]:
        """File and offset of the record that comes next."""
        if self.context is None:
            self.name, self.size = f"{self.stem}-{self.count:05d}.warc.gz", 0
            self.context = writing(self.folder, self.name)
            self.file = self.context.__enter__()
        return self.name, self.size

    def add(self, data: bytes) -> None:
        self.file.write(data)
        self.size += len(data)
        if self.size >= ROLL:
            self.close()

    def close(self) -> None:
        if self.context is not None:
            self.context.__exit__(None, None, None)
            self.context, self.count = None, self.count + 1


def _header_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in HEADERS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages (page_id, url, html)``; the header rows, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(folder, f"pages-{TaskContext.get().partitionId():06d}")
        for batch in batches:
            rows = []
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                payload = (html or "").encode()
                uri = (url or "urn:none").replace("\r", "%0D").replace("\n", "%0A")
                digest = digest_of(payload)
                name, offset = archive.place()
                archive.add(response(page_id, f"{name}:{offset}", uri, payload, digest))
                rows.append((name, offset, page_id, uri, len(payload), digest))
            if rows:
                yield _header_rows(rows)
        archive.close()

    source = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return stored(source.mapInArrow(run, HEADERS), "headers")


def resolve(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``headers`` with ``origin``: of a revisit the page id, file, offset and uri of its response; else null."""
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "offset", "uri")
    shared = headers.where(F.col("payload_bytes") >= least_bytes)
    first = shared.groupBy(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes")).agg(
        F.min(key).alias("first"), F.count("*").alias("n")
    )
    match = (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes"))
    joined = headers.join(first.where("n > 1"), match, "left")
    own = (F.col("file") == F.col("first.file")) & (F.col("offset") == F.col("first.offset"))
    origin = F.when(F.col("first").isNotNull() & ~own, F.col("first"))
    return joined.select(*headers.columns, origin.alias("origin"))


def deduplicate(resolved: DataFrame, folder: str, target: str) -> DataFrame:
    """Write the records of ``folder`` that ``resolved`` lists to ``target``; ``(file, records)`` of the new archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, source, opened, records = None, None, None, 0
        done: list[tuple] = []

        def finish() -> None:
            if archive is not None:
                archive.close()
                opened.__exit__(None, None, None)
                done.extend((f"{archive.stem}-{i:05d}.warc.gz", records if i == 0 else 0) for i in range(archive.count))

        for batch in batches:
            for row in batch.to_pylist():
                if source != row["file"]:
                    finish()
                    source, records = row["file"], 0
                    archive = _Archive(target, source.removesuffix(".warc.gz"))
                    opened = reading(folder, source)
                    file = opened.__enter__()
                name, offset = archive.place()
                place, origin = f"{name}:{offset}", row["origin"]
                if origin is None:
                    file.seek(row["offset"])
                    _, _, _, payload = parse(next(members(file)))
                    if digest_of(payload) != row["payload_digest"]:
                        raise ValueError("a payload is damaged")
                    archive.add(response(row["page_id"], place, row["uri"], payload, row["payload_digest"]))
                else:
                    first = record_id(origin["page_id"], f"{origin['file']}:{origin['offset']}")
                    archive.add(
                        revisit(
                            row["page_id"], place, row["uri"], row["payload_bytes"], row["payload_digest"],
                            first, origin["uri"],
                        )
                    )
                records += 1
        finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([d[0] for d in done]), pa.array([d[1] for d in done], pa.int64())], names=["file", "records"]
            )

    resolved = stored(resolved, "resolved")
    files = resolved.select("file").distinct().count()
    # A file is a task's work: its headers are small, its payloads are not.
    ordered = resolved.repartitionByRange(max(1, files), "file").sortWithinPartitions("file", "offset")
    return stored(ordered.mapInArrow(run, "file string, records bigint"), "archives")


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, uri string"


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """A row per record of the files that ``archives (file)`` lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with reading(folder, name) as file:
                    for member in members(file):
                        fields, _, http, payload = parse(member)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(http["Content-Length"])
                        kind = fields["WARC-Type"]
                        if kind == "response" and (len(payload) != length or digest_of(payload) != digest):
                            raise ValueError("a payload is damaged")
                        origin = fields.get("WARC-Refers-To")
                        rows.append(
                            (page_of(fields["WARC-Record-ID"]), length, digest, kind)
                            + (page_of(origin) if origin else None, fields["WARC-Target-URI"])
                        )
                        if len(rows) >= 10_000:
                            yield _read_rows(rows)
                            rows = []
                if rows:
                    yield _read_rows(rows)

    spread = archives.select("file").repartitionByRange(max(1, archives.count()), "file")
    return spread.mapInArrow(run, _READ)


def _read_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in _READ.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
