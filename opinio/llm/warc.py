"""WARC archives: one record per page, and a reader that salvages damaged files.

Writing: rows of equal payload are found by digest; one of them is a ``response``, the others
are ``revisit`` records without payload. Every task writes archives of its own, each record as a
gzip member (or plain), and returns their names; only names of finished tasks are read.

Reading: a member or a plain record is taken if all its checks pass (gzip's own, the header,
lengths, the end mark, digests). After a failed check the reader goes on at the declared
end, if a valid record begins there, or else searches for the next member or version line that
begins a valid record. What lies between is logged as a gap with its bytes and the reason.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.llm.common import stored
from opinio.llm.dedup import split_by_list
from opinio.session import new_path

# Bytes of payload after which a task begins another archive, and bytes read or unpacked at once.
FILE_BYTES = 64 << 20
PIECE = 1 << 20
# Longest header block of a record.
HEADER_BYTES = 1 << 16
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
# What a plain record may begin with: a version line.
LINE = re.compile(rb"WARC/[0-9]\.[0-9]+\r\n")
# Fixed value of the standard: a revisit whose payload equals another's.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
LEVEL = 4


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def in_line(value: str) -> str:
    """A header value in one line: white space and control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", value)


def from_line(value: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def record_bytes(
    key: str | None, url: str | None, payload: bytes | None, digest: str, size: int,
    refers: str | None, number: int, date: str = DATE,
) -> bytes:
    """A record, plain. Without a payload it is a revisit of the record of key ``refers``."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += f"Content-Length: {size}\r\n\r\n".encode()
    if payload is not None:
        block += payload
    named = uuid.uuid5(uuid.NAMESPACE_URL, f"{key}:{number}")
    header = [
        ("WARC-Type", "revisit" if payload is None else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{named}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else in_line(url)),
        ("X-Key", None if key is None else in_line(key)),
        ("WARC-Profile", PROFILE if payload is None else None),
        ("X-Refers-To-Key", None if refers is None else in_line(refers)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
        ("WARC-Block-Digest", f"sha1:{sha1(block)}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in header if v is not None)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def member_of(record: bytes) -> bytes:
    """A record as a gzip member of its own."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


class Damaged(Exception):
    """A check failed; ``end`` is where the record should have ended, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


@dataclass
class Record:
    offset: int
    end: int
    header: dict[str, str]
    payload: bytes


@dataclass
class Gap:
    offset: int
    end: int
    reason: str


class Window:
    """Bytes of a file by place; a few megabytes are kept, whatever the file's size."""

    def __init__(self, source: Any, size: int):
        self.source, self.size = source, size
        self.base, self.held = 0, b""

    def get(self, begin: int, end: int) -> bytes:
        end = min(end, self.size)
        if begin < self.base or end > self.base + len(self.held):
            self.base = begin
            self.held = self.source.read_at(max(end - begin, min(PIECE, self.size - begin)), begin)
        return self.held[begin - self.base : end - self.base]


def headers(block: bytes) -> dict[str, str]:
    found = {}
    for line in block.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line without a colon")
        found[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
    return found


def checked(header: dict[str, str], block: bytes, end: int) -> bytes:
    """The payload of a record whose digests hold."""
    for name, part in (("warc-block-digest", block), ("warc-payload-digest", None)):
        algorithm, _, value = header.get(name, "").partition(":")
        if algorithm.lower() != "sha1" or (part is None and header.get("warc-type") == "revisit"):
            continue  # other algorithms are not checked; a revisit has no payload
        if part is None:
            part = payload_of(header, block)
        if sha1(part) != value.upper():
            raise Damaged(f"{name} differs", end)
    return payload_of(header, block)


def payload_of(header: dict[str, str], block: bytes) -> bytes:
    if header.get("content-type", "").replace(" ", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def length_of(header: dict[str, str]) -> int:
    length = header.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        raise Damaged("no content length")
    return int(length)


def plain_record(window: Window, at: int) -> Record:
    """The plain record at ``at``."""
    start = window.get(at, at + HEADER_BYTES)
    if not LINE.match(start):
        raise Damaged("no version line")
    stop = start.find(b"\r\n\r\n")
    if stop < 0:
        raise Damaged("header without an end")
    header = headers(start[:stop])
    begin = at + stop + 4
    end = begin + length_of(header)
    if end + 4 > window.size:
        raise Damaged("record longer than the file")
    rest = window.get(begin, end + 4)
    if rest[-4:] != b"\r\n\r\n":
        raise Damaged("no end mark after the block")
    return Record(at, end + 4, header, checked(header, rest[:-4], end + 4))


def packed_record(window: Window, at: int) -> Record:
    """The record in the gzip member at ``at``. Unpacking stops where the record is too long."""
    unpacker = zlib.decompressobj(31)
    place, whole, most = at, bytearray(), None
    header, stop = None, -1
    while not unpacker.eof:
        piece = unpacker.unconsumed_tail or window.get(place, place + HEADER_BYTES)
        if not piece:
            raise Damaged("member without an end")
        if not unpacker.unconsumed_tail:
            place += len(piece)
        try:
            whole += unpacker.decompress(piece, PIECE)
        except zlib.error:
            raise Damaged("member does not unpack") from None
        if header is None:
            stop = whole.find(b"\r\n\r\n")
            if stop >= 0:
                if not LINE.match(whole):
                    raise Damaged("no version line")
                header = headers(bytes(whole[:stop]))
                most = stop + 4 + length_of(header) + 4
            elif len(whole) > HEADER_BYTES:
                raise Damaged("header without an end")
        if most is not None and len(whole) > most:
            raise Damaged("more than the record in a member")
    end = place - len(unpacker.unused_data)
    if header is None:
        raise Damaged("header without an end", end)
    if len(whole) != most or whole[-4:] != b"\r\n\r\n":
        raise Damaged("no end mark after the block", end)
    return Record(at, end, header, checked(header, bytes(whole[stop + 4 : -4]), end))


def record_at(window: Window, at: int) -> Record:
    if window.get(at, at + len(MEMBER)) == MEMBER:
        return packed_record(window, at)
    return plain_record(window, at)


def begins(window: Window, at: int) -> Iterator[int]:
    """Places from ``at`` on that look like a member or a version line."""
    overlap = 16
    while at < window.size:
        some = window.get(at, at + PIECE)
        for found in re.finditer(rb"\x1f\x8b\x08|WARC/[0-9]\.[0-9]+\r\n", some):
            if at + found.start() < at + len(some) - overlap or at + len(some) >= window.size:
                yield at + found.start()
        if at + len(some) >= window.size:
            return
        at += len(some) - overlap


def salvage(window: Window) -> Iterator[Record | Gap]:
    """All valid records of a file in order, and the gaps between them."""
    at = 0
    while at < window.size:
        try:
            found = record_at(window, at)
            at = found.end
            yield found
            continue
        except Damaged as damage:
            reason, declared = str(damage), damage.end
        # if only the content is damaged, the next record is where this one says
        following = None
        for place in ([declared] if declared else []):
            if place == window.size:
                following = place
                break
            try:
                record_at(window, place)
                following = place
            except Damaged:
                pass
        if following is None:
            following = window.size
            for place in begins(window, at + 1):
                try:
                    record_at(window, place)
                except Damaged:
                    continue
                following = place
                break
        yield Gap(at, following, reason)
        at = following


@dataclass(frozen=True)
class Archive:
    """A folder of archives and the table of those that finished tasks have written."""

    files: DataFrame
    path: str


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, also for ``file:/x`` as Spark spells it."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return pafs.LocalFileSystem(), path


def with_digests(pages: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """``(key, url, payload, digest, size, check, uid)``; a NULL payload is empty.

    ``check`` is a second hash, so that a forged SHA-1 alone makes no two payloads equal.
    """
    binary = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    plain = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), binary.alias("payload"))
    schema = plain.select("*", F.lit("").alias("digest")).schema

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([sha1(value.as_buffer()) for value in batch.column(2)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], names=schema.names)

    return plain.mapInArrow(per_batch, schema).select(
        "*",
        F.octet_length("payload").cast("bigint").alias("size"),
        F.xxhash64("payload").alias("check"),
        F.monotonically_increasing_id().alias("uid"),
    )


SAME = ("digest", "size", "check")


def write_archives(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 0,
    packed: bool = True,
) -> Archive:
    """Writes a record for every row of ``pages`` into archives under ``path``.

    Of rows with equal payloads of at least ``least`` bytes the one of smallest key (NULL keys
    last, of equal keys one) is the response, the others refer to it. A NULL payload is empty,
    a NULL key or URL leaves its header out, repeated rows each have a record, other columns are
    ignored. Responses stay in their tasks unless a Bloom filter of the revisits names
    them; revisits move without payload.
    """
    rows = stored(with_digests(pages, key, url, payload), "payloads")
    narrow = rows.drop("payload")
    first = F.struct(F.col("key").isNull().alias("none"), "key", "uid")
    repeated = (
        narrow.where(F.col("size") >= least)
        .groupBy(*SAME)
        .agg(F.min(first).alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select(*SAME, "first")
    )
    # one row for each repeated payload meets narrow rows; adaptive execution splits a hot payload
    revisits = stored(
        narrow.join(repeated, list(SAME)).where(F.col("uid") != F.col("first.uid")).select(
            "key", "url", "digest", "size", "uid", F.col("first.key").alias("refers")
        ),
        "revisits",
    )
    maybe, single = split_by_list(rows, revisits.select("uid"))
    names = ["key", "url", "payload", "digest", "size", "uid"]
    keys = rows.schema["key"].dataType
    responses = single.select(*names).unionByName(
        maybe.join(revisits.select("uid"), "uid", "left_anti").select(*names)
    )
    records = responses.withColumn("refers", F.lit(None).cast(keys)).unionByName(
        revisits.withColumn("payload", F.lit(None).cast("binary")).select(*names, "refers")
    )
    spelled = records.withColumns({c: F.col(c).cast("string") for c in ("key", "refers")})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        store.create_dir(folder, recursive=True)
        out, made, written = None, [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                k, u, body, digest, size, number, refers = (batch.column(j)[i].as_py() for j in range(7))
                if out is None:
                    # a name of its own for every attempt: a lost task's files are never listed
                    name = f"{folder}/{uuid.uuid4().hex}.warc{'.gz' if packed else ''}"
                    out, written = store.open_output_stream(name, compression=None), 0
                    made.append([name.rsplit("/", 1)[1], 0, 0])
                record = record_bytes(k, u, body, digest, size, refers, number)
                done = member_of(record) if packed else record
                out.write(done)
                written += len(record)
                made[-1][1] += 1
                made[-1][2] += len(done)
                if written >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array(column) for column in zip(*made)], names=["file", "n_records", "n_bytes"]
            )

    files = spelled.select(*names, "refers").mapInArrow(write, "file string, n_records bigint, n_bytes bigint")
    return Archive(stored(files, "archives"), path)


RECORD_SCHEMA = (
    "file string, offset bigint, end bigint, reason string, record_type string, key string, "
    "url string, payload_digest string, payload_bytes bigint, refers_to string, payload binary"
)


def read_archives(archive: Archive, payloads: bool = True) -> DataFrame:
    """One row for each record and each gap in the archives, by ``(file, offset)``.

    A gap has a ``reason`` and nothing but its place. ``payload_digest`` (base32 SHA-1) and
    ``payload_bytes`` are those of the full payload: of a response as read, of a revisit as its
    header tells. Without ``payloads`` the column of that name is NULL. Empty files have no row.
    """
    path = archive.path
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]

    def row_of(name: str, found: Record | Gap) -> list[Any]:
        if isinstance(found, Gap):
            return [name, found.offset, found.end, found.reason, *[None] * 7]
        header = found.header
        of_revisit = header.get("warc-type") == "revisit"
        size = header.get("x-payload-length", "")

        def text(field_name: str) -> str | None:
            value = header.get(field_name)
            return None if value is None else from_line(value)

        return [
            name, found.offset, found.end, None, header.get("warc-type"), text("x-key"),
            text("warc-target-uri"),
            header.get("warc-payload-digest", "").partition(":")[2] or None if of_revisit else sha1(found.payload),
            (int(size) if size.isdigit() else None) if of_revisit else len(found.payload),
            text("x-refers-to-key"),
            found.payload if payloads and not of_revisit else None,
        ]

    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(f"{folder}/{name}") as source:
                    waiting, held = [], 0
                    for found in salvage(Window(source, source.size())):
                        waiting.append(row_of(name, found))
                        held += found.end - found.offset + len(getattr(found, "payload", b""))
                        if held >= PIECE:
                            yield batch_of(waiting)
                            waiting, held = [], 0
                    if waiting:
                        yield batch_of(waiting)

    def batch_of(rows: list[list[Any]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows), types)], names=names
        )

    files = archive.files.select("file")
    # a task a file: each is at most FILE_BYTES and its last record
    return files.repartitionByRange(max(1, files.count()), "file").mapInArrow(read, RECORD_SCHEMA)


def archive_round_trip(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0
) -> DataFrame:
    """Writes the archives to the shared folder and reads them back, payloads left out."""
    spark: SparkSession = pages.sparkSession
    archive = write_archives(pages, new_path(spark, "warc"), key, url, payload, least)
    kind = pages.schema[key].dataType

    def typed(name: str) -> Column:
        return F.col(name).cast(kind)

    return read_archives(archive, payloads=False).where(F.col("reason").isNull()).select(
        typed("key").alias("key"), "url", "record_type", "payload_digest", "payload_bytes",
        typed("refers_to").alias("refers_to"),
    )
