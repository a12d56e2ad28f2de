"""Web archives in ZIP packages: written in parallel, read by ranges without extraction.

A package holds stored (uncompressed) members: ``archive/data.warc.gz``, each
record a gzip member of its own, and ``indexes/index.cdxj``, a line for each
record.  The reader fetches the end of the file, finds the central directory
(in ZIP64 form where a package is large), takes from it where the members
begin, reads the index member and then only the bytes of the records asked
for.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayer.sources import scratch_folder

from .shared import cut, ship

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: A task begins a new package when one has so many bytes.
PACKAGE_BYTES = 256 << 20
#: Records next to each other are fetched together up to so many bytes.
RANGE_BYTES = 4 << 20
#: Bytes of ranges, compressed, that a task reads, about.
TASK_BYTES = 8 << 20
#: Up to so many digests of repeated payloads are broadcast, 50 bytes each; more are joined by a shuffle.
BROADCAST_DIGESTS = 100_000
PAGE = "urn:page:"


# ---- writing


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a binary column: five hexadecimal digits make four of base 32."""
    code = F.sha1(payload)
    fives = [F.lpad(F.conv(F.substring(code, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*fives)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record(page_id: int | None, url: str | None, payload: bytes, code: str, refers_to: int | None) -> bytes:
    """One WARC record, compressed as a gzip member; a revisit has headers only."""
    revisit = refers_to is not None
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{PAGE}{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{code}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{PAGE}{refers_to}>",
        ]
    body = b"" if revisit else payload
    head = "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode()
    return gzip.compress(head + body + b"\r\n\r\n", compresslevel=1, mtime=0)


class Package:
    """A ZIP package being written to a stream; the index follows the records."""

    def __init__(self, stream: BinaryIO) -> None:
        self.zip = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)
        self.size, self.index = 0, []

    def add(self, whole: bytes, page_id: int | None) -> None:
        self.data.write(whole)
        self.index.append(json.dumps({"page": page_id, "offset": self.size, "length": len(whole)}))
        self.size += len(whole)

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(INDEX, "\n".join(self.index))
        self.zip.close()


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write packages of the pages into a shared folder; (path, records) of those that were finished.

    ``pages`` has page_id, url, payload (binary), code, refers_to.  Names are
    unique to a task's attempt, and the list is cut: packages of attempts that
    were lost are not in it.
    """
    ship(pages.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = stream = path = None

        def finished() -> pa.RecordBatch:
            package.close()
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(package.index)]})

        for batch in batches:
            for row in zip(*batch.columns):
                page_id, url, payload, code, refers_to = (x.as_py() for x in row)
                if package is None:
                    path = f"{folder}/{uuid.uuid4().hex}.wacz"
                    files, place = _open(path)
                    files.create_dir(place.rpartition("/")[0], recursive=True)
                    stream = files.open_output_stream(place)
                    package = Package(stream)
                package.add(record(page_id, url, payload, code, refers_to), page_id)
                if package.size >= PACKAGE_BYTES:
                    yield finished()
                    package = None
        if package is not None:
            yield finished()

    chosen = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), "payload", "code", "refers_to")
    return cut(chosen.mapInArrow(work, "path string, records bigint"))


# ---- reading


@dataclass(frozen=True)
class Member:
    """A stored member: where its bytes begin in the package, and how many there are."""

    name: str
    start: int
    size: int


def _fetch(file, start: int, size: int) -> bytes:
    file.seek(start)
    found = file.read(size)
    if len(found) != size:
        raise ValueError("package ends early")
    return found


def _directory(file, size: int) -> tuple[int, int, int]:
    """(offset, size, entries) of the central directory."""
    tail_at = max(0, size - 65_557)  # the end record and its longest comment
    tail = _fetch(file, tail_at, size - tail_at)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0:
        raise ValueError("not a ZIP package")
    entries, length, offset = struct.unpack_from("<HII", tail, at + 10)
    if entries == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF:
        locator = _fetch(file, tail_at + at - 20, 20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        end = _fetch(file, struct.unpack_from("<Q", locator, 8)[0], 56)
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record")
        entries, length, offset = struct.unpack_from("<QQQ", end, 32)
    return offset, length, entries


def members(file, size: int) -> list[Member]:
    """The stored members of a package, from its central directory and their local headers."""
    offset, length, entries = _directory(file, size)
    data, at, found = _fetch(file, offset, length), 0, []
    for _ in range(entries):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory")
        method = struct.unpack_from("<H", data, at + 10)[0]
        packed, plain, names, extras, comment = struct.unpack_from("<IIHHH", data, at + 20)
        header = struct.unpack_from("<I", data, at + 42)[0]
        name = data[at + 46 : at + 46 + names].decode("utf-8")
        extra, end = at + 46 + names, at + 46 + names + extras
        while extra + 4 <= end:
            kind, width = struct.unpack_from("<HH", data, extra)
            if kind == 1:  # ZIP64: only the fields that overflow, in this order
                field = extra + 4
                if plain == 0xFFFFFFFF:
                    plain, field = struct.unpack_from("<Q", data, field)[0], field + 8
                if packed == 0xFFFFFFFF:
                    packed, field = struct.unpack_from("<Q", data, field)[0], field + 8
                if header == 0xFFFFFFFF:
                    header = struct.unpack_from("<Q", data, field)[0]
            extra += 4 + width
        local = _fetch(file, header, 30)
        if local[:4] != b"PK\x03\x04":
            raise ValueError("bad local header")
        if method == 0 and not name.endswith("/"):
            found.append(Member(name, header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed))
        at = end + comment
    return found


def ranges(file, size: int) -> Iterator[tuple[int, int, list[int]]]:
    """(start, size, lengths): neighbouring records as byte ranges of the package, from its index."""
    by_name = {m.name: m for m in members(file, size)}
    data, index = by_name[DATA], by_name[INDEX]
    start = stop = data.start
    lengths: list[int] = []
    for line in _fetch(file, index.start, index.size).splitlines():
        entry = json.loads(line)
        at = data.start + entry["offset"]
        if lengths and (at != stop or stop - start + entry["length"] > RANGE_BYTES):
            yield start, stop - start, lengths
            lengths, start = [], at
        lengths.append(entry["length"])
        start, stop = (at if len(lengths) == 1 else start), at + entry["length"]
    if lengths:
        yield start, stop - start, lengths


def parse(whole: bytes) -> dict:
    """One record: its headers, and the payload, verified against its digest."""
    plain = gzip.decompress(whole)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:] if ": " in line)
    payload = rest[: int(fields["Content-Length"])]
    code = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != code:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    page = fields["WARC-Record-ID"][len(PAGE) + 1 : -1]
    refers = fields.get("WARC-Refers-To", "")[len(PAGE) + 1 : -1]
    return {
        "page_id": int(page) if page else None,
        "url": fields.get("WARC-Target-URI", ""),
        "record_type": fields["WARC-Type"],
        "payload_digest": code,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "refers_to": int(refers) if refers else None,
        "payload": payload,
    }


def read(packages: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the packages at ``path``, with their payloads if asked for; revisits have none."""
    ship(packages.sparkSession)

    def list_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, place = _open(path)
                with files.open_input_file(place) as file:
                    found = list(ranges(file, file.size()))
                columns = [[path] * len(found), *([list(c) for c in zip(*found)] or [[], [], []])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())))],
                    ["path", "start", "size", "lengths"],
                )

    kept = {
        "page_id": pa.int64(),
        "url": pa.string(),
        "record_type": pa.string(),
        "payload_digest": pa.string(),
        "payload_bytes": pa.int64(),
        "refers_to": pa.int64(),
    } | ({"payload": pa.binary()} if payloads else {})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, size, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                files, place = _open(path)
                with files.open_input_file(place) as file:
                    data = _fetch(file, start, size)
                at, found = 0, []
                for length in lengths:
                    found.append(parse(data[at : at + length]))
                    at += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[name] for r in found], kind) for name, kind in kept.items()], list(kept)
                )

    places = packages.select("path").mapInArrow(
        list_ranges, "path string, start bigint, size bigint, lengths array<bigint>"
    )
    schema = (
        "page_id bigint, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to bigint"
        + (", payload binary" if payloads else "")
    )
    # The ranges are dealt anew, so that one package is read by many tasks.  Their rows are few and small whatever
    # they stand for, so the number of tasks comes from the bytes to be read.
    places = cut(places)
    size = places.agg(F.sum("size")).first()[0] or 0
    return places.repartition(-(-size // TASK_BYTES) or 1, "path", "start").mapInArrow(fetch, schema)


def prepared(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, payload, code, refers_to): of equal payloads of at least ``least`` bytes all but the last refer to it.

    The last is that with the largest page_id; records without an id refer to
    it as well, and repeated rows with that id are all responses.  Where no
    record of equal payloads has an id, all are responses.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    given = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    given = given.withColumn("code", digest(F.col("payload")))
    long = given.filter(F.octet_length("payload") >= least)
    several = long.groupBy("code").agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    several = cut(several.filter("n > 1 and last is not null").select(F.col("code").alias("same"), "last"))
    if several.count() <= BROADCAST_DIGESTS:
        several = F.broadcast(several)
    joined = given.join(several, F.col("code") == F.col("same"), "left")
    other = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "code", F.when(other, F.col("last")).alias("refers_to"))


def archive(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as packages and read them back: one row per page.

    A null html is an empty payload.  The packages stay in ``folder``, a new
    one below the shared folder unless given.
    """
    folder = folder or scratch_folder(pages.sparkSession, "packages")
    if "://" not in folder and folder.startswith("file:"):
        folder = "file://" + folder.removeprefix("file:")
    return read(write(prepared(pages), folder))


