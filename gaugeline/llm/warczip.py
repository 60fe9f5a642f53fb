"""WARC records in ZIP archives: written by tasks, read back by ranges without extraction.

Each task writes one archive per partition: members `archive/part-N.warc`, stored uncompressed and of
about `member_bytes` each, and `indexes/records.jsonl` with offset and length of every record. The reader takes the
end record (and the ZIP64 one), the central directory and the index by range reads, checks that
members are stored, and then reads records straight from their place in the archive.

Of records with equal payloads that with the largest id is a response, the others are revisits that
refer to it and hold only the HTTP head. Equality is by SHA-1 and length, found by one aggregate; the
pages themselves are not shuffled unless the table of repeated payloads has more than `broadcast_rows` rows.

Defined cases: a null payload or URL is written as empty; a null id ranks below all others and refers or is
referred to as null; rows that share id and payload are all responses if theirs is the largest id;
line breaks in a URL are percent-encoded; an empty table gives no archive and an empty result; further
columns are left alone and not returned.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import importable, new_path, stage
from .common import named, text_or_empty
from .files import new_file, opened

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "indexes/records.jsonl"
READ_BYTES = 8 << 20


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, payload: bytes, keeper: int | None, revisit: bool) -> bytes:
    """One WARC record; a revisit holds the HTTP head alone."""
    name = "" if page is None else page
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{name}>",
             "WARC-Target-URI: " + re.sub(r"[\r\n]", lambda c: f"%{ord(c[0]):02X}", url), f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if keeper is None else keeper}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class Record(NamedTuple):
    page_id: int | None
    url: str
    record_type: str
    refers_to: int | None
    payload_bytes: int
    payload_digest: str
    payload: bytes | None


def _page(urn: str) -> int | None:
    name = urn.strip("<>").rpartition(":")[2]
    return int(name) if name else None


def parsed(raw: bytes) -> Record:
    """A record from its bytes; a response's digest is computed anew and must match its header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[:int(fields["Content-Length"])]
    if not version.startswith("WARC/") or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("the range does not hold one whole record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != size or payload_digest(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    return Record(_page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], fields["WARC-Type"],
                  _page(fields["WARC-Refers-To"]) if revisit else None, size, digest, None if revisit else payload)


class Member(NamedTuple):
    name: str
    start: int
    size: int


class Archive:
    """The directory of a ZIP file and range reads of its stored members."""

    def __init__(self, uri: str):
        system, path = opened(uri)
        self.file = system.open_input_file(path)
        self.members = {m.name: m for m in self._directory()}

    def _directory(self) -> Iterator[Member]:
        total = self.file.size()
        tail = self.file.read_at(min(total, 22 + 65535), max(0, total - 22 - 65535))
        at = tail.rfind(b"PK\x05\x06")
        if at < 0:
            raise ValueError("no end of central directory")
        count, size, start = struct.unpack("<HII", tail[at + 10:at + 20])
        end = max(0, total - 22 - 65535) + at
        if end >= 20:
            locator = self.file.read_at(20, end - 20)
            if locator[:4] == b"PK\x06\x07":
                (place,) = struct.unpack("<Q", locator[8:16])
                count, size, start = struct.unpack("<QQQ", self.file.read_at(56, place)[32:56])
        directory, at = self.file.read_at(size, start), 0
        for _ in range(count):
            mark, _, _, _, method, _, _, _, packed, full, n, m, k, _, _, _, header = struct.unpack(
                "<4sHHHHHHIIIHHHHHII", directory[at:at + 46])
            if mark != b"PK\x01\x02":
                raise ValueError("damaged central directory")
            name, extra = directory[at + 46:at + 46 + n].decode(), directory[at + 46 + n:at + 46 + n + m]
            full, packed, header = self._wide(extra, full, packed, header)
            if method or packed != full:
                raise ValueError(f"{name} is not stored; it cannot be read by ranges")
            names = struct.unpack("<HH", self.file.read_at(4, header + 26))
            yield Member(name, header + 30 + sum(names), full)
            at += 46 + n + m + k

    @staticmethod
    def _wide(extra: bytes, *values: int) -> list[int]:
        """Sizes and offset, those of 0xFFFFFFFF from the ZIP64 field."""
        out = list(values)
        while len(extra) >= 4:
            tag, length = struct.unpack("<HH", extra[:4])
            if tag == 1:
                wide = iter(struct.unpack(f"<{length // 8}Q", extra[4:4 + length // 8 * 8]))
                out = [next(wide) if v == 0xFFFFFFFF else v for v in out]
            extra = extra[4 + length:]
        return out

    def read(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        member = self.members[name]
        length = member.size - offset if length is None else length
        if offset + length > member.size:
            raise ValueError("the range leaves the member")
        return self.file.read_at(length, member.start + offset)


def write_archives(pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html", revisit_from: int = 0,
                   member_bytes: int = 16 << 20, broadcast_rows: int = 500_000) -> DataFrame:
    """The staged manifest, one row per archive: `path, records`."""
    importable(pages.sparkSession)
    folder = new_path(pages.sparkSession, "warc")
    body = text_or_empty(html).cast("binary")
    rows = pages.select(named(page).cast("long").alias("page"), text_or_empty(url).alias("url"), body.alias("body"),
                        F.sha1(body).alias("sha"), F.octet_length(body).alias("size"))
    again = rows.where(F.col("size") >= revisit_from).groupBy("sha", "size").agg(
        F.max("page").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = stage(again, "repeated")
    small = again.count() <= broadcast_rows  # some 60 bytes a row
    marked = rows.join(F.broadcast(again) if small else again, ["sha", "size"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper"))
    marked = marked.select("page", "url", "body", "keeper", F.coalesce(revisit, F.lit(False)).alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, member, parts, total = [], bytearray(), 0, 0
        with new_file(folder, ".zip") as (uri, stream), zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as archive:
            def put(name: str, data: bytes) -> None:
                with archive.open(zipfile.ZipInfo(name), "w", force_zip64=True) as out:
                    out.write(data)

            for batch in batches:
                for at in range(0, batch.num_rows, 200):
                    for row in batch.slice(at, 200).to_pylist():
                        raw = record(row["page"], row["url"], row["body"], row["keeper"], row["revisit"])
                        index.append({"page": row["page"], "member": f"archive/part-{parts}.warc", "offset": len(member), "length": len(raw)})
                        member += raw
                        total += 1
                        if len(member) >= member_bytes:
                            put(f"archive/part-{parts}.warc", bytes(member))
                            member, parts = bytearray(), parts + 1
            if member:
                put(f"archive/part-{parts}.warc", bytes(member))
            put(INDEX, "".join(json.dumps(i) + "\n" for i in index).encode())
        if total:
            yield pa.RecordBatch.from_pydict({"path": [uri], "records": pa.array([total], pa.int64())})
    return stage(marked.mapInArrow(write, "path string, records long"), "archives")


_FIELDS = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
           ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]


def read_records(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record the archives' indexes name; with `payloads` also the payload (null for revisits)."""
    importable(archives.sparkSession)
    schema = pa.schema([*_FIELDS, *([("payload", pa.binary())] if payloads else [])])
    placed = archives.repartition(max(1, archives.count()))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                archive = Archive(path)
                entries = [json.loads(line) for line in archive.read(INDEX).splitlines()]
                first = 0
                while first < len(entries):  # neighbours within READ_BYTES share one range read
                    end, start = first, entries[first]["offset"]
                    while end < len(entries) and entries[end]["member"] == entries[first]["member"] and (
                            end == first or entries[end]["offset"] + entries[end]["length"] - start <= READ_BYTES):
                        end += 1
                    last = entries[end - 1]
                    raw = archive.read(last["member"], start, last["offset"] + last["length"] - start)
                    found = [parsed(raw[e["offset"] - start:e["offset"] - start + e["length"]]) for e in entries[first:end]]
                    yield pa.RecordBatch.from_pydict(
                        {f.name: pa.array([getattr(r, f.name) for r in found], f.type) for f in schema}, schema)
                    first = end
    ddl = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"
    return placed.mapInArrow(read, ddl + (", payload binary" if payloads else ""))
