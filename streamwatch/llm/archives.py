"""Legacy ARC archives to WARC.

An ARC file begins with a version block that names the fields of its header lines: five in
version 1, ten in version 2. A record is a header line and as many bytes as the line declares.
The converter reads the lines by the version's fields, takes the declared lengths, and makes what WARC
asks for besides: record identifiers (derived from the record, so a repeated task writes the same),
timestamps, record types and payload digests. Records with a payload that another record with a larger source
id has too become revisits of it.

An archive is one row (name, content) as executors reach shared storage through Spark's
writers only; files can be read as such rows by Spark's ``binaryFile`` source. WARC records are gzip
members of their own, and archives of bounded size, so a reader holds one archive at a time.

Rules: a null body is empty. Records with the same source id and payload are each written, both as
responses or both as revisits. Null source ids are smaller than all others. White space and control characters in a URL are
percent-encoded; a null or empty one is ``-``. An empty table gives no archive. Other columns are not used.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fields of the header lines. Fixed values of the format.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

ARCHIVE_BYTES = 4 << 20
RECORDS = "url string, ip string, date string, content_type string, status string, http_head binary, payload binary, payload_digest string, record_id string"


def _line_safe(url: str | None) -> str:
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda found: quote(found[0]), url or "") or "-"


def arc_line(version: int, url: str, date: str, content_type: str, length: int, name: str = "-", offset: int = 0) -> bytes:
    values = {"URL": url, "IP-address": "0.0.0.0", "Archive-date": date, "Content-type": content_type, "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(length)}
    return " ".join(values[field] for field in ARC_FIELDS[version].split()).encode() + b"\n"


def write_arc(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", version: int = 1, date: str = "20240101000000", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(name, content) of ARC archives with a record per page; its id is a header field of the stored response."""

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def begin() -> list[bytes]:
            block = f"{version} 0 pages\n{ARC_FIELDS[version]}\n\n".encode()
            return [arc_line(version, "filedesc://pages.arc", date, "text/plain", len(block)) + block]

        def archive(parts: list[bytes]) -> pa.RecordBatch:
            content = b"".join(parts)
            name = f"pages-{hashlib.sha1(content).hexdigest()}.arc"
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([content], pa.binary())], ["name", "content"])

        parts, size = begin(), 0
        for batch in batches:
            for page, url, body in zip(*(column.to_pylist() for column in batch.columns)):
                body = (body or "").encode()
                head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\nX-Source-Id: {'' if page is None else page}\r\n\r\n".encode()
                parts += [b"\n", arc_line(version, _line_safe(url), date, "text/html", len(head) + len(body), offset=size), head, body]
                size += len(head) + len(body)
                if size >= archive_bytes:
                    yield archive(parts)
                    parts, size = begin(), 0
        if size:
            yield archive(parts)

    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(body_col).alias("body"))
    return rows.mapInArrow(archives, "name string, content binary")


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and bytes of each record, the version block aside. ValueError where the format is broken."""
    end = content.index(b"\n")
    own = content[:end].decode().split(" ")
    if not own[0].startswith("filedesc://"):
        raise ValueError("an ARC archive begins with a filedesc line")
    at = end + 1 + int(own[-1])
    version, fields = content[end + 1 : at].decode().split("\n")[:2]
    fields = fields.split(" ")
    if " ".join(fields) != ARC_FIELDS.get(int(version.split(" ")[0])):
        raise ValueError(f"unknown version block: {version}")
    while at < len(content):
        while content[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(content):
            break
        end = content.index(b"\n", at)
        # a URL of old crawlers may hold spaces; all other fields do not
        values = content[at:end].decode("utf-8", "replace").rstrip("\r").rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"a header line has {len(values)} fields instead of {len(fields)}")
        record = dict(zip(fields, values))
        length = int(record["Archive-length"])
        if end + 1 + length > len(content):
            raise ValueError("a record is longer than its archive")
        yield record, content[end + 1 : end + 1 + length]
        at = end + 1 + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """Header and payload of a stored response; a block without a status line is all payload."""
    end = block.find(b"\r\n\r\n")
    return (block[: end + 4], block[end + 4 :]) if block.startswith(b"HTTP/") and end >= 0 else (b"", block)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_arc(archives: DataFrame, content_col: str = "content") -> DataFrame:
    """The records of ARC archives (rows with the bytes of a whole archive), with payload digest and record id."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for fields, block in arc_records(content.as_py()):
                    head, payload = split_http(block)
                    digest = payload_digest(payload)
                    date = fields["Archive-date"]
                    key = f"{fields['URL']} {date} {digest} {hashlib.sha1(head).hexdigest()}"
                    rows.append((fields["URL"], fields["IP-address"], date, fields["Content-type"], fields.get("Result-code"), head, payload, digest, f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}"))
                kinds = [pa.string()] * 5 + [pa.binary()] * 2 + [pa.string()] * 2
                names = ["url", "ip", "date", "content_type", "status", "http_head", "payload", "payload_digest", "record_id"]
                yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)], names)

    return archives.select(F.col(content_col)).mapInArrow(records, RECORDS)


def _iso(date: str) -> str:
    date = date.ljust(14, "0")
    return f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"


def mark_revisits(records: DataFrame, source_id, *, least_bytes: int = 0) -> DataFrame:
    """``records`` with source_id, refers_to and refers_to_id: the record with the largest source id among those of
    equal payload of at least ``least_bytes``, null for itself. Digests are summed up before they are joined, and
    a payload that very many records have is split by adaptive execution's skew join."""
    known = records.withColumn("source_id", source_id)
    large = F.length("payload") >= least_bytes
    newest = known.filter(large).groupBy("payload_digest").agg(F.count("*").alias("n"), F.max(F.struct("source_id", "record_id")).alias("newest"))
    joined = known.join(newest.filter("n > 1").drop("n"), "payload_digest", "left")
    other = large & F.col("newest").isNotNull() & ~F.col("source_id").eqNullSafe(F.col("newest.source_id"))
    return joined.select(
        *records.columns,
        "source_id",
        F.when(other, F.col("newest.record_id")).alias("refers_to"),
        F.when(other, F.col("newest.source_id")).alias("refers_to_id"),
    )


def write_warc(records: DataFrame, *, archive_bytes: int = ARCHIVE_BYTES, level: int = 3) -> DataFrame:
    """(name, content) of WARC archives. ``records`` as :func:`mark_revisits` gives them."""

    def member(row: dict) -> bytes:
        revisit = row["refers_to"] is not None
        block = row["http_head"] if revisit else row["http_head"] + row["payload"]
        fields = {
            "WARC-Type": "revisit" if revisit else "response",
            "WARC-Record-ID": f"<{row['record_id']}>",
            "WARC-Date": _iso(row["date"]),
            "WARC-Target-URI": row["url"],
            "WARC-IP-Address": row["ip"],
            "WARC-Payload-Digest": f"sha1:{row['payload_digest']}",
            "WARC-Refers-To": f"<{row['refers_to']}>" if revisit else None,
            "WARC-Profile": REVISIT_PROFILE if revisit else None,
            "WARC-Source-ID": row["source_id"],
            "WARC-Refers-To-Source-ID": row["refers_to_id"],
            "Payload-Length": len(row["payload"]),
            "Content-Type": "application/http; msgtype=response" if row["http_head"] else row["content_type"],
            "Content-Length": len(block),
        }
        head = "WARC/1.0\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None) + "\r\n"
        packer = zlib.compressobj(level, zlib.DEFLATED, 31)
        return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(parts: list[bytes]) -> pa.RecordBatch:
            content = b"".join(parts)
            return pa.RecordBatch.from_arrays([pa.array([f"{hashlib.sha1(content).hexdigest()}.warc.gz"]), pa.array([content], pa.binary())], ["name", "content"])

        parts, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                parts.append(member(batch.slice(k, 1).to_pylist()[0]))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive(parts)
                    parts, size = [], 0
        if parts:
            yield archive(parts)

    return records.mapInArrow(archives, "name string, content binary")


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of a WARC archive with a gzip member per record."""
    rest = content
    while rest:
        unpacker = zlib.decompressobj(31)
        record = unpacker.decompress(rest) + unpacker.flush()
        rest = unpacker.unused_data
        end = record.index(b"\r\n\r\n")
        lines = record[:end].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        length = int(fields["Content-Length"])
        if not lines[0].startswith("WARC/") or len(record) != end + 8 + length:
            raise ValueError("a WARC record differs from its declared length")
        yield fields, record[end + 4 : end + 4 + length]


WARC_ROWS = "record_id string, record_type string, url string, date string, payload_digest string, refers_to string, source_id string, refers_to_id string, payload_bytes long, payload binary"


def read_warc(archives: DataFrame, content_col: str = "content", *, payloads: bool = True) -> DataFrame:
    """A row per record. The payload of a revisit is null, as are all without ``payloads``. A response whose payload
    does not have its digest and length stops the job."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found = []
                for fields, block in warc_records(content.as_py()):
                    payload = split_http(block)[1] if fields["WARC-Type"] == "response" else None
                    digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["Payload-Length"])
                    if payload is not None and (payload_digest(payload) != digest or len(payload) != length):
                        raise ValueError(f"{fields['WARC-Record-ID']} differs from its digest")
                    found.append((fields["WARC-Record-ID"].strip("<>"), fields["WARC-Type"], fields["WARC-Target-URI"], fields["WARC-Date"], digest, (fields.get("WARC-Refers-To") or "").strip("<>") or None, fields.get("WARC-Source-ID"), fields.get("WARC-Refers-To-Source-ID"), length, payload if payloads else None))
                kinds = [pa.string()] * 8 + [pa.int64(), pa.binary()]
                names = ["record_id", "record_type", "url", "date", "payload_digest", "refers_to", "source_id", "refers_to_id", "payload_bytes", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)], names)

    return archives.select(F.col(content_col)).mapInArrow(rows, WARC_ROWS)
