"""WARC records in ZIP packages, read back by byte ranges.

A package holds ``archive/data.warc.gz`` (one gzip member per record) and
``indexes/index.cdxj`` (one line per record with its offset and length), both stored
without compression, so a record is a byte range of the package.  The reader finds the
end-of-directory record, the ZIP64 one if fields are saturated, and the central
directory; it locates the stored members through their local headers, reads the index
and then only the ranges of the records.  Nothing is extracted.

Records whose payloads are equal and at least ``min_bytes`` long: the one with the
smallest page_id is a response, the others are revisits that name it and carry no
payload, only its length and digest.

Defined cases: null and empty html is an empty payload; a row without page_id is always
a response; rows that repeat the smallest page_id are all responses; a null url gives an
empty target; an empty table writes no package.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import os
import struct
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_blobs, work_path, write_blobs

MIN_BYTES = 100
PACKAGE_BYTES = 8 << 20
PACKAGE_STEP = 1_000_000
WARC_DATE = "2024-01-01T00:00:00Z"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

_LOCAL = struct.Struct("<4s5H3I2H")
_CENTRAL = struct.Struct("<4s6H3I5H2I")
_END = struct.Struct("<4s4H2IH")
_END64 = struct.Struct("<4sQ2H2I4Q")
_LOCATOR = struct.Struct("<4sIQI")
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


# ---- packages ----------------------------------------------------------------------
def write_package(members: list[tuple[str, bytes]], zip64: bool = True, comment: bytes = b"\n") -> bytes:
    """A ZIP file of stored members.  With ``zip64`` the directory uses 64-bit records."""
    out, central = io.BytesIO(), io.BytesIO()
    for name, data in members:
        raw, at, crc = name.encode(), out.tell(), zlib.crc32(data)
        out.write(_LOCAL.pack(b"PK\3\4", 45, 0x800, 0, 0, 0x21, crc, len(data), len(data), len(raw), 0) + raw)
        out.write(data)
        extra = struct.pack("<2H3Q", 1, 24, len(data), len(data), at) if zip64 else b""
        size, place = (_FULL32, _FULL32) if zip64 else (len(data), at)
        central.write(_CENTRAL.pack(b"PK\1\2", 45, 45, 0x800, 0, 0, 0x21, crc, size, size, len(raw), len(extra), 0, 0, 0, 0, place))
        central.write(raw + extra)
    at, size, n = out.tell(), central.tell(), len(members)
    out.write(central.getvalue())
    if zip64:
        end64 = out.tell()
        out.write(_END64.pack(b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, at))
        out.write(_LOCATOR.pack(b"PK\6\7", 0, end64, 1))
        n, size, at = _FULL16, _FULL32, _FULL32
    out.write(_END.pack(b"PK\5\6", 0, 0, n, n, size, at, len(comment)) + comment)
    return out.getvalue()


class ByteSource:
    """Ranges of bytes in memory."""

    def __init__(self, data):
        self.view, self.size = memoryview(data), len(data)

    def read(self, at: int, n: int) -> bytes:
        return bytes(self.view[at: at + n])

    def close(self):
        pass


class FileSource:
    """Ranges of an open file; only what is asked for is read."""

    def __init__(self, path: str):
        self.fd = os.open(path, os.O_RDONLY)
        self.size = os.fstat(self.fd).st_size

    def read(self, at: int, n: int) -> bytes:
        return os.pread(self.fd, n, at)

    def close(self):
        os.close(self.fd)


class PackageReader:
    """The directory of a ZIP package and ranges of its stored members."""

    def __init__(self, source):
        self.source = source
        tail_at = max(0, source.size - _END.size - _FULL16)
        tail = source.read(tail_at, source.size - tail_at)
        found = tail.rfind(b"PK\5\6")
        while found >= 0:  # the comment may hold the mark too: its length must reach the end
            if found + _END.size <= len(tail) and found + _END.size + _END.unpack_from(tail, found)[-1] == len(tail):
                break
            found = tail.rfind(b"PK\5\6", 0, found)
        if found < 0:
            raise ValueError("no end of central directory")
        _, _, _, _, n, size, at, _ = _END.unpack_from(tail, found)
        if n == _FULL16 or size == _FULL32 or at == _FULL32:
            mark, _, end64, _ = _LOCATOR.unpack(source.read(tail_at + found - _LOCATOR.size, _LOCATOR.size))
            if mark != b"PK\6\7":
                raise ValueError("no ZIP64 locator")
            mark, *_, n, size, at = _END64.unpack(source.read(end64, _END64.size))
            if mark != b"PK\6\6":
                raise ValueError("no ZIP64 end of central directory")
        self.members = self._directory(source.read(at, size), n)

    @staticmethod
    def _directory(data: bytes, n: int) -> dict[str, tuple[int, int, int]]:
        members, at = {}, 0
        for _ in range(n):
            (mark, _, _, _, method, _, _, _, packed, size, n_name, n_extra, n_comment, _, _, _, place) = _CENTRAL.unpack_from(data, at)
            if mark != b"PK\1\2":
                raise ValueError("bad central directory")
            at += _CENTRAL.size
            name = data[at: at + n_name].decode()
            extra = data[at + n_name: at + n_name + n_extra]
            at += n_name + n_extra + n_comment
            while len(extra) >= 4:
                kind, length = struct.unpack_from("<2H", extra)
                if kind == 1:  # 64-bit values of the saturated fields, in this order
                    wide = iter(struct.unpack(f"<{length // 8}Q", extra[4: 4 + length // 8 * 8]))
                    size = next(wide) if size == _FULL32 else size
                    packed = next(wide) if packed == _FULL32 else packed
                    place = next(wide) if place == _FULL32 else place
                extra = extra[4 + length:]
            members[name] = (method, place, size)
        return members

    def place(self, name: str) -> tuple[int, int]:
        """(offset of the first byte, size) of a stored member."""
        method, at, size = self.members[name]
        if method != 0:
            raise ValueError(f"{name} is not stored")
        head = _LOCAL.unpack(self.source.read(at, _LOCAL.size))
        if head[0] != b"PK\3\4":
            raise ValueError("bad local header")
        return at + _LOCAL.size + head[-2] + head[-1], size


# ---- records -----------------------------------------------------------------------
def warc_record(page_id, url: str, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One record; a revisit (``refers_to`` given) has the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:uuid:{name}>",
             f"WARC-Target-URI: {url}", f"WARC-Date: {WARC_DATE}", f"WARC-Payload-Digest: sha256:{digest}",
             "Content-Type: application/http;msgtype=response"]
    if page_id is not None:
        lines.append(f"WARC-Page-Key: {page_id}")
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To-Page-Key: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(record headers, HTTP headers, payload) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("record length does not match")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def _clean(url) -> str:
    return "" if url is None else "".join(c for c in url if c >= " ")


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES, package_bytes: int = PACKAGE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as packages of about ``package_bytes`` at ``path``."""
    body = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"))
    keys = materialize(pages.select("page_id", F.octet_length("html").alias("size"), F.sha2("html", 256).alias("digest")))
    large = keys.where(F.col("size") >= min_bytes).where(F.col("page_id").isNotNull())
    firsts = materialize(large.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("_last"))
                         .where("first < _last").select("digest", "first"))
    # written tables on both sides: the join can split a digest that many pages share
    again = materialize(large.join(firsts, "digest").where("page_id > first")
                        .select("page_id", "digest", F.col("first").alias("refers_to")).distinct())
    marked = (pages.withColumn("digest", F.sha2("html", 256)).withColumn("size", F.octet_length("html"))
              .join(again, ["page_id", "digest"], "left")
              .select("page_id", F.col("url"), "digest", "size", "refers_to",
                      F.when(F.col("refers_to").isNull(), F.col("html")).cast("binary").alias("payload")))

    def build(batches):
        blob, data, index = TaskContext.get().partitionId() * PACKAGE_STEP, io.BytesIO(), []

        def package():
            members = [(DATA, data.getvalue()), (INDEX, "".join(index).encode())]
            return pa.RecordBatch.from_arrays(
                # the writer ends the file with a newline, which is the package's comment
                [pa.array([blob], pa.int64()), pa.array([write_package(members)[:-1]], pa.binary())], ["blob", "body"])

        for batch in batches:
            cols = [batch.column(c) for c in ("page_id", "url", "digest", "size", "refers_to", "payload")]
            for row in zip(*cols):
                page_id, url, digest, size, refers_to, payload = (x.as_py() for x in row)
                url, at = _clean(url), data.tell()
                data.write(gzip.compress(warc_record(page_id, url, payload or b"", size, digest, refers_to), 4, mtime=0))
                line = {"offset": at, "length": data.tell() - at, "digest": f"sha256:{digest}"}
                index.append(f"{url or '-'} {json.dumps(line)}\n")
                if data.tell() >= package_bytes:
                    yield package()
                    blob, data, index = blob + 1, io.BytesIO(), []
        if index:
            yield package()

    write_blobs(marked.mapInArrow(build, "blob long, body binary"), path)


def read_package(source):
    """(headers, HTTP headers, payload) of every record, one range read each."""
    package = PackageReader(source)
    data_at, _ = package.place(DATA)
    index_at, size = package.place(INDEX)
    for line in source.read(index_at, size).decode().splitlines():
        entry = json.loads(line[line.index(" {"):])
        yield parse_record(gzip.decompress(source.read(data_at + entry["offset"], entry["length"])))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Packages in a file system that every worker mounts (file:) are opened in place and
    read by ranges; in other stores Spark's reader hands over a package's bytes and the
    ranges are taken in memory.
    """
    files = read_blobs(spark, path)
    mounted = path.startswith(("file:", "/"))
    files = files.select("path") if mounted else files.select("path", "content")

    def records(batches):
        from urllib.parse import unquote, urlparse

        for batch in batches:
            for i in range(batch.num_rows):
                source = (FileSource(unquote(urlparse(batch.column("path")[i].as_py()).path)) if mounted
                          else ByteSource(batch.column("content")[i].as_buffer()))
                cols = [[], [], [], [], []]
                try:
                    for fields, http, payload in read_package(source):
                        revisit = fields["WARC-Type"] == "revisit"
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                        if not revisit and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError("payload does not match its digest")
                        key, refers = fields.get("WARC-Page-Key"), fields.get("WARC-Refers-To-Page-Key")
                        for col, x in zip(cols, (key and int(key), int(http["Content-Length"]) if revisit else len(payload),
                                                 digest, fields["WARC-Type"], refers and int(refers))):
                            col.append(x)
                finally:
                    source.close()
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return files.mapInArrow(
        records, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived_pages(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the packages of ``pages`` under the shared folder and read their records back."""
    path = work_path(pages.sparkSession, "warc")
    write_archives(pages, path, min_bytes)
    return read_archives(pages.sparkSession, path)


ORACLE_SQL = """
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS html, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id FROM pages)
"""
