"""WARC records in ZIP-packaged archives: writing with revisit records, and range-reading without extraction.

An archive is a ZIP file with stored (uncompressed) members: `archive/data.warc.gz`, one gzip member a record;
`indexes/index.cdx`, a line a record with its offset and length in that member; `datapackage.json`. A reader fetches
the end of the file, the ZIP64 records where they exist, the central directory, the index's bytes, and then the
records it wants; nothing is unpacked to disk.

Null payloads are empty ones. Rows without a page_id come last in the order of page_ids and carry none in the result;
of repeated rows (equal page_id and payload) one is the response and the others revisit it. An empty table gives no
archive and an empty result. Further columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import itertools
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach_minimum, fresh_path, open_fs, partitions, thrifty

NO_PAGE = (1 << 63) - 1  # stands for a null page_id in keys
LEAST = 100  # shorter payloads are never revisits
ROLL = 64 << 20  # bytes of records after which a task begins another archive
DATA, INDEX, PACKAGE = "archive/data.warc.gz", "indexes/index.cdx", "datapackage.json"
HTTP_END = b"\r\n\r\n"


# ---------------------------------------------------------------- ZIP
@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc32: int
    stored: int
    size: int
    header: int  # where its local header begins


class ZipWriter:
    """Stored members, one after another, to a file that can't seek. zip64: write ZIP64 fields even where sizes are small."""

    def __init__(self, out: BinaryIO, zip64: bool = False):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []
        self._open: list | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self._open = [name, self.at, 0, 0]
        self._put(struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0x0808, 0, 0, 0x21, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), 20) + raw)
        self._put(struct.pack("<HHQQ", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self._open[2] = zlib.crc32(data, self._open[2])
        self._open[3] += len(data)
        self._put(data)

    def end(self) -> None:
        name, header, crc, size = self._open
        self._put(struct.pack("<4sIQQ", b"PK\7\x08", crc, size, size))
        self.members.append(Member(name, 0, crc, size, size, header))
        self._open = None

    def close(self) -> None:
        start, top = self.at, 0xFFFFFFFF
        for m in self.members:
            wide = self.zip64 or m.size >= top or m.header >= top
            extra = struct.pack("<HHQQQ", 1, 24, m.size, m.stored, m.header) if wide else b""
            size, header = (top, top) if wide else (m.size, m.header)
            raw = m.name.encode()
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0x0808, 0, 0, 0x21, m.crc32, size, size, len(raw), len(extra), 0, 0, 0, 0, header) + raw + extra)
        length, n = self.at - start, len(self.members)
        wide = self.zip64 or start >= top or n >= 0xFFFF
        if wide:
            record = self.at
            self._put(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, n, n, length, start))
            self._put(struct.pack("<4sIQI", b"PK\6\7", 0, record, 1))
        self._put(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, *((0xFFFF,) * 2 if wide else (n, n)), top if wide else length, top if wide else start, 0))


class ZipArchive:
    """Members of a seekable file by its central directory; ranges of stored members without extraction."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size
        self.members = {m.name: m for m in self._directory()}
        self._starts: dict[str, int] = {}

    def _range(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        data = self.file.read(length)
        if len(data) != length:
            raise ValueError("the archive is cut off")
        return data

    def _directory(self) -> Iterator[Member]:
        tail_at = max(0, self.size - 22 - 65535)
        tail = self._range(tail_at, self.size - tail_at)
        end = tail.rfind(b"PK\5\6")
        while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
            end = tail.rfind(b"PK\5\6", 0, end)
        if end < 0:
            raise ValueError("no end of central directory")
        n, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
        locator = tail_at + end - 20
        if locator >= 0 and (found := self._range(locator, 20))[:4] == b"PK\6\7":
            record = self._range(int.from_bytes(found[8:16], "little"), 56)
            if record[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end of central directory where its locator points")
            n, length, start = struct.unpack("<QQQ", record[32:56])
        raw, at = self._range(start, length), 0
        for _ in range(n):
            if raw[at : at + 4] != b"PK\1\2":
                raise ValueError("a central directory entry is broken")
            method, _, _, crc, stored, size, a, b, c, _, _, _, header = struct.unpack("<HHHIIIHHHHHII", raw[at + 10 : at + 46])
            name, extra = raw[at + 46 : at + 46 + a], raw[at + 46 + a : at + 46 + a + b]
            k = 0
            while k + 4 <= len(extra):
                kind, width = struct.unpack("<HH", extra[k : k + 4])
                if kind == 1:
                    wide = iter(struct.unpack(f"<{width // 8}Q", extra[k + 4 : k + 4 + width // 8 * 8]))
                    size, stored, header = (next(wide) if v == 0xFFFFFFFF else v for v in (size, stored, header))
                k += 4 + width
            yield Member(name.decode(), method, crc, stored, size, header)
            at += 46 + a + b + c

    def read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        """Bytes of a stored member."""
        m = self.members[name]
        if m.method != 0:
            raise ValueError(f"{name} isn't stored, so has no ranges")
        if name not in self._starts:
            local = self._range(m.header, 30)
            if local[:4] != b"PK\3\4":
                raise ValueError(f"{name} has no local header")
            self._starts[name] = m.header + 30 + sum(struct.unpack("<HH", local[26:30]))
        length = m.size - start if length is None else length
        if start < 0 or start + length > m.size:
            raise ValueError(f"{name} has no such range")
        return self._range(self._starts[name] + start, length)


# ---------------------------------------------------------------- WARC
def _record(kind: str, page: int | None, url: str, number: int, payload: bytes, digest: str, refers: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d" % len(payload) + HTTP_END
    block = http + (payload if kind == "response" else b"")
    safe = url.replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}:{number}>",
        "WARC-Date: 2020-01-01T00:00:00Z",
        f"WARC-Target-URI: {safe}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'none' if refers is None else refers}>"]
    return "\r\n".join(head).encode() + HTTP_END + block + HTTP_END


def parse_record(raw: bytes) -> dict:
    """A record's type, page ids, payload length and digest; a response's payload is digested anew and compared."""
    head, sep, rest = raw.partition(HTTP_END)
    lines = head.decode().split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != HTTP_END:
        raise ValueError("a record's block is cut off")
    http, _, payload = block.partition(HTTP_END)
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if fields["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload doesn't fit its digest")
    number = lambda x: None if x == "none" else int(x)
    return {
        "page_id": number(fields["warc-record-id"].split(":")[2]),
        "url": fields.get("warc-target-uri", ""),
        "record_type": fields["warc-type"],
        "payload_bytes": length,
        "payload_digest": digest,
        "refers_to": number(fields["warc-refers-to"][1:-1].split(":")[2]) if "warc-refers-to" in fields else None,
        "payload": payload,
    }


def _archive(path: str, records: Iterator[tuple]) -> int:
    """Writes one archive of about ROLL bytes at most to a shared path, under another name until it is whole; its records."""
    fs, place = open_fs(path)
    temp = f"{place}.{uuid.uuid4().hex}.part"
    n, size, index = 0, 0, []
    with fs.open_output_stream(temp) as out:
        z = ZipWriter(out)
        z.begin(DATA)
        for page, url, number, payload, digest, kind, refers in records:
            data = gzip.compress(_record(kind, page, url, number, payload, digest, refers), 1, mtime=0)
            index.append(f"{'-' if page is None else page} {json.dumps({'offset': size, 'length': len(data), 'mime': 'warc/revisit' if kind == 'revisit' else 'text/html', 'digest': digest})}")
            z.write(data)
            n, size = n + 1, size + len(data)
            if size >= ROLL:
                break
        z.end()
        for name, text in ((INDEX, "\n".join(index)), (PACKAGE, json.dumps({"profile": "data-package", "resources": [{"path": DATA}, {"path": INDEX}]}))):
            z.begin(name)
            z.write(text.encode())
            z.end()
        z.close()
    fs.move(temp, place)
    return n


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes pages (page_id, url, html) as archives below a shared folder; returns the manifest (path, records).

    A digest's smallest page_id comes from a map-side combined minimum; only it, not the payloads, meets the digest.
    Payloads are dealt by page and digest, so that copies of one payload spread over all tasks.
    """
    spark = pages.sparkSession
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.coalesce(F.col("page_id").cast("long"), F.lit(NO_PAGE)).alias("k"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), text.alias("html"),
        F.sha2(F.encode(text, "UTF-8"), 256).alias("digest"), F.octet_length(text).alias("size"),
    )
    keys = rows.where(F.col("size") >= LEAST).select("digest", "k")
    firsts = keys.groupBy("digest").agg(F.min("k").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("digest", "first")
    later = attach_minimum(keys.distinct(), firsts, ["digest"], "k").where("first < k").select(F.col("k").alias("lk"), F.col("digest").alias("ld"), "first")
    dealt = rows.repartition(partitions(spark), "k", "digest")
    marked = dealt.join(later, (dealt.k == later.lk) & (dealt.digest == later.ld), "left").select("k", "url", "html", "digest", "size", "first").sortWithinPartitions("k", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def records() -> Iterator[tuple]:
            last, number = None, 0
            for b in batches:
                for k, url, html, digest, size, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    again = (k, digest) == last
                    number = number + 1 if again else 0
                    last = (k, digest)
                    refers = first if first is not None else k if again and size >= LEAST else None
                    page = None if k == NO_PAGE else k
                    kind = "response" if refers is None else "revisit"
                    yield page, url, number, html.encode(), digest, kind, None if refers == NO_PAGE else refers

        todo, made = records(), []
        head = next(todo, None)
        while head is not None:
            path = f"{folder}/part-{part:05d}-{len(made):04d}.wacz"
            made.append((path, _archive(path, itertools.chain([head], todo))))
            head = next(todo, None)
        if made:
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in made], "records": pa.array([n for _, n in made], pa.int64())})

    manifest = f"{folder}-manifest"
    marked.mapInArrow(thrifty(run), "path string, records long").write.parquet(manifest)
    return spark.read.schema("path string, records long").parquet(manifest)


def locate(manifest: DataFrame) -> DataFrame:
    """(path, page_id, offset, length) of every record, from the archives' central directories and indexes alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, place = open_fs(path)
                with fs.open_input_file(place) as f:
                    lines = ZipArchive(f, f.size()).read(INDEX).decode().splitlines()
                found = [(a, json.loads(j)) for a, _, j in (x.partition(" ") for x in lines)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found)), pa.array([None if a == "-" else int(a) for a, _ in found], pa.int64()), pa.array([j["offset"] for _, j in found], pa.int64()), pa.array([j["length"] for _, j in found], pa.int64())],
                    ["path", "page_id", "offset", "length"],
                )

    return manifest.select("path").mapInArrow(thrifty(run), "path string, page_id long, offset long, length long")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def fetch(located: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at (path, offset, length), each by a range read. payloads: False leaves that column null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RECORD.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        now, f, z = None, None, None

        def flush(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)

        try:
            for b in batches:
                rows, held = [], 0
                for path, offset, length in zip(*(b.column(b.schema.names.index(n)).to_pylist() for n in ("path", "offset", "length")), strict=True):
                    if path != now:
                        if f is not None:
                            f.close()
                        fs, place = open_fs(path)
                        f = fs.open_input_file(place)
                        now, z = path, ZipArchive(f, f.size())
                    r = parse_record(gzip.decompress(z.read(DATA, offset, length)))
                    if not payloads:
                        r["payload"] = None
                    held += len(r["payload"] or b"")
                    rows.append(r)
                    if held > 8 << 20:
                        yield flush(rows)
                        rows, held = [], 0
                yield flush(rows)
        finally:
            if f is not None:
                f.close()

    return located.mapInArrow(thrifty(run), RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, payloads: bool = False) -> DataFrame:
    """Writes pages to archives in the shared folder and reads every record back."""
    folder = fresh_path(spark, "warc")
    _make_folder(spark, folder)
    manifest = write_archives(pages, folder)
    return fetch(locate(manifest.repartition(partitions(spark), "path")), payloads)


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
