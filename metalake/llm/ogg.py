"""Media columns in Ogg: pages with checksums, packets from lacing values, multiplexed logical streams, granule time.

A document's bytes, padded by blanks to a positive multiple of 192, become a stream of 8-bit samples: packets of
`PACKET` samples, the granule position counting samples. A second logical stream, multiplexed with it, holds one
comment packet with the length before padding. Reading verifies every page's checksum and sequence number, rebuilds packets from lacing
values across pages, separates the streams by serial number and derives times from granule positions.

Null and empty texts give one block of 192 blanks. Equal texts give equal media. Repeated rows, a null doc_id and
further columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import thrifty, utf8

BLOCK = 192
PACKET = 192 * 20
RATE = 48_000
PAGE_PACKETS = 8
SAMPLES, COMMENT = 1, 2

_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def page_checksum(page: bytes) -> int:
    """Ogg's CRC-32 (generator 0x04c11db7, high bit first, from zero): zlib's runs low bit first, so bytes and result are reversed."""
    low = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(low.to_bytes(4, "little").translate(_REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = b"OggS\0" + bytes([flags]) + granule.to_bytes(8, "little", signed=True) + serial.to_bytes(4, "little") + number.to_bytes(4, "little")
    rest = bytes([len(lacing)]) + lacing + body
    return head + page_checksum(head + b"\0\0\0\0" + rest).to_bytes(4, "little") + rest


def paginate(packets: list[tuple[bytes, int]], serial: int, per_page: int = PAGE_PACKETS) -> list[bytes]:
    """Pages of one logical stream; packets: (bytes, granule position at its end). A packet may run over many pages."""
    pages: list[bytes] = []
    lacing, body, granule, ended, open_ = bytearray(), bytearray(), -1, 0, False

    def close(last: bool = False) -> None:
        nonlocal lacing, body, granule, ended
        flags = (1 if carried else 0) | (2 if not pages else 0) | (4 if last else 0)
        pages.append(_page(flags, granule, serial, len(pages), bytes(lacing), bytes(body)))
        lacing, body, granule, ended = bytearray(), bytearray(), -1, 0

    carried = False
    for packet, at in packets:
        values = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        done = 0
        while done < len(values):
            room = 255 - len(lacing)
            now = values[done : done + room]
            start = done * 255
            body += packet[start : start + sum(now)]
            lacing += now
            done += len(now)
            if done < len(values):
                close()
                carried = True
        granule, ended = at, ended + 1
        if ended >= per_page or len(lacing) == 255:
            close()
            carried = False
    if lacing or not pages:
        close()
    # the last page says that the stream ends
    final = bytearray(pages[-1])
    final[5] |= 4
    final[22:26] = b"\0\0\0\0"
    final[22:26] = page_checksum(bytes(final)).to_bytes(4, "little")
    pages[-1] = bytes(final)
    return pages


def multiplex(streams: list[list[bytes]]) -> bytes:
    """One file: the streams' first pages, then their other pages in turn."""
    out = [s[0] for s in streams]
    for i in range(1, max(map(len, streams))):
        out += [s[i] for s in streams if i < len(s)]
    return b"".join(out)


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # granule position at the end of the page on which each packet ends
    pages: int = 0
    ended: bool = False
    _open: bytearray = field(default_factory=bytearray)
    _mid: bool = False

    def seconds(self, rate: int = RATE) -> float:
        """The time at the stream's end, from its last granule position."""
        return max([0, *self.ends]) / rate


def read(media: bytes) -> dict[int, Stream]:
    """The logical streams by serial number. Raises ValueError on a bad capture pattern, checksum, sequence number or open packet."""
    streams: dict[int, Stream] = {}
    at = 0
    while at < len(media):
        if media[at : at + 5] != b"OggS\0":
            raise ValueError(f"no page at byte {at}")
        flags, n = media[at + 5], media[at + 26]
        granule = int.from_bytes(media[at + 6 : at + 14], "little", signed=True)
        serial = int.from_bytes(media[at + 14 : at + 18], "little")
        number = int.from_bytes(media[at + 18 : at + 22], "little")
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if len(lacing) < n or end > len(media):
            raise ValueError(f"the page at byte {at} is cut off")
        if page_checksum(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != int.from_bytes(media[at + 22 : at + 26], "little"):
            raise ValueError(f"the page at byte {at} has a wrong checksum")
        s = streams.get(serial)
        if s is None:
            if not flags & 2:
                raise ValueError(f"stream {serial} lacks its first page")
            s = streams[serial] = Stream(serial)
        if number != s.pages or s.ended:
            raise ValueError(f"stream {serial}: page {number} where {s.pages} is due")
        if bool(flags & 1) != s._mid:
            raise ValueError(f"stream {serial}, page {number}: the continued flag is wrong")
        s.pages += 1
        pos = at + 27 + n
        whole = len(s.packets)
        run = 0
        for v in lacing:
            run += v
            s._mid = True
            if v < 255:
                s._open += media[pos : pos + run]
                s.packets.append(bytes(s._open))
                s._open.clear()
                pos += run
                run, s._mid = 0, False
        s._open += media[pos : pos + run]
        s.ends += [granule] * (len(s.packets) - whole)
        s.ended = bool(flags & 4)
        at = end
    for s in streams.values():
        if s._mid or not s.ended:
            raise ValueError(f"stream {s.serial} isn't complete")
    return streams


def encode(text: bytes) -> bytes:
    """The stored form of a text: two multiplexed logical streams."""
    padded = text + b" " * (-len(text) % BLOCK if text else BLOCK)
    sound = [(padded[i : i + PACKET], min(i + PACKET, len(padded))) for i in range(0, len(padded), PACKET)]
    comment = [(b"samples8;rate=%d;bytes=%d" % (RATE, len(text)), 0)]
    return multiplex([paginate(sound, SAMPLES), paginate(comment, COMMENT)])


def decode(media: bytes) -> tuple[bytes, int, float, dict[int, Stream]]:
    """(payload, bytes before padding, seconds, streams) of a stored form."""
    streams = read(media)
    fields = dict(x.split(b"=") for x in streams[COMMENT].packets[0].split(b";")[1:])
    payload = b"".join(streams[SAMPLES].packets)
    if streams[SAMPLES].ends[-1] != len(payload):
        raise ValueError("the last granule position isn't the number of samples")
    return payload, int(fields[b"bytes"]), streams[SAMPLES].seconds(int(fields[b"rate"])), streams


def features(payload: bytes, seconds: float, streams: dict[int, Stream]) -> str:
    x = np.frombuffer(payload, dtype=np.uint8)
    counts = np.bincount(x, minlength=256)
    total = int(np.dot(counts, np.arange(256)))
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    return f"seconds={seconds:.6f};packets={len(streams[SAMPLES].packets)};pages={sum(s.pages for s in streams.values())};sum={total};peak={int(x.max())};distinct={int(np.count_nonzero(counts))};crossings={crossings}"


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def to_media(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) as (doc_id, media binary): each text's stored form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([encode(t) for t in utf8(b.column(1))], pa.binary())], ["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(thrifty(run), "doc_id long, media binary")


def describe(media: DataFrame) -> DataFrame:
    """What is read back from (doc_id, media): lengths, digests, checks and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(7)]
            for m in b.column(1).to_pylist():
                payload, n, seconds, streams = decode(m)
                for out, v in zip(rows, (n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(m), hashlib.sha256(m).hexdigest(), features(payload, seconds, streams)), strict=True):
                    out.append(v)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(v, k) for v, k in zip(rows, kinds, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.select("doc_id", "media").mapInArrow(thrifty(run), SCHEMA)
