"""Ogg media columns: pages with checksums, lacing, logical streams and times from granule positions.

``mux`` stores raw 8-bit samples; ``read_pages``, ``packets`` and ``timeline`` read any Ogg bytes.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from riskloom.llm.common import slices

#: Fixed values of the container: capture pattern, page header layout, header flags, largest page body.
CAPTURE, HEADER, CONTINUED, FIRST, LAST, MOST_SEGMENTS = b"OggS", struct.Struct("<4sBBqIIIB"), 1, 2, 4, 255
#: Payload unit, packet size, samples a second of the stored stream, and serial numbers.
UNIT, PACKET, RATE, AUDIO, NOTES = 576, 4 * 576, 8000, 1, 2
HEAD = struct.Struct("<8sBBIQ")
MIRROR = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))


def checksum(data: bytes) -> int:
    """The container's CRC-32 (most significant bit first, starting from 0, not inverted), from the
    mirrored one of zlib over mirrored bytes."""
    c = zlib.crc32(data.translate(MIRROR), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(c.to_bytes(4, "little").translate(MIRROR), "big")


def _page(flags: int, granule: int, serial: int, sequence: int, lacing: bytes, body: bytes) -> bytes:
    head = HEADER.pack(CAPTURE, 0, flags, granule, serial, sequence, 0, len(lacing)) + lacing
    data = head + body
    return data[:22] + checksum(data).to_bytes(4, "little") + data[26:]


def _stream(serial: int, packets: Iterator[tuple[bytes, int, bool]]) -> Iterator[bytes]:
    """Pages of one logical stream from (packet, granule at its end, flush after it). A page is cut at
    255 lacing values, so long packets continue over pages; a page where no packet ends has granule -1."""
    sequence, lacing, body, granule, continued = 0, bytearray(), bytearray(), -1, False
    held: tuple | None = None

    def emit(last: bool):
        nonlocal sequence, lacing, body, granule
        flags = CONTINUED * continued | FIRST * (sequence == 0) | LAST * last
        page = _page(flags, granule, serial, sequence, bytes(lacing), bytes(body))
        sequence, lacing, body, granule = sequence + 1, bytearray(), bytearray(), -1
        return page

    for packet in packets:
        if held is not None:
            yield from held
            held = None
        data, end, flush = packet
        at = 0
        while True:
            piece = min(255, len(data) - at)
            if len(lacing) == MOST_SEGMENTS:
                page = emit(False)
                continued = at > 0
                yield page
            lacing.append(piece)
            body += data[at : at + piece]
            at += piece
            if piece < 255:
                break
        granule = end
        if flush:
            page = emit(False)
            continued = False
            held = (page,)
    if held is not None and not lacing:  # the last page carries the end mark
        yield _marked_last(held[0])
    else:
        if held is not None:
            yield from held
        yield emit(True)


def _marked_last(page: bytes) -> bytes:
    data = page[:5] + bytes([page[5] | LAST]) + page[6:22] + bytes(4) + page[26:]
    return data[:22] + checksum(data).to_bytes(4, "little") + data[26:]


def mux(payload: bytes, n_bytes: int) -> bytes:
    """Two logical streams: samples in packets of 2,304 bytes, and a comment with the unpadded length.
    The first pages of both streams come before all others, as multiplexing asks."""

    def audio():
        yield HEAD.pack(b"RAWSAMP8", 1, 1, RATE, len(payload)), 0, True
        for i in range(0, len(payload), PACKET):
            part = payload[i : i + PACKET]
            yield part, i + len(part), False

    def notes():
        yield HEAD.pack(b"NOTES\0\0\0", 1, 1, 1, n_bytes), 0, True
        yield f"n_bytes={n_bytes}".encode(), 1, False

    a, n = list(_stream(AUDIO, audio())), list(_stream(NOTES, notes()))
    return b"".join([a[0], n[0], *n[1:], *a[1:]])


@dataclass
class Page:
    flags: int
    granule: int
    serial: int
    sequence: int
    lacing: bytes
    body: memoryview


def read_pages(data: bytes) -> Iterator[Page]:
    """Pages whose checksum holds, in order. Where the bytes at hand are no whole, sound page, reading
    goes on at the next capture pattern, so damage costs the damaged pages only."""
    view, at = memoryview(data), 0
    while 0 <= (at := data.find(CAPTURE, at)):
        if at + HEADER.size > len(data):
            return
        _, version, flags, granule, serial, sequence, crc, n = HEADER.unpack_from(data, at)
        body = at + HEADER.size + n
        lacing = data[at + HEADER.size : body]
        end = body + sum(lacing)
        if version or len(lacing) < n or end > len(data) or checksum(b"".join((view[at : at + 22], bytes(4), view[at + 26 : end]))) != crc:
            at += 1
            continue
        yield Page(flags, granule, serial, sequence, lacing, view[body:end])
        at = end


@dataclass
class Packet:
    serial: int
    data: bytes
    granule: int | None  # of the page, for the last packet that ends on it
    page: int


def packets(data: bytes) -> Iterator[Packet]:
    """Packets of all logical streams. A packet ends at a lacing value under 255 and may continue over
    pages of its stream; after a lost page its remains are dropped."""
    parts: dict[int, list[bytes]] = {}
    expected: dict[int, int] = {}
    for p in read_pages(data):
        lost = expected.get(p.serial, p.sequence) != p.sequence
        expected[p.serial] = p.sequence + 1
        skip = False
        if p.flags & CONTINUED:
            skip = lost or not parts.get(p.serial)
        if skip or not p.flags & CONTINUED:
            parts[p.serial] = []
        done, at = [], 0
        for v in p.lacing:
            parts[p.serial].append(p.body[at : at + v])
            at += v
            if v < 255:
                if not skip:
                    done.append(b"".join(parts[p.serial]))
                skip, parts[p.serial] = False, []
        if skip:
            parts[p.serial] = []
        for i, d in enumerate(done):
            yield Packet(p.serial, d, p.granule if i == len(done) - 1 and p.granule >= 0 else None, p.sequence)


def demux(data: bytes) -> dict[int, list[Packet]]:
    """Packets by logical stream."""
    out: dict[int, list[Packet]] = {}
    for p in packets(data):
        out.setdefault(p.serial, []).append(p)
    return out


def timeline(stream: list[Packet], rate: int) -> list[tuple[float, float]]:
    """Start and end in seconds of each data packet. Only the last packet that ends on a page has a
    granule position; earlier ones are counted back from it, one sample per byte."""
    ends: list[int] = [0] * len(stream)
    at = None
    for i in range(len(stream) - 1, -1, -1):
        at = stream[i].granule if stream[i].granule is not None else at
        ends[i] = at if at is not None else 0
        at = ends[i] - len(stream[i].data)
    return [((e - len(p.data)) / rate, e / rate) for p, e in zip(stream, ends, strict=True)]


def store(text: str | None) -> tuple[bytes, int]:
    """A text's Ogg bytes and its unpadded length in UTF-8."""
    raw = (text or "").encode()
    n = max(1, -(-len(raw) // UNIT)) * UNIT
    return mux(raw.ljust(n, b"\xff"), len(raw)), len(raw)


def load(media: bytes) -> tuple[bytes, int, str]:
    """Payload, unpadded length and features read from Ogg bytes."""
    streams = demux(media)
    head, *body = streams[AUDIO]
    _, _, channels, rate, samples = HEAD.unpack(head.data)
    payload = b"".join(p.data for p in body)
    if len(payload) != samples:
        raise ValueError(f"{len(payload)} of {samples} samples could be read")
    n_bytes = int(streams[NOTES][1].data.partition(b"=")[2])
    times = timeline(body, rate)
    pages = 1 + max(p.page for p in body)
    mean, level = sum(payload) / len(payload), len(set(payload))
    feature = f"streams={len(streams)};pages={pages};packets={len(body)};rate={rate};channels={channels};seconds={times[-1][1]:.6f};last_start={times[-1][0]:.6f};mean={mean:.6f};levels={level}"
    return payload, n_bytes, feature


MEDIA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
MEDIA_DDL = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def column(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each text stored as Ogg bytes in a media column; null counts as empty."""

    def run(batches):
        for b in slices(batches, 256):
            made = [store(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([m for m, _ in made], pa.binary())], names=["doc_id", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, media binary")


def features(media: DataFrame) -> DataFrame:
    """What the stored bytes of (doc_id, media) hold, one row each; null media gives no row's values but
    doc_id. Equal bytes give equal values."""

    def run(batches):
        for b in slices(batches, 256):
            out = []
            for i, m in zip(b.column("doc_id").to_pylist(), b.column("media").to_pylist(), strict=True):
                if m is None:
                    out.append((i, *[None] * 7))
                    continue
                payload, n, feature = load(m)
                out.append((i, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(m), hashlib.sha256(m).hexdigest(), feature))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), MEDIA, strict=True)], schema=MEDIA)

    return media.mapInArrow(run, MEDIA_DDL)
