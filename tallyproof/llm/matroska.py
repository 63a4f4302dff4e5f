"""Matroska media columns: write, parse and describe EBML documents.

``mux`` stores a payload as 8-bit PCM samples in SimpleBlocks (Xiph, fixed-size
and EBML lacing are all used) inside clusters, followed by cues.  ``demux``
walks variable-length EBML elements, unknown sizes included, and yields one
packet per laced frame with its track, timestamp and byte range.

Defined results: a null text counts as empty; an empty payload is 64 zero
bytes; equal texts give equal rows, keys null or repeated included; an empty table gives no rows; other columns of the input are ignored and
may have any name; a malformed file is a row with its error.  Each row stands alone, so there is no shuffle, no state
between rows, and a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyproof.llm.storage import lean

# Fixed values of the container format (element ids).
EBML, SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0xAE, 0xE1
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1
CUES, CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
TIMESTAMP_SCALE, TRACK_NUMBER, TRACK_TYPE, TRACK_UID, CODEC_ID = 0x2AD7B1, 0xD7, 0x83, 0x73C5, 0x86
SAMPLING, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0xB5, 0x9F, 0x6264, 0x23E383
MASTERS = frozenset({SEGMENT, INFO, TRACKS, TRACK_ENTRY, AUDIO, CLUSTER, BLOCK_GROUP, CUES, CUE_POINT, CUE_POSITIONS})
#: Elements that can only follow, never lie inside, a cluster of unknown size.
TOP = frozenset({CLUSTER, CUES, INFO, TRACKS})

RATE = 8000  # samples, that is bytes, a second: 8 a millisecond
FRAME = 512  # bytes in a frame
LACED = 8  # frames in a block
BLOCKS = 16  # blocks in a cluster


def vint(n: int, width: int = 0) -> bytes:
    """A size as an EBML variable-length integer; all ones is kept for 'unknown'."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(body)) + body


def uint(ident: int, n: int) -> bytes:
    return element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def laced(frames: list[bytes], scheme: int) -> bytes:
    """The lacing head and frames; scheme 0 none, 1 Xiph, 2 fixed size, 3 EBML."""
    if scheme == 0:
        return frames[0]
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if scheme == 1:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif scheme == 3:
        head += vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            step = b - a
            width = next(w for w in range(1, 9) if abs(step) < (1 << 7 * w - 1))
            head += vint(step + (1 << 7 * width - 1) - 1, width)
    return head + b"".join(frames)


def payload_of(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + b"\0" * (-len(raw) % 64 if raw else 64)


def mux(payload: bytes) -> bytes:
    """A whole Matroska file whose single PCM track holds ``payload``."""
    frames = [payload[i : i + FRAME] for i in range(0, len(payload), FRAME)]
    head = element(EBML, uint(0x4286, 1) + uint(0x42F7, 1) + uint(0x42F2, 4) + uint(0x42F3, 8) + element(0x4282, b"matroska") + uint(0x4287, 4) + uint(0x4285, 2))
    audio = element(AUDIO, element(SAMPLING, np.array(RATE, ">f4").tobytes()) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    body = [element(INFO, uint(TIMESTAMP_SCALE, 1_000_000)), element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + element(CODEC_ID, b"A_PCM/INT/LIT") + audio))]
    at, cues = sum(map(len, body)), []
    per = LACED * BLOCKS
    for c in range(0, len(frames), per):
        start = c * FRAME * 1000 // RATE
        parts = [uint(TIMESTAMP, start)]
        for b, i in enumerate(range(c, min(c + per, len(frames)), LACED)):
            group = frames[i : i + LACED]
            even = len({len(f) for f in group}) == 1
            scheme = 0 if len(group) == 1 else (2, 1, 3)[b % 3] if even else (1, 3)[b % 2]
            offset = i * FRAME * 1000 // RATE - start
            parts.append(element(SIMPLE_BLOCK, b"\x81" + offset.to_bytes(2, "big", signed=True) + bytes([0x80 | scheme << 1]) + laced(group, scheme)))
        cluster = element(CLUSTER, b"".join(parts))
        cues.append(element(CUE_POINT, uint(CUE_TIME, start) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        body.append(cluster)
        at += len(cluster)
    body.append(element(CUES, b"".join(cues)))
    return head + element(SEGMENT, b"".join(body))


def read_ident(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4:
        raise ValueError(f"no element id at byte {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def read_vint(data: bytes, at: int) -> tuple[int | None, int]:
    """A variable-length integer, None if all its bits are ones (unknown size)."""
    width = 9 - data[at].bit_length()
    if width > 8:
        raise ValueError(f"no size at byte {at}")
    n = int.from_bytes(data[at : at + width], "big") - (1 << 7 * width)
    return (None if n == (1 << 7 * width) - 1 else n), at + width


def elements(data: bytes, at: int = 0, end: int | None = None, inside: int = 0) -> Iterator[tuple[int, int, int, int]]:
    """(id, element start, body start, body end) in file order, masters before what they hold."""
    end = len(data) if end is None else end
    while at < end:
        start = at
        ident, at = read_ident(data, at)
        if inside == CLUSTER and ident in TOP:
            return  # a cluster of unknown size ends here
        size, at = read_vint(data, at)
        if size is None and ident not in MASTERS:
            raise ValueError(f"element at byte {start} has no size")
        stop = end if size is None else at + size
        if stop > end:
            raise ValueError(f"element at byte {start} runs past its parent")
        yield ident, start, at, stop
        if ident in MASTERS:
            last = at
            for found in elements(data, at, stop, ident if size is None else 0):
                yield found
                last = max(last, found[3] if found[0] not in MASTERS else found[2])
            if size is None:
                stop = last
        at = stop


def split_lacing(data: bytes, at: int, end: int, scheme: int) -> list[tuple[int, int]]:
    """Byte ranges of a block's frames."""
    if scheme == 0:
        return [(at, end)]
    n, at = data[at] + 1, at + 1
    if scheme == 2:
        if (end - at) % n:
            raise ValueError("fixed lacing does not divide the block")
        sizes = [(end - at) // n] * n
    else:
        sizes = []
        for k in range(n - 1):
            if scheme == 1:
                size = 0
                while data[at] == 255:
                    size, at = size + 255, at + 1
                size, at = size + data[at], at + 1
            else:
                width = 9 - data[at].bit_length()
                size, at = read_vint(data, at)
                size = (1 << 7 * width) - 1 if size is None else size
                if k:
                    size += sizes[-1] - (1 << 7 * width - 1) + 1
            sizes.append(size)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laced sizes exceed the block")
    ranges = []
    for size in sizes:
        ranges.append((at, at + size))
        at += size
    return ranges


class Track:
    """What a track entry says of its packets' duration."""

    def __init__(self) -> None:
        self.number, self.rate, self.channels, self.bits, self.duration, self.codec = 0, 0.0, 1, 0, 0, b""

    def nanoseconds(self, frames: int, size: int) -> int:
        """How long ``frames`` frames of ``size`` bytes in all last: by the default duration, or as samples."""
        if self.duration:
            return frames * self.duration
        if self.codec.startswith(b"A_PCM") and self.rate > 0 and self.bits:
            return round(size * 8 * 1_000_000_000 / (self.bits * self.channels * self.rate))
        return 0


def real(raw: bytes) -> float:
    """An EBML float of 0, 4 or 8 bytes."""
    return float(np.frombuffer(raw, {4: ">f4", 8: ">f8"}[len(raw)])[0]) if raw else 0.0


def demux(data: bytes) -> tuple[list[tuple[int, int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Packets (track, timestamp ms, first byte, length, lacing, cluster) and cues (time, track, cluster byte).

    Timestamps follow the file's scale; the later frames of a lace follow the track's default duration, or its sampling.
    """
    packets, cues = [], []
    base = origin = 0
    scale = 1_000_000
    cluster = -1
    num = lambda a, b: int.from_bytes(data[a:b], "big")
    cue = [0, 0]
    tracks: dict[int, Track] = {}
    track = Track()
    for ident, start, at, stop in elements(data):
        if ident == SEGMENT:
            origin = at
        elif ident == TIMESTAMP_SCALE:
            scale = num(at, stop)
        elif ident == TRACK_ENTRY:
            track = Track()
        elif ident == TRACK_NUMBER:
            tracks[num(at, stop)] = track
        elif ident == DEFAULT_DURATION:
            track.duration = num(at, stop)
        elif ident == CODEC_ID:
            track.codec = data[at:stop]
        elif ident == SAMPLING:
            track.rate = real(data[at:stop])
        elif ident == CHANNELS:
            track.channels = max(1, num(at, stop))
        elif ident == BIT_DEPTH:
            track.bits = num(at, stop)
        elif ident == CLUSTER:
            cluster = start - origin
        elif ident == TIMESTAMP:
            base = num(at, stop)
        elif ident in (SIMPLE_BLOCK, BLOCK):
            number, at = read_vint(data, at)
            if number is None or at + 3 > stop:
                raise ValueError(f"block at byte {start} is cut")
            offset, flags = int.from_bytes(data[at : at + 2], "big", signed=True), data[at + 2]
            scheme, size = flags >> 1 & 3, 0
            of = tracks.get(number) or Track()
            for n, (a, b) in enumerate(split_lacing(data, at + 3, stop, scheme)):
                packets.append((number, ((base + offset) * scale + of.nanoseconds(n, size)) // 1_000_000, a, b - a, scheme, cluster))
                size += b - a
        elif ident == CUE_TIME:
            cue[0] = num(at, stop)
        elif ident == CUE_TRACK:
            cue[1] = num(at, stop)
        elif ident == CUE_CLUSTER:
            cues.append((cue[0], cue[1], num(at, stop)))
    return packets, cues


def parsed(data: bytes | None) -> tuple[list[tuple[int, int, int, int, int, int]], str | None]:
    """Packets of a file, and why it could not be read to its end; no file has none of either."""
    try:
        return (demux(data)[0] if data else []), None
    except (ValueError, IndexError, KeyError, OverflowError, RecursionError) as error:
        return [], f"{type(error).__name__}: {error}"


def describe(packets: list, cues: list, payload: bytes) -> str:
    """Features of the packet table and of the samples that were read back."""
    samples = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    share = samples[samples > 0] / len(payload)
    entropy = abs(float(-(share * np.log2(share)).sum()))
    lacing = [0, 0, 0, 0]
    for p in packets:
        lacing[p[4]] += 1
    clusters = {p[5] for p in packets}
    found = sum(c[2] in clusters for c in cues)
    ms = len(payload) * 1000 // RATE
    mean = math.floor(float(np.arange(256) @ samples) / len(payload) * 100 + 0.5) / 100
    return f"packets={len(packets)};clusters={len(clusters)};cues={found}/{len(cues)};ms={ms};lacing={','.join(map(str, lacing))};mean={mean:.2f};entropy={entropy:.4f};zeros={int(samples[0])}"


SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
PACKETS = "track long, timestamp_ms long, first_byte long, length long, lacing int, cluster_byte long, error string"


def media_row(text: str | None) -> tuple:
    raw = len((text or "").encode("utf-8", "surrogatepass"))
    media = mux(payload_of(text))
    packets, cues = demux(media)
    read = b"".join(media[a : a + n] for _, _, a, n, _, _ in packets)
    return raw, len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-64:]), len(media), hashlib.sha256(media).hexdigest(), describe(packets, cues, read)


def media_columns(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_media: bool = False) -> DataFrame:
    """One row per input row: the key, the digests of SCHEMA and, if asked for, the file itself as ``media``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                columns = list(zip(*map(media_row, texts)))
                arrays = [part.column(0), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())))]
                names = [key, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
                if keep_media:
                    arrays.append(pa.array([mux(payload_of(t)) for t in texts], pa.binary()))
                    names.append("media")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(lean(run), f"`{key}` {kind}, {SCHEMA}" + ", media binary" * keep_media)


def packet_table(media: DataFrame, key: str = "doc_id", column: str = "media") -> DataFrame:
    """One row per packet of each stored file: track, timestamp, byte range, lacing and cluster.

    A file that can't be read to its end is one row that says why in ``error``, and stops no other; a null or empty one has no rows.
    """
    kind = media.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, rows = [], []
                for k, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found, error = parsed(data)
                    found = [(*x, None) for x in found] if error is None else [(None, None, None, None, None, None, error)]
                    keys += [k] * len(found)
                    rows += found
                columns = list(zip(*rows)) or [[]] * 7
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(keys, part.schema.field(0).type), *(pa.array(c, t) for c, t in zip(columns, types))], [key, "track", "timestamp_ms", "first_byte", "length", "lacing", "cluster_byte", "error"])

    return media.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{column}`").alias("_media")).mapInArrow(lean(run), f"`{key}` {kind}, {PACKETS}")
