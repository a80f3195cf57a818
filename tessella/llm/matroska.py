"""Matroska media columns: a writer, and a parser of EBML elements, clusters, lacing and cues into packet tables.

``parse`` reads any Matroska file with the elements below, with known or unknown sizes of Segment and Cluster, SimpleBlocks and
BlockGroups, and the four kinds of lacing; other elements are skipped by their size. A packet has its track, timestamp,
cluster, keyframe flag and the byte range in the file, so that payloads are slices of the file.

Edge cases: null text counts as empty; its payload is one frame of bytes 255. Broken files raise ``ValueError``.
Repeated rows give equal values. An empty table gives none. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .batches import freed, renamed, slices
from .store import written

FRAME = 576
RATE = 8000
FRAMES_A_BLOCK = 8
BLOCKS_A_CLUSTER = 64
MOST_OFFSET = (1 << 15) - 1  # milliseconds: a block's time within its cluster is a signed 16-bit number

# Element identifiers, fixed by the Matroska specification.
EBML, DOC_TYPE, DOC_TYPE_VERSION, DOC_TYPE_READ = 0x1A45DFA3, 0x4282, 0x4287, 0x4285
SEGMENT, SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES = 0x18538067, 0x114D9B74, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TIMESTAMP_SCALE, DURATION, MUXING_APP, WRITING_APP = 0x2AD7B1, 0x4489, 0x4D80, 0x5741
TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, DEFAULT_DURATION, FLAG_LACING = 0xAE, 0xD7, 0x73C5, 0x83, 0x86, 0x23E383, 0x9C
AUDIO, SAMPLING, CHANNELS, BIT_DEPTH = 0xE1, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
VOID, CRC32 = 0xEC, 0xBF
TOP_LEVEL = {SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, SEGMENT, 0x1043A770, 0x1941A469, 0x1254C367}


def vint(value: int, width: int = 0) -> bytes:
    """A variable-length size; the all-ones pattern means unknown and is avoided."""
    n = width or next(n for n in range(1, 9) if value < (1 << 7 * n) - 1)
    return (value | 1 << 7 * n).to_bytes(n, "big")


def element(ident: int, data: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + vint(len(data)) + data


def uint(ident: int, value: int) -> bytes:
    return element(ident, value.to_bytes(max(1, (value.bit_length() + 7) // 8), "big"))


def real(ident: int, value: float) -> bytes:
    import struct

    return element(ident, struct.pack(">d", value))


def laced(frames: list[bytes], kind: str) -> tuple[int, bytes]:
    """Lacing bits of the flags, and the block's content after them."""
    if len(frames) == 1 or kind == "none":
        return 0, b"".join(frames)
    sizes, count = [len(x) for x in frames], bytes([len(frames) - 1])
    if kind == "fixed":
        if len(set(sizes)) > 1:
            raise ValueError("fixed lacing needs equal frames")
        return 0x04, count + b"".join(frames)
    if kind == "xiph":
        return 0x02, count + b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1]) + b"".join(frames)
    if kind == "ebml":
        head = vint(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            d = b - a
            n = next(n for n in range(1, 9) if abs(d) < (1 << 7 * n - 1) - 1)
            head += vint(d + (1 << 7 * n - 1) - 1, n)
        return 0x06, count + head + b"".join(frames)
    raise ValueError(f"unknown lacing {kind}")


def mux(payload: bytes, frame: int = FRAME, rate: int = RATE, lacing: str = "fixed", frames_a_block: int = FRAMES_A_BLOCK, blocks_a_cluster: int = BLOCKS_A_CLUSTER, groups: bool = False) -> bytes:
    """A Matroska file with one track of 8-bit PCM samples, cues for every cluster, and ``payload`` unchanged in its frames.

    A cluster ends after ``blocks_a_cluster`` blocks, or before one whose time in it would exceed ``MOST_OFFSET``.
    """
    frames = [payload[i : i + frame] for i in range(0, len(payload), frame)]
    tick = lambda n: n * frame * 1000 // rate  # noqa: E731  milliseconds at frame n
    info = element(INFO, uint(TIMESTAMP_SCALE, 1_000_000) + real(DURATION, float(len(payload) * 1000 / rate)) + element(MUXING_APP, b"tessella") + element(WRITING_APP, b"tessella"))
    audio = element(AUDIO, real(SAMPLING, float(rate)) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))
    track = uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(FLAG_LACING, 1) + element(CODEC_ID, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, frame * 1_000_000_000 // rate) + audio
    tracks = element(TRACKS, element(TRACK_ENTRY, track))
    clusters, cues, at = [], [], len(info) + len(tracks)
    per = frames_a_block * blocks_a_cluster
    c = 0
    while c < len(frames):
        start, blocks, end = tick(c), [], min(c + per, len(frames))
        while c < end and tick(c) - start <= MOST_OFFSET:
            some = frames[c : min(c + frames_a_block, end)]
            bits, content = laced(some, lacing)
            block = vint(1) + (tick(c) - start).to_bytes(2, "big", signed=True) + bytes([bits | (0 if groups else 0x80)]) + content
            blocks.append(element(BLOCK_GROUP, element(BLOCK, block)) if groups else element(SIMPLE_BLOCK, block))
            c += len(some)
        cluster = element(CLUSTER, uint(TIMESTAMP, start) + b"".join(blocks))
        cues.append(element(CUE_POINT, uint(CUE_TIME, start) + element(CUE_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER, at))))
        clusters.append(cluster)
        at += len(cluster)
    head = element(EBML, element(DOC_TYPE, b"matroska") + uint(DOC_TYPE_VERSION, 4) + uint(DOC_TYPE_READ, 2))
    return head + element(SEGMENT, info + tracks + b"".join(clusters) + element(CUES, b"".join(cues)))


@dataclass
class Media:
    """packets: (track, timestamp in ns, cluster, keyframe, start, length); cues: (timestamp in ns, track, the cluster it points at)."""

    scale: int = 1_000_000
    duration: float = 0.0
    tracks: dict[int, dict] = field(default_factory=dict)
    clusters: list[int] = field(default_factory=list)
    packets: list[tuple[int, int, int, bool, int, int]] = field(default_factory=list)
    cues: list[tuple[int, int, int]] = field(default_factory=list)


def _vint(data: bytes, at: int, marker: bool = False) -> tuple[int, int]:
    """(value, the place after it) of an identifier (with its marker) or size; an unknown size is -1."""
    if at >= len(data) or not data[at]:
        raise ValueError(f"no variable-length integer at byte {at}")
    n = 9 - data[at].bit_length()
    value = int.from_bytes(data[at : at + n], "big")
    if at + n > len(data):
        raise ValueError("the file ends within an integer")
    if marker:
        return value, at + n
    value &= (1 << 7 * n) - 1
    return (-1 if value == (1 << 7 * n) - 1 else value), at + n


def children(data: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(identifier, start, end) of the elements of a range. One of unknown size ends before the next element that can't be in it."""
    while at < end:
        ident, at = _vint(data, at, True)
        size, at = _vint(data, at)
        stop = at + size
        if size < 0:
            if ident not in (SEGMENT, CLUSTER):
                raise ValueError("unknown size of an element that must have one")
            stop = at
            for inner, a, b in children(data, at, end) if ident == CLUSTER else ():
                if inner in TOP_LEVEL:
                    break
                stop = b
            stop = stop if ident == CLUSTER else end
        if stop > end:
            raise ValueError(f"element {ident:x} goes beyond its parent")
        yield ident, at, stop
        at = stop


def _block(data: bytes, at: int, end: int) -> tuple[int, int, int, list[tuple[int, int]]]:
    """Track, relative timestamp, flags, and the byte ranges of the frames."""
    track, at = _vint(data, at)
    time, flags = int.from_bytes(data[at : at + 2], "big", signed=True), data[at + 2]
    at += 3
    kind = flags & 0x06
    if not kind:
        return track, time, flags, [(at, end - at)]
    n = data[at] + 1
    at += 1
    if kind == 0x04:
        size, over = divmod(end - at, n)
        if over:
            raise ValueError("fixed lacing of unequal frames")
        return track, time, flags, [(at + k * size, size) for k in range(n)]
    sizes: list[int] = []
    for k in range(n - 1):
        if kind == 0x02:
            size = 0
            while True:
                size += data[at]
                at += 1
                if data[at - 1] != 255:
                    break
        elif not k:
            size, at = _vint(data, at)
        else:
            first = at
            raw, at = _vint(data, at)
            size = sizes[-1] + raw - ((1 << 7 * (at - first) - 1) - 1)
        sizes.append(size)
    sizes.append(end - at - sum(sizes))
    if min(sizes) < 0:
        raise ValueError("laced frames go beyond their block")
    ranges = []
    for size in sizes:
        ranges.append((at, size))
        at += size
    return track, time, flags, ranges


def parse(data: bytes) -> Media:
    number = lambda a, b: int.from_bytes(data[a:b], "big")
    top = list(children(data, 0, len(data)))
    if not top or top[0][0] != EBML or not any(i == SEGMENT for i, _, _ in top):
        raise ValueError("not an EBML file with a Segment")
    base, stop = next((a, b) for i, a, b in top if i == SEGMENT)
    out, starts, cues = Media(), {}, []
    before = base
    for ident, a, b in children(data, base, stop):
        if ident == INFO:
            for i, x, y in children(data, a, b):
                if i == TIMESTAMP_SCALE:
                    out.scale = number(x, y)
                elif i == DURATION:
                    import struct

                    out.duration = struct.unpack(">d" if y - x == 8 else ">f", data[x:y])[0]
        elif ident == TRACKS:
            for i, x, y in children(data, a, b):
                if i == TRACK_ENTRY:
                    entry = {j: data[p:q] for j, p, q in children(data, x, y)}
                    out.tracks[int.from_bytes(entry[TRACK_NUMBER], "big")] = {"codec": entry.get(CODEC_ID, b"").decode(), "duration": int.from_bytes(entry.get(DEFAULT_DURATION, b""), "big"), "type": int.from_bytes(entry.get(TRACK_TYPE, b""), "big")}
        elif ident == CLUSTER:
            starts[before - base] = k = len(out.clusters)
            stamp = 0
            out.clusters.append(before - base)
            for i, x, y in children(data, a, b):
                if i == TIMESTAMP:
                    stamp = number(x, y)
                    continue
                key = None
                if i == BLOCK_GROUP:
                    inner = {j: (p, q) for j, p, q in children(data, x, y)}
                    if BLOCK not in inner:
                        continue
                    key = REFERENCE not in inner
                    x, y = inner[BLOCK]
                elif i != SIMPLE_BLOCK:
                    continue
                track, time, flags, ranges = _block(data, x, y)
                each = out.tracks.get(track, {}).get("duration", 0)
                out.packets += [(track, (stamp + time) * out.scale + n * each, k, bool(flags & 0x80) if key is None else key, p, q) for n, (p, q) in enumerate(ranges)]
        elif ident == CUES:
            for i, x, y in children(data, a, b):
                if i == CUE_POINT:
                    point = {j: (p, q) for j, p, q in children(data, x, y)}
                    where = {j: number(p, q) for j, p, q in children(data, *point[CUE_POSITIONS])}
                    cues.append((number(*point[CUE_TIME]), where.get(CUE_TRACK, 0), where[CUE_CLUSTER]))
        before = b
    out.cues = [(t * out.scale, track, starts.get(at, -1)) for t, track, at in cues]
    return out


def padded(data: bytes, frame: int = FRAME) -> bytes:
    return data + b"\xff" * (frame - len(data) % frame if len(data) % frame or not data else 0)


def media_table(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, media`` of ``docs (doc_id, text)``: each text's UTF-8 bytes as 8-bit samples of a Matroska file."""

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                texts = [(x or "").encode() for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(map(len, texts), pa.int64()), pa.array([mux(padded(x)) for x in texts], pa.binary())], ["doc_id", "n_bytes", "media"])

    return renamed(docs, "doc_id", "text").mapInArrow(freed(store), "doc_id long, n_bytes long, media binary")


def packet_table(media: DataFrame) -> DataFrame:
    """One row a packet of a table with ``doc_id, media``."""

    def packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "track", "timestamp_ns", "cluster", "keyframe", "start", "length", "cued"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_()]
        for batch in batches:
            for part in slices(batch, "media", 4 << 20):
                rows = []
                for doc, data in zip(part.column("doc_id").to_pylist(), part.column("media").to_pylist()):
                    m = parse(data) if data else Media()
                    cued = {(k, t) for t, _, k in m.cues}
                    rows += [(doc, *p, (p[2], p[1]) in cued) for p in m.packets]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, types)], names)

    return renamed(media, "doc_id", "media").mapInArrow(freed(packets), "doc_id long, track long, timestamp_ns long, cluster long, keyframe boolean, start long, length long, cued boolean")


def features(data: bytes, media: Media, payload: bytes) -> str:
    """What the packets say: how many, where clusters begin and cues lead, the length, and level and zero crossings of the samples."""
    import numpy as np

    samples = np.frombuffer(payload, np.uint8).astype(np.int16) - 128
    crossings = int(np.count_nonzero(np.diff(np.signbit(samples))))
    level = float(np.sqrt(np.mean(samples.astype(np.float64) ** 2))) if len(samples) else 0.0
    last = max((t for _, t, *_ in media.packets), default=0)
    good = sum(k >= 0 for *_, k in media.cues)
    table = zlib.crc32(repr(media.packets).encode())
    return f"packets={len(media.packets)};clusters={len(media.clusters)};cues={good}/{len(media.cues)};last_ms={last // 1_000_000};duration_ms={media.duration:.0f};rms={level:.3f};crossings={crossings};table={table:08x}"


def media_features(media: DataFrame) -> DataFrame:
    """The digest of each stored file: payloads are put together again from the packets' byte ranges."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])
        for batch in batches:
            for part in slices(batch, "media", 4 << 20):
                rows = []
                for doc, n, data in zip(*[part.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media")]):
                    m = parse(data)
                    payload = b"".join([data[a : a + b] for _, _, _, _, a, b in m.packets])
                    rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), features(data, m, payload)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 8, schema)], schema=schema)

    return media.mapInArrow(freed(digest), "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_features(written(media_table(spark.read.parquet(f"{sf_dir}/documents.parquet")), "media"))
