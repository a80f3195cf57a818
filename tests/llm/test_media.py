"""Matroska: round trips through every kind of lacing, sizes, groups and cues; broken files."""

import hashlib
import random
import zlib

import pytest

from tessella.llm import matroska as M


def frames_of(data, m):
    return [data[a : a + b] for _, _, _, _, a, b in m.packets]


@pytest.mark.parametrize("lacing", ["none", "fixed", "xiph", "ebml"])
@pytest.mark.parametrize("groups", [False, True])
def test_mux_and_parse(lacing, groups):
    rng = random.Random(1)
    for size in (1, 575, 576, 577, 576 * 700, 40_000):
        payload = rng.randbytes(size)
        if lacing == "fixed":
            payload = M.padded(payload)
        data = M.mux(payload, lacing=lacing, groups=groups, frames_a_block=1 if lacing == "none" else 8, blocks_a_cluster=16)
        m = M.parse(data)
        assert b"".join(frames_of(data, m)) == payload
        assert [t for _, t, *_ in m.packets] == [k * 72_000_000 for k in range(len(m.packets))]
        assert m.tracks[1]["codec"] == "A_PCM/INT/LIT" and all(p[3] for p in m.packets)
        assert [k for *_, k in m.cues] == list(range(len(m.clusters))) and [t for t, _, _ in m.cues] == [min(p[1] for p in m.packets if p[2] == k) for k in range(len(m.clusters))]


@pytest.mark.parametrize("size", [456 * 576, 456 * 576 + 1, 5_000_000])
def test_long_text(size):
    """With the defaults, a cluster ends before a block's time in it has more than 16 bits."""
    payload = M.padded(random.Random(3).randbytes(size))
    data = M.mux(payload)
    m = M.parse(data)
    assert b"".join(frames_of(data, m)) == payload
    assert [t for _, t, *_ in m.packets] == [k * 72_000_000 for k in range(len(m.packets))]
    assert len(m.clusters) == -(-len(payload) // (456 * 576)) and [k for *_, k in m.cues] == list(range(len(m.clusters)))


@pytest.mark.parametrize("lacing", ["xiph", "ebml"])
def test_uneven_frames(lacing):
    rng = random.Random(2)
    frames = [rng.randbytes(n) for n in (300, 255, 1, 0, 5000, 254, 7)]
    bits, content = M.laced(frames, lacing)
    block = M.vint(3) + (-5).to_bytes(2, "big", signed=True) + bytes([bits]) + content
    track, time, flags, ranges = M._block(block, 0, len(block))
    assert (track, time) == (3, -5) and [block[a : a + n] for a, n in ranges] == frames


def test_unknown_sizes_and_other_elements():
    inner = M.uint(M.TIMESTAMP, 40) + M.element(M.VOID, b"12345") + M.element(M.SIMPLE_BLOCK, M.vint(1) + b"\x00\x02\x00abc")
    tracks = M.element(M.TRACKS, M.element(M.TRACK_ENTRY, M.uint(M.TRACK_NUMBER, 1)))
    unknown = b"\x01\xff\xff\xff\xff\xff\xff\xff"
    cluster = M.CLUSTER.to_bytes(4, "big") + unknown + inner
    group = M.element(M.BLOCK_GROUP, M.element(M.BLOCK, M.vint(1) + b"\x00\x03\x00de") + M.element(M.REFERENCE, b"\xff"))
    data = M.element(M.EBML, b"") + M.SEGMENT.to_bytes(4, "big") + unknown + M.element(M.INFO, M.uint(M.TIMESTAMP_SCALE, 1000)) + tracks + cluster + M.element(M.CLUSTER, M.uint(M.TIMESTAMP, 50) + group)
    m = M.parse(data)
    assert [(t, s, k, key, data[a : a + n]) for t, s, k, key, a, n in m.packets] == [(1, 42_000, 0, False, b"abc"), (1, 53_000, 1, False, b"de")]


@pytest.mark.parametrize("data", [b"", b"\x00" * 9, b"hello there", M.element(M.EBML, b""), M.mux(b"x" * 1152)[:-3]])
def test_broken(data):
    with pytest.raises(ValueError):
        M.parse(data)


def test_vint():
    for n in (0, 1, 126, 127, 128, 16382, 16383, 1 << 40):
        assert M._vint(M.vint(n), 0) == (n, len(M.vint(n)))
    assert M._vint(b"\xff", 0) == (-1, 1)


def test_documents(spark):
    texts = [None, "", "a", "é" * 288, "x" * 577, "long " * 30_000, "a"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "n", 1)], "doc_id long, text string, media int")
    media = M.media_table(df)
    rows = {x.doc_id: x for x in M.media_features(media).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + b"\xff" * (576 if not raw else -len(raw) % 576)
        x = rows[i]
        assert (x.n_bytes, x.payload_bytes, x.payload_sha256, x.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert (x.media_bytes, x.media_sha256) == (len(M.mux(payload)), hashlib.sha256(M.mux(payload)).hexdigest())
    assert rows[0][1:] == rows[1][1:] and rows[2][1:] == rows[6][1:] and rows[2].feature != rows[3].feature and None in rows
    packets = M.packet_table(media).where("doc_id = 5").collect()
    assert sum(x.length for x in packets) == rows[5].payload_bytes and [x.cued for x in sorted(packets, key=lambda x: x.start)] == [True] + [False] * (len(packets) - 1)
    assert M.media_features(M.media_table(df.limit(0))).collect() == []
