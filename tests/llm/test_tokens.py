"""Encoding, flat files, token files and packing: against the library, brute force and round trips."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessella.llm import elias_fano, packing, separator_scan
from tessella.llm.store import AtomicFile, scratch
from tessella.llm.tokens import Encoder, public_path

ODD = ["", None, " a", "a ", "a  b", "x\n y", "\n\n a", "don't 's  <|endoftext|>", "a <|endoftext|> b", "a\0b \0c", "é—ü 12,3.", "a.\nB c.\n\nd", "The cat, sat. The cat. Straße Ünï!", "日本語 テスト,", "# ! # !", " x  y", "i̇ ǅ ª º. ʰ", "tab\tx \t y\r\n z"]
SCHEMA = "doc_id long, text string, Text2 string"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_path())
    t.encode_special_tokens = True
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def encoded(encoder, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_odd_texts(library):
    encoder = Encoder()
    for _ in range(2):  # the second time from the cache
        assert encoded(encoder, ODD) == [library(x) for x in ODD]
    small = Encoder(max_cached=3)
    assert encoded(small, ODD) == [library(x) for x in ODD]
    assert encoded(encoder, []) == []


@settings(max_examples=150, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab cé.,!\n'#1 \t ßʰ日")), max_size=24), max_size=4))
def test_any_text(library, texts):
    encoder = test_any_text.__dict__.setdefault("encoder", Encoder())
    assert encoded(encoder, texts) == [library(x) for x in texts]


def documents(spark, repeat=1):
    rows = [(i, t, "z") for i, t in enumerate([*ODD, "word " * 3000 + "x", "the cat sat on the mat\n" * 400])]
    return spark.createDataFrame(rows * repeat, SCHEMA).toDF("doc_id", "text", "TEXT").repartition(3), rows * repeat


def test_token_counts(spark, library):
    df, rows = documents(spark, 2)
    got = sorted(tuple(x) for x in separator_scan.token_counts(df, block_bytes=64).collect())
    assert got == sorted((i, len(library(t)) + 1) for i, t, _ in rows)
    assert separator_scan.token_counts(df.limit(0)).collect() == []


def test_separator_scan_of_any_file(spark):
    folder = scratch(spark, "scan")
    rng = np.random.default_rng(1)
    want, files = set(), []
    for k, n in enumerate((0, 1, 5, 700, 3000)):
        data = rng.integers(0, 40, n).astype("<u4")
        data[rng.random(n) < 0.01] = 7
        if k == 3:
            data[data == 7] = 8
        name = f"{folder}/f{k}.bin"
        f = AtomicFile(name)
        f.write(data.tobytes())
        f.commit()
        files.append((name, n * 4))
        start = 0
        for o, end in enumerate([*(np.flatnonzero(data == 7) + 1).tolist(), *([n] if n and data[-1] != 7 else [])]):
            want.add((name, o, start, end - start, bool(data[end - 1] == 7)))
            start = end
    for block in (64, 4096):
        got = separator_scan.scan_separators(spark.createDataFrame(files, "file string, bytes long"), 7, 4, block)
        assert {tuple(x) for x in got.collect()} == want
    with pytest.raises(ValueError):
        separator_scan.scan_separators(spark.createDataFrame(files, "file string, bytes long"), 7, 4, 63)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=900), st.data())
def test_elias_fano(values, data):
    values = np.sort(np.array(values, np.int64))
    head, raw = elias_fano.ef_encode(values, int(values[0]) if len(values) else 0)
    ef = elias_fano.EliasFano(head, lambda a, n: raw[a : a + n])
    i = data.draw(st.integers(0, len(values)))
    j = data.draw(st.integers(i, len(values)))
    assert ef.select(i, j).tolist() == values[i:j].tolist()


def test_elias_fano_in_slices(monkeypatch):
    """Long sequences are coded in slices, and a range reads little of them."""
    monkeypatch.setattr(elias_fano, "PACKED", 64)
    values = np.cumsum(np.random.default_rng(2).integers(0, 3000, 5000))
    head, raw = elias_fano.ef_encode(values)
    got = []
    ef = elias_fano.EliasFano(head, lambda a, n: got.append(n) or raw[a : a + n])
    assert ef.select(0, 5000).tolist() == values.tolist()
    got.clear()
    assert ef.select(2000, 2010).tolist() == values[2000:2010].tolist() and sum(got) < len(raw) / 10


def test_elias_fano_is_small():
    values = np.sort(np.random.default_rng(1).integers(0, 10**6, 20_000))
    assert len(elias_fano.ef_encode(values)[1]) * 8 < 20_000 * (2 + np.log2(50) + 1)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, library):
    df, rows = documents(spark)
    rows += [(None, "null id", ""), (-5, "negative", ""), (3, "a repeated id", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(x) for x in elias_fano.read_tokens(elias_fano.write_tokens(df, scratch(spark, "t"))).orderBy("start").collect()]
    ids = [x[0] for x in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and len(got) == len(rows)
    assert sorted((x[0] is None, x[0], x[2], x[3]) for x in got if x[0] is not None) == sorted((False, i, len(library(t)) + 1, crc([*library(t), 2])) for i, t, _ in rows if i is not None)
    assert [x[1] for x in got] == [0, *np.cumsum([x[2] for x in got])[:-1]]
    assert elias_fano.read_tokens(elias_fano.write_tokens(df.limit(0), scratch(spark, "t"))).collect() == []


def check_packing(got, want, window=1024):
    """want: ids with the end id by doc_id (several documents each)."""
    places, covered = {}, {}
    for doc, start, length, check, total, sequence, offset in got:
        assert length > 0
        places.setdefault(sequence, []).append((offset, length))
        covered.setdefault((doc, total), []).append((start, length, check))
    pads = []
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= window
        pads.append(window - end)
    for doc, many in want.items():
        for total in {len(x) for x in many}:
            pieces = sorted(covered.pop((doc, total)))
            texts = [x for x in many if len(x) == total]
            assert sum(x[1] for x in pieces) == total * len(texts)
            for start, length, check in pieces:
                assert check in {crc(x[start : start + length]) for x in texts}
    assert not covered
    return pads


def test_packing(spark, library):
    df, rows = documents(spark, 3)
    want = {}
    for i, t, _ in rows:
        want.setdefault(i, []).append([*library(t), 0])
    pads = check_packing([tuple(x) for x in packing.pack(df).collect()], want)
    assert sum(pads) < 1024
    small = check_packing([tuple(x) for x in packing.pack(df, 16).collect()], want, 16)
    assert sum(small) < 16
    assert packing.pack(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack(df, 1000)


def test_plan_of_one_length():
    """A histogram that no combination matches is laid end to end."""
    p = packing.plan({700: 100_000}, 1024)
    assert not p["slots"] and p["tail"] == {700: (0, 0)} and p["full_sequence"] == -(-70_000_000 // 1024)


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 5000), max_size=20))
def test_plans(histogram):
    p = packing.plan(histogram, 64)
    for length, n in histogram.items():
        ranges = [(a, b) for a, b, _, _ in p["slots"].get(length, [])]
        ends = [0, *[b for _, b in ranges]]
        assert [a for a, _ in ranges] == ends[:-1]
        assert ends[-1] == n or p["tail"][length][0] == ends[-1]


def test_nnls():
    a = np.array([[1, 0, 1], [1, 1, 0], [0, 1, 1]], float)
    rows, columns = np.nonzero(a.T)
    x = packing.nnls(rows, columns, a @ [3.0, 0.0, 2.0], 3, 5000)
    assert np.allclose(x, [3, 0, 2], atol=1e-2)
