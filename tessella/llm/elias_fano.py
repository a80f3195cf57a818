"""Token files: a concatenated id array whose document boundaries, and document ids, are Elias-Fano coded.

File layout: ids as little-endian uint16 or uint32; the coded boundaries (n + 1 of them, starting with 0); the coded
document ids (ascending); a JSON footer, its length as 4 bytes, and the magic bytes. A coded sequence has
the low bits of each value packed, the high bits in unary, and the place of every 256th one of the latter:
``select`` of any range starts at the sample before it, so no table of 64-bit offsets is kept or built.

Edge cases: null text counts as empty; null doc_ids come first, as their number only. Equal doc_ids keep every row
(ordered by text then). An empty table gives no files and no rows. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from .batches import freed, partitions, renamed, slices, task_id
from .store import AtomicFile, filesystem, read_range, scratch, written
from .tokens import encoder

MAGIC = b"EFTOKEN1"
SAMPLE = 256
END_ID = 2
READ_DOCS = 16_384
PACKED = 1 << 16


def ef_encode(values: np.ndarray, base: int = 0) -> tuple[dict, bytes]:
    """Header and bytes of a non-decreasing sequence."""
    v = (values.astype(np.int64) - base).astype(np.uint64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low = max(0, (top // max(n, 1)).bit_length() - 1)
    places, lows = np.arange(low, dtype=np.uint64), b""
    if low:  # slices of a multiple of eight values end with a byte
        lows = b"".join(np.packbits(((v[i : i + PACKED, None] >> places) & np.uint64(1)).astype(np.uint8).reshape(-1), bitorder="little").tobytes() for i in range(0, n, PACKED))
    at = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    unary = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
    unary[at] = 1
    highs = np.packbits(unary, bitorder="little").tobytes()
    samples = at[::SAMPLE].astype("<u4" if len(unary) < 1 << 32 else "<u8").tobytes()
    return {"n": n, "low": low, "base": int(base), "lows": len(lows), "highs": len(highs), "samples": len(samples), "wide": len(unary) >= 1 << 32}, lows + highs + samples


class EliasFano:
    """Reads values ``i`` to ``j`` of a coded sequence, straight from the bytes that hold them: ``read(at, length)``."""

    def __init__(self, head: dict, read: Callable[[int, int], bytes]):
        self.h, self.read = head, read

    def sample(self, k: int) -> int:
        """The place of the ``SAMPLE * k``-th one among the high bits; behind the last sample, where these end."""
        width = 8 if self.h["wide"] else 4
        if k * width >= self.h["samples"]:
            return self.h["highs"] * 8
        return int.from_bytes(self.read(self.h["lows"] + self.h["highs"] + k * width, width), "little")

    def select(self, i: int, j: int) -> np.ndarray:
        """Values i, ..., j - 1 as int64."""
        n, low = self.h["n"], self.h["low"]
        i, j = max(0, i), min(j, n)
        if i >= j:
            return np.zeros(0, np.int64)
        first, after = i // SAMPLE, -(-j // SAMPLE)
        a, b = self.sample(first), self.sample(after)
        x, y = a // 8, min(-(-(b + 1) // 8), self.h["highs"])
        highs = np.frombuffer(self.read(self.h["lows"] + x, y - x), np.uint8)
        ones = np.flatnonzero(np.unpackbits(highs, bitorder="little")[a % 8 :]) + a
        at = ones[i - first * SAMPLE : j - first * SAMPLE]
        out = (at - np.arange(i, j)).astype(np.uint64) << np.uint64(low)
        if low:
            x, y = i * low // 8, -(-j * low // 8)
            bits = np.unpackbits(np.frombuffer(self.read(x, y - x), np.uint8), bitorder="little")[i * low - x * 8 :][: (j - i) * low].reshape(-1, low).astype(np.uint64)
            out |= (bits << np.arange(low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out.astype(np.int64) + self.h["base"]


class TokenFile:
    """One file of this format, opened for reading."""

    def __init__(self, uri: str):
        source, path = filesystem(uri)
        self.f = source.open_input_file(path)
        size = self.f.size()
        tail = read_range(self.f, size - 12, 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        self.foot = json.loads(read_range(self.f, size - 12 - (n := int.from_bytes(tail[:4], "little")), n))
        at = self.foot["n_ids"] * self.foot["width"]
        parts = []
        for key in ("starts", "docs"):
            head = self.foot[key]
            n = head["lows"] + head["highs"] + head["samples"]
            parts.append(EliasFano(head, lambda a, size, at=at: read_range(self.f, at + a, size)))
            at += n
        self.starts, self.docs = parts

    def ids(self, start: int, end: int) -> np.ndarray:
        width = self.foot["width"]
        return np.frombuffer(read_range(self.f, start * width, (end - start) * width), f"<u{width}")

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        nulls = self.foot["nulls"]
        return [None] * max(0, min(j, nulls) - i) + self.docs.select(max(0, i - nulls), j - nulls).tolist()


def write_tokens(docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """Writes ``docs (doc_id, text)`` as token files in ascending doc_id order: file k holds the k-th range.

    Returns the manifest, one row a file: ``file, part, n_docs, n_ids``. Equal doc_ids are ordered, and split between files, by the text.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, lengths, known, nulls, width = task_id(), None, [], [], 0, 2
        name = f"{folder}/ids-{part:06d}.eft"
        for batch in batches:
            for some in slices(batch, "text"):
                if out is None:
                    out = AtomicFile(name)
                    width = 2 if encoder(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4
                ids, offsets = encoder(tokenizer).encode(some.column("text"))
                out.write(np.insert(ids, offsets[1:], end_id).astype(f"<u{width}").tobytes())
                lengths.append(np.diff(offsets) + 1)
                column = some.column("doc_id")
                nulls += column.null_count
                known.append(column.drop_null().to_numpy().astype(np.int64))
        if out is None:
            return
        starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
        known = np.concatenate(known)
        heads = {}
        for key, values in (("starts", starts), ("docs", known)):
            heads[key], data = ef_encode(values, int(values[0]) if len(values) else 0)
            out.write(data)
        foot = json.dumps(heads | {"n_ids": int(starts[-1]), "width": width, "nulls": nulls}).encode()
        out.write(foot + len(foot).to_bytes(4, "little") + MAGIC)
        out.commit()
        yield pa.RecordBatch.from_pylist([{"file": name, "part": part, "n_docs": len(starts) - 1, "n_ids": int(starts[-1])}], schema=pa.schema([("file", pa.string()), ("part", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    keys = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("text").asc_nulls_first()]
    dealt = renamed(docs, "doc_id", "text").withColumn("tie", F.xxhash64("text")).repartitionByRange(partitions(docs.sparkSession), *keys[:2]).sortWithinPartitions(*keys).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(dealt.mapInArrow(freed(write), "file string, part long, n_docs long, n_ids long"), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone. The manifest has one row a file; it is summed on the driver."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["file"])
                i, j = row["first"], min(row["first"] + READ_DOCS, row["n_docs"])
                starts = file.starts.select(i, j + 1)
                crcs = []
                for at in range(0, j - i, 256):  # the ids of so many documents are in memory at a time
                    upto = min(at + 256, j - i)
                    ids = file.ids(int(starts[at]), int(starts[upto])).astype("<u4")
                    crcs += [zlib.crc32(ids[a:b]) for a, b in zip(starts[at:upto] - starts[at], starts[at + 1 : upto + 1] - starts[at])]
                yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids(i, j), pa.int64()), pa.array(starts[:-1] + row["base"], pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spark, base, rows, n_ranges = manifest.sparkSession, 0, [], 0
    for x in sorted(manifest.collect(), key=lambda x: x.part):
        rows.append((x.file, x.n_docs, base))
        base += x.n_ids
        n_ranges += -(-x.n_docs // READ_DOCS)
    files = spark.createDataFrame(rows, "file string, n_docs long, base long")
    parts = files.select("*", F.explode(F.expr(f"sequence(0L, n_docs - 1, {READ_DOCS}L)")).alias("first")).repartition(max(1, n_ranges))  # a task a range
    return parts.mapInArrow(freed(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark, "tokens")))
