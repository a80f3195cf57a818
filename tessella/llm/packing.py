"""Packing into windows of 1024 tokens by non-negative least squares.

Every document is cut into full windows and a remainder. The remainders' histogram (at most 1023 lengths, whatever the
corpus' size) is matched by combinations of two or three lengths that fill a window exactly: NNLS gives each
combination a repeat count, which is rounded down to what the histogram has. What is left is packed greedily: first by combinations as often as they fit,
then longest first, each remainder into the open sequence, cut where that is full, so that only the very last sequence has padding. The plan names ranges of ranks within
a length; a remainder finds its place by its rank, and no group of equal lengths has to meet in one task.

Edge cases: null text counts as empty: one token, the end id. Repeated documents are packed one by one. An
empty table gives no pieces. Extra columns are ignored. doc_id may be null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from .batches import freed, renamed, slices, task_id
from .store import written
from .tokens import encoder

WINDOW = 1024
END_ID = 0
BROADCAST_BASES = 300_000
RANK_BITS = 48


def combinations_of(window: int) -> tuple[np.ndarray, np.ndarray]:
    """Index arrays (combination, length) of all pairs and triples of lengths that add up to ``window``."""
    a = np.arange(1, window // 2 + 1)
    pairs = np.stack([a, window - a], 1)
    x, y = np.meshgrid(np.arange(1, window // 3 + 1), np.arange(1, window // 2 + 1), indexing="ij")
    z = window - x - y
    keep = (x <= y) & (y <= z)
    triples = np.stack([x[keep], y[keep], z[keep]], 1)
    return np.concatenate([np.repeat(np.arange(len(pairs)), 2), len(pairs) + np.repeat(np.arange(len(triples)), 3)]), np.concatenate([pairs.ravel(), triples.ravel()])


def nnls(rows: np.ndarray, columns: np.ndarray, h: np.ndarray, n: int, rounds: int = 400, still: float = 1e-5) -> np.ndarray:
    """Minimises |A x - h| over x >= 0 by accelerated projected gradients; A has a one at (columns[i], rows[i]).

    It ends once no count has moved by more than ``still`` in a round, or after ``rounds``; counts are rounded anyway, and what they leave out is packed greedily.
    """
    load = np.bincount(columns, minlength=len(h)).astype(float)
    step = 1 / max(1.0, 3 * load.max())
    x = np.zeros(n)
    y, t = x.copy(), 1.0
    for _ in range(rounds):
        miss = np.bincount(columns, y[rows], len(h)) - h
        new = np.maximum(0, y - step * np.bincount(rows, miss[columns], n))
        t, old = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (old - 1) / t * (new - x)
        moved, x = np.abs(new - x).max(), new
        if moved <= still:
            break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> dict:
    """Where the remainders go. ``slots[length]``: (first rank, past the last, first sequence, offset), by rank; ``tail[length]``: (first rank, place of its first token in the stream);
    ``residual``: the least squares' |A x - h|."""
    h = np.zeros(window, np.int64)
    for length, n in histogram.items():
        h[length] = n
    left, free, sequence, slots, residual = h.copy(), np.zeros(window, np.int64), 0, {}, float(np.linalg.norm(h))
    rows, columns = combinations_of(window)
    some = np.isin(rows, rows[h[columns] == 0], invert=True)  # combinations of lengths that occur
    names, rows = np.unique(rows[some], return_inverse=True)
    columns = columns[some]
    if len(names):
        counts = nnls(rows, columns, h.astype(float), len(names))
        residual = float(np.linalg.norm(np.bincount(columns, counts[rows], window) - h))
        members = np.split(columns, np.flatnonzero(np.diff(rows)) + 1)
        # Combinations by repeat count, then, for what rounding has left, all once more as often as they fit.
        order = np.lexsort((np.arange(len(names)), -counts))
        for whole in (False, True):
            for k in order:
                need: dict[int, int] = {}
                for length in members[k].tolist():
                    need[length] = need.get(length, 0) + 1
                fit = min(int(left[x]) // m for x, m in need.items())
                times = fit if whole else min(fit, int(counts[k]))
                if times <= 0:
                    continue
                offset = 0
                for length in members[k].tolist():
                    slots.setdefault(length, []).append((int(free[length]), int(free[length]) + times, sequence, offset))
                    free[length] += times
                    left[length] -= times
                    offset += length
                sequence += times
    tail, at = {}, 0
    for length in range(window - 1, 0, -1):
        if left[length]:
            tail[length] = (int(free[length]), at)
            at += int(left[length]) * length
    return {"window": window, "slots": slots, "tail": tail, "tail_sequence": sequence, "full_sequence": sequence + -(-at // window), "residual": residual}


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(int(ends[-1]) if len(ends) else 0)


def cut(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    """A written table, one row a document: its full windows' checksums, its remainder's checksum and ids, and its ranks within its part."""
    names = ["part", "doc_id", "doc_tokens", "full_crcs", "full_rank", "rest", "rest_rank", "rest_crc", "rest_ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, full, ranks = task_id(), 0, np.zeros(window, np.int64)
        for batch in batches:
            for some in slices(batch, "text"):
                coder, n = encoder(tokenizer), some.num_rows
                ids, ends = coder.encode(some.column("text"))
                ids = np.insert(ids, ends[1:], end_id)
                ends = ends[1:] + np.arange(1, n + 1)
                total = np.diff(ends, prepend=0)
                wholes, rest = total // window, total % window
                first = np.cumsum(wholes) - wholes
                starts = np.repeat(ends - total, wholes) + ragged(np.zeros(n, np.int64), wholes) * window
                data = memoryview(ids.astype("<u4", copy=False)).cast("B")
                crcs = [zlib.crc32(data[a : a + 4 * window]) for a in (4 * starts).tolist()]
                rest_crcs = [zlib.crc32(data[a:b]) for a, b in zip((4 * (ends - rest)).tolist(), (4 * ends).tolist())]
                # rank of each remainder among those of its length
                by = np.argsort(rest, kind="stable")
                begins = np.flatnonzero(np.diff(rest[by], prepend=-1))
                nth = np.empty(n, np.int64)
                nth[by] = np.arange(n) - np.repeat(begins, np.diff(begins, append=n))
                kept = ids[ragged(ends - rest, rest)].astype("<u2" if coder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
                at = np.concatenate([[0], np.cumsum(rest)]) * kept.itemsize
                columns = [
                    pa.array(np.full(n, part, np.int32)), some.column("doc_id").cast(pa.int64()), pa.array(total), pa.ListArray.from_arrays(pa.array(np.append(first, len(crcs)), pa.int32()), pa.array(crcs, pa.int64())), pa.array(full + first),
                    pa.array(rest.astype(np.int32)), pa.array(ranks[rest] + nth), pa.array(rest_crcs, pa.int64()), pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(kept)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
                full += int(wholes.sum())
                ranks += np.bincount(rest, minlength=window)

    if window & (window - 1) or window < 4:
        raise ValueError("window must be a power of two, 4 or more")
    schema = "part int, doc_id long, doc_tokens long, full_crcs array<long>, full_rank long, rest int, rest_rank long, rest_crc long, rest_ids binary"
    return written(renamed(docs, "doc_id", "text").mapInArrow(freed(encode), schema), "cut")


def place(table: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece of a ``cut`` table."""
    spark = table.sparkSession
    ranked = table.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("full_crcs")).alias("full"))
    ranked = written(ranked, "cut-counts")
    histogram = {x.rest: x.n for x in ranked.groupBy("rest").agg(F.sum("n").alias("n")).collect() if x.rest}  # as many as lengths
    p = plan(histogram, window)
    slots = sorted((length << RANK_BITS | x[0], x[0], x[2], x[3]) for length, many in p["slots"].items() for x in many)
    tail = np.full((window, 2), 1 << RANK_BITS, np.int64)
    for length, x in p["tail"].items():
        tail[length] = x
    where = spark.sparkContext.broadcast((np.array(slots, np.int64).reshape(-1, 4).T.copy(), tail, p["tail_sequence"], p["full_sequence"]))  # as many entries as combinations in use
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranked.select("part", "rest", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    fulls = ranked.groupBy("part").agg(F.sum("full").alias("full"))  # a row a task
    fulls = fulls.select("part", F.coalesce(F.sum("full").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full_base"))
    bases = written(bases.join(fulls, "part"), "cut-bases")
    if bases.count() <= BROADCAST_BASES:
        bases = F.broadcast(bases)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, first, sequence, offset), tails, tail_sequence, full_sequence = where.value
        for batch in batches:
            total, rest, rest_crc, rank, before = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc_tokens", "rest", "rest_crc", "rank", "full_before"))
            row = np.arange(len(total))
            # full windows
            crcs = batch.column("full_crcs")
            wholes = np.diff(crcs.offsets.to_numpy())
            doc, k = np.repeat(row, wholes), ragged(np.zeros(len(row), np.int64), wholes)
            out = [(doc, k * window, np.full(len(k), window), crcs.flatten().to_numpy(), full_sequence + before[doc] + k, np.zeros(len(k), np.int64))]
            # remainders that the combinations place
            in_tail = rank >= tails[rest, 0]
            doc = row[(rest > 0) & ~in_tail]
            if len(doc):
                at = np.searchsorted(keys, rest[doc] << RANK_BITS | rank[doc], "right") - 1
                out.append((doc, total[doc] - rest[doc], rest[doc], rest_crc[doc], sequence[at] + rank[doc] - first[at], offset[at]))
            # the others, by their place in the stream
            doc = row[(rest > 0) & in_tail]
            if len(doc):
                at = tails[rest[doc], 1] + (rank[doc] - tails[rest[doc], 0]) * rest[doc]
                seq, off = tail_sequence + at // window, at % window
                head = np.minimum(rest[doc], window - off)
                split = head < rest[doc]
                crc, more = rest_crc[doc], []
                for x in np.flatnonzero(split).tolist():
                    raw, n = batch.column("rest_ids")[int(doc[x])].as_py(), int(rest[doc[x]])
                    ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
                    crc[x] = zlib.crc32(ids[: head[x]])
                    more.append(zlib.crc32(ids[head[x] :]))
                out.append((doc, total[doc] - rest[doc], head, crc, seq, off))
                doc, head, seq = doc[split], head[split], seq[split]
                out.append((doc, total[doc] - rest[doc] + head, rest[doc] - head, np.array(more, np.int64), seq + 1, np.zeros(len(doc), np.int64)))
            doc, start, length, crc, seq, off = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)), *[pa.array(x, pa.int64()) for x in (start, length, crc, total[doc], seq, off)]], names)

    joined = table.join(bases, ["part", "rest"])
    joined = joined.select("doc_id", "doc_tokens", "full_crcs", "rest", "rest_crc", "rest_ids", (F.col("base") + F.col("rest_rank")).alias("rank"), (F.col("full_base") + F.col("full_rank")).alias("full_before"))
    return joined.mapInArrow(freed(assign), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None) -> DataFrame:
    return place(cut(docs, window, end_id, tokenizer), window)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
