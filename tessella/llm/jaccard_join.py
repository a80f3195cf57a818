"""N-gram Jaccard join by a prefix tree.

1. Every text's distinct word shingles become 64-bit tokens; equal sets collapse by a 128-bit hash of their tokens.
2. One order of tokens holds for the whole corpus: by how often they occur, as a table of 2^22 counters over all texts tells, then by their hash. Counters that
   tokens share only make the order a little worse; any order that all sets have in common gives the same links.
3. Sets x and y that link differ in at most d = floor((|x| + |y|) / 19) tokens (for 90 %), so of d + r parts by hash at least r are the same in both. Parts
   have an order too: those whose tokens are many and rare come first. Of each set's first d + 1 parts one at least is the same in both, whatever the order; passages
   that many documents share, parts of one token and empty ones fall behind. Each set emits these parts for every d that the sizes it may link with call for. A set
   with so few parts in use that an empty one is among the d + 1 emits those of another way of parting as well, and in the last way empty parts too.
   A task first links the sets that it holds itself, and emits each part once, so that one that a third of all sets have takes one row a task.
   Sets with a part in common make clusters.
4. Within a cluster the sets, frequent tokens first, are stored in a prefix tree. Blocks of sets go down the tree level by level with their
   partial overlaps, which all sets below share; a subtree is left as soon as the overlap and the lesser of what remains on either side can't reach
   what the smallest set below needs, or its sizes rule a link out.
5. A cluster over ``CHUNK_TOKENS`` is dealt over chunks. A set goes to another chunk only if a set there has one of its parts, and every two chunks
   meet in a task of their own.

Edge cases: words part at ASCII white space, A-Z are lower-cased. A text of one or two words is one shingle. Null and empty texts, and those without
words, have an empty set and link with nothing. A row with a null doc_id gets a null component. Repeated rows are equal sets. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from .batches import freed, renamed, slices
from .components import connected_components, stars
from .store import written

WORDS = 3
LEAST = (9, 10)
CHUNK_TOKENS = 1 << 21
COUNTER_BITS, COUNTER_SLICES = 22, 256
WAYS = 3
HELD = 1 << 20
BROADCAST_SETS = 200_000
BLOCK_SETS, BLOCK_TOKENS, GATHERED = 256, 1 << 15, 1 << 23
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M3
    x = (x ^ (x >> np.uint64(29))) * M1
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct tokens of a text's shingles."""
    from xxhash import xxh3_64_intdigest

    parts = (text or "").encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII white space parts
    h = np.fromiter(map(xxh3_64_intdigest, parts), np.uint64, len(parts))
    if not len(h):
        return h
    if len(h) < words:
        return mixed(np.array([xxh3_64_intdigest(b" ".join(parts), seed=len(parts))], np.uint64))
    n = len(h) - words + 1
    x = h[:n].copy()
    for k in range(1, words):
        x = mixed(x) * M2 + h[k : k + n]
    return np.unique(mixed(x))


def counter(tokens: np.ndarray) -> np.ndarray:
    """The counter of each token."""
    return (tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def caps() -> list[int]:
    """The bounds of difference in use: 1, 2, 3, ... then each about 1.4 times the one before."""
    out = [1]
    while out[-1] < 1 << 28:
        out.append(max(out[-1] + 1, out[-1] * 7 // 5))
    return out


_CAPS = np.array(caps())


def caps_of(n: int, least: tuple[int, int] = LEAST) -> list[int]:
    """The bounds of difference for which a set of n tokens emits parts: for every size up to the largest that it may link with."""
    p, q = least
    differ = lambda m: 2 * m * (q - p) // (q + p)  # noqa: E731  the most tokens in which linked sets up to size m differ
    low, high = differ(n), differ(n * q // p)
    if not high:
        return []  # links with equal sets only
    first, last = np.searchsorted(_CAPS, [max(low, 1), high])
    return _CAPS[first : last + 1].tolist()


def signatures(tokens: np.ndarray, levels: np.ndarray, least: tuple[int, int] = LEAST) -> np.ndarray:
    """The parts that a set emits: sets that link have one in common at least."""
    out = []
    spread = mixed(tokens)
    worth = (256 - levels[counter(tokens)].astype(np.int64)).astype(float)
    for cap in caps_of(len(tokens), least):
        k = cap + 2 + cap * 2 // 5
        for way in range(WAYS):
            part = ((spread if not way else mixed(tokens ^ np.uint64(way * 0x5851F42D4C957F2D & (1 << 64) - 1))) >> np.uint64(11)) % np.uint64(k)
            part = part.astype(np.int64)
            sums = np.zeros(k, np.uint64)
            np.add.at(sums, part, spread)
            gain = np.bincount(part, worth, k)
            sign = mixed(sums + mixed(np.arange(k, dtype=np.uint64) + np.uint64((k << 32 | way << 28) * 0x9E3779B1 & (1 << 64) - 1)))
            kept = np.lexsort((sign, -gain))[: cap + 1]
            regular = gain[kept[-1]] > 0
            out.append(sign[kept if regular or way == WAYS - 1 else kept[gain[kept] > 0]])
            if regular:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def in_order(sets: list[np.ndarray]) -> list[int]:
    """Places of int32 arrays in the order in which they lie in a prefix tree."""
    return sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())


class Tree:
    """A prefix tree of distinct sorted int32 arrays, its edges compressed, as arrays over its nodes; the first is the root. ``order``: the sets as they lie in it."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = order = in_order(sets)
        up, start, end, sample, low, high, ends = [-1], [0], [0], [-1], [1 << 60], [0], [-1]
        stack, last = [0], sets[order[0]][:0]

        def close(node: int, above: int) -> None:
            up[node], start[node] = above, end[above]
            low[above], high[above] = min(low[above], low[node]), max(high[above], high[node])

        def open_(depth: int, i: int) -> int:
            for column, value in zip((up, start, end, sample, low, high, ends), (-1, 0, depth, i, 1 << 60, 0, -1)):
                column.append(value)
            return len(up) - 1

        for i in order:
            s = sets[i]
            m = min(len(s), len(last))
            off = np.flatnonzero(s[:m] != last[:m])
            depth = int(off[0]) if len(off) else m
            while end[stack[-1]] > depth:
                node = stack.pop()
                if end[stack[-1]] < depth:
                    stack.append(open_(depth, i))
                close(node, stack[-1])
            leaf = open_(len(s), i)
            low[leaf] = high[leaf] = len(s)
            ends[leaf] = i
            stack.append(leaf)
            last = s
        while len(stack) > 1:
            node = stack.pop()
            close(node, stack[-1])
        self.depth, self.low, self.high, self.ends = (np.array(x, np.int64) for x in (end, low, high, ends))
        start = np.array(start, np.int64)
        length = self.depth - start
        # the tokens on the edge to each node, one after the other
        self.at = np.cumsum(length) - length
        self.tokens = np.concatenate([sets[i][a:b] for i, a, b in zip(sample[1:], start[1:].tolist(), end[1:])])
        self.length = length
        by = np.argsort(np.array(up[1:], np.int64), kind="stable")
        self.kids = by + 1
        above = np.array(up[1:], np.int64)[by]
        self.first, self.after = np.searchsorted(above, np.arange(len(up))), np.searchsorted(above, np.arange(len(up)), "right")


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each length, one after the other."""
    return np.repeat(start - np.cumsum(length) + length, length) + np.arange(int(length.sum()))


def search(tree: Tree, probes: list[np.ndarray], slot: np.ndarray, least: tuple[int, int] = LEAST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(members, link): which members of the tree each of ``probes`` links with, ``link`` a matrix (member, probe); itself too if it is one.

    All probes go down together: a row for each node that any of them still reaches has their overlaps with the path to it. ``slot`` has -1 for every token.
    """
    p, w = least[0], sum(least)
    names, row = np.unique(np.concatenate(probes), return_inverse=True)
    sizes = np.array([len(x) for x in probes], np.int64)
    has = np.zeros((len(names) + 1, len(probes)), np.uint8)
    has[row, np.repeat(np.arange(len(probes)), sizes)] = 1
    upto = np.zeros((len(names) + 1, len(probes)), np.int32)
    np.cumsum(has[:-1], axis=0, dtype=np.int32, out=upto[1:])
    slot[names] = np.arange(len(names))
    nodes, overlap, alive = np.zeros(1, np.int64), np.zeros((1, len(probes)), np.int32), np.ones((1, len(probes)), bool)
    todo = [(nodes, overlap, alive)]
    while todo:
        nodes, overlap, alive = todo.pop()
        n = tree.after[nodes] - tree.first[nodes]
        kids, above = tree.kids[ragged(tree.first[nodes], n)], np.repeat(np.arange(len(nodes)), n)
        # by sizes alone, before any token is looked at
        near = (tree.high[kids, None] * least[1] >= sizes * p) & (tree.low[kids, None] * p <= sizes * least[1]) & alive[above]
        some = near.any(1)
        kids, above, near = kids[some], above[some], near[some]
        room = max(1, GATHERED // len(probes))
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(tree.length[kids] + 16) // room)) + 1).tolist(), len(kids)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            part, own = kids[a:b], overlap[above[a:b]]
            length = tree.length[part]
            met = slot[tree.tokens[ragged(tree.at[part], length)]]
            kept = met >= 0
            owner = np.repeat(np.arange(b - a), length)[kept]
            if len(owner):
                begins = np.flatnonzero(np.diff(owner, prepend=-1))
                own[owner[begins]] += np.add.reduceat(has[met[kept]], begins, axis=0, dtype=np.int32)
            last = tree.tokens[tree.at[part] + length - 1]
            rest = np.minimum(sizes - upto[np.searchsorted(names, last, "right")], (tree.high[part] - tree.depth[part])[:, None])
            ok = near[a:b] & (w * (own + rest) >= p * (sizes + tree.low[part, None]))
            full = tree.ends[part] >= 0
            if full.any():
                link = ok[full] & (w * own[full] >= p * (sizes + tree.depth[part[full], None]))
                hit = link.any(1)
                if hit.any():
                    yield tree.ends[part[full][hit]], link[hit]
            inner = ok.any(1) & (tree.after[part] > tree.first[part])
            if inner.any():
                todo.append((part[inner], own[inner], ok[inner]))
    slot[names] = -1


def tree_join(sets: list[np.ndarray], weights: np.ndarray, levels: np.ndarray, sides: np.ndarray | None = None, least: tuple[int, int] = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) of every set: the sum of the weights of all others that link with it, and the least number of a set that links lead to.

    With ``sides`` (of 0 and 1) only links between sets of different sides count.
    """
    names, codes = np.unique(np.concatenate(sets), return_inverse=True)
    rank = np.empty(len(names), np.int32)
    rank[np.argsort(levels[counter(names)], kind="stable")[::-1]] = np.arange(len(names), dtype=np.int32)  # frequent tokens first
    sizes = np.array([len(x) for x in sets], np.int64)
    coded = np.split(rank[codes], np.cumsum(sizes)[:-1])
    for x in coded:
        x.sort()
    inside = np.arange(len(sets)) if sides is None else np.flatnonzero(sides == 0)
    asked = inside if sides is None else np.flatnonzero(sides == 1)
    counts, root = np.zeros(len(sets), np.int64), np.arange(len(sets))
    if not len(inside) or not len(asked):
        return counts, root
    tree, slot = Tree([coded[i] for i in inside]), np.full(len(names), -1, np.int64)
    asked = asked[tree.order if sides is None else in_order([coded[i] for i in asked])]  # sets that begin alike go down together
    at = 0
    while at < len(asked):
        upto = at + max(1, int(np.searchsorted(np.cumsum(sizes[asked[at : at + BLOCK_SETS]]), BLOCK_TOKENS, "right")))
        block = asked[at:upto]
        at = upto
        for members, link in search(tree, [coded[i] for i in block], slot, least):
            members = inside[members]
            if sides is None:
                link &= members[:, None] != block
            counts[block] += weights[members] @ link
            if sides is not None:
                counts[members] += link @ weights[block]
            while (new := link & (root[members][:, None] != root[block])).any():
                rows, columns = np.flatnonzero(new.any(1)), np.flatnonzero(new.any(0))
                a = np.concatenate([members[rows], members[new[:, columns].argmax(0)]])
                b = np.concatenate([block[new[rows].argmax(1)], block[columns]])
                below, top = stars(root[a], root[b])
                move = np.arange(len(sets))
                move[below] = top
                root = move[root]
    return counts, root


def shingled(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """A written table: rows ``doc_id, n, h1, h2`` of every document, and rows ``slice, counts`` of every task's counters."""

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        names = ["doc_id", "n", "h1", "h2", "slice", "counts"]
        counters, any_rows = np.zeros(1 << COUNTER_BITS, np.uint32), False
        for batch in batches:
            for part in slices(batch, "text"):
                rows, held = [], []
                for text in part.column("text").to_pylist():
                    x = shingles(text, words)
                    if not len(x):
                        rows.append((0, None, None))
                        continue
                    h = np.frombuffer(xxh3_128_digest(x.tobytes()), "<i8")
                    rows.append((len(x), int(h[0]), int(h[1])))
                    held.append(x)
                if held:
                    np.add.at(counters, counter(np.concatenate(held)), np.uint32(1))
                n, any_rows = part.num_rows, True
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in zip(*rows)], pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        if any_rows:
            codec = pa.Codec("zstd")
            packed = [codec.compress(x.tobytes(), asbytes=True) for x in np.split(counters, COUNTER_SLICES)]
            yield pa.RecordBatch.from_arrays([*[pa.nulls(COUNTER_SLICES, pa.int64())] * 4, pa.array(range(COUNTER_SLICES), pa.int32()), pa.array(packed, pa.binary())], names)

    return written(renamed(docs, "doc_id", "text").mapInArrow(freed(prepare), "doc_id long, n long, h1 long, h2 long, slice int, counts binary"), "sets")


def frequency_levels(parts: DataFrame) -> bytes:
    """One byte a counter, from all tasks' ``slice, counts``: eight times the binary logarithm of the sum. Its size is fixed."""
    length = (1 << COUNTER_BITS) // COUNTER_SLICES

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sums = pa.Codec("zstd"), {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = np.frombuffer(codec.decompress(packed.as_buffer(), 4 * length), np.uint32)
                sums[k] = sums.get(k, 0) + got.astype(np.float64)
        levels = [np.minimum(255, np.round(8 * np.log2(1 + x))).astype(np.uint8).tobytes() for x in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], ["slice", "levels"])

    out = np.zeros((COUNTER_SLICES, length), np.uint8)
    for x in parts.repartition("slice").mapInArrow(freed(add), "slice int, levels binary").collect():
        out[x.slice] = np.frombuffer(x.levels, np.uint8)
    return out.tobytes()


def parts(docs: DataFrame, levels, least: tuple[int, int] = LEAST, words: int = WORDS) -> DataFrame:
    """``part, node``: the parts of all sets, each with one set a task that stands for all sets which the task found to share parts.

    ``node`` is the first half of a set's hash. Those that a task has linked itself share a part made up of their nodes. Rows without doc_id don't link.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        table = np.frombuffer(levels.value, np.uint8)
        signs, nodes, held, seen = [], [], 0, set()

        def flush() -> pa.RecordBatch:
            sign = np.concatenate([*signs, np.zeros(0, np.uint64)])
            owner = np.repeat(np.arange(len(nodes)), [len(x) for x in signs])
            by = np.argsort(sign, kind="stable")
            sign, owner = sign[by], owner[by]
            first = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]])) if len(sign) else np.zeros(0, np.int64)
            head = np.repeat(owner[first], np.diff(first, append=len(sign)))
            below, top = stars(owner[head != owner], head[head != owner])
            root = np.arange(len(nodes))
            root[below] = top
            node = np.array(nodes, np.int64)
            made = mixed(node[below].view(np.uint64) ^ M2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([sign[first].view(np.int64), made, made])), pa.array(np.concatenate([node[root[owner[first]]], node[below], node[top]]))], ["part", "node"])

        for batch in batches:
            for part in slices(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if doc is None or not len(x := shingles(text, words)):
                        continue
                    key = xxh3_128_digest(x.tobytes())
                    if key in seen:
                        continue
                    seen.add(key)
                    signs.append(signatures(x, table, least))
                    nodes.append(int(np.frombuffer(key, "<i8")[0]))
                    held += len(signs[-1])
                    if held >= HELD:
                        yield flush()
                        signs, nodes, held, seen = [], [], 0, set()
        if nodes:
            yield flush()

    return renamed(docs, "doc_id", "text").mapInArrow(freed(emit), "part long, node long")


def member_sets(docs: DataFrame, members: DataFrame, few: bool, words: int = WORDS) -> DataFrame:
    """``members`` (rep, h1, h2, cluster, chunk, copies) with their tokens, from the text of the document ``rep``."""
    names = ["cluster", "chunk", "rep", "h1", "h2", "copies"]

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(x, words).tobytes() for x in part.column("text").to_pylist()]
                # rows of the same doc_id may have other texts
                keep = [xxh3_128_digest(x) == np.array([a, b], "<i8").tobytes() for x, a, b in zip(sets, part.column("h1").to_pylist(), part.column("h2").to_pylist())]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(sets, pa.binary())], [*names, "tokens"]).filter(pa.array(keep))

    texts = renamed(docs, "doc_id", "text").withColumnRenamed("doc_id", "rep")
    joined = texts.join(F.broadcast(members) if few else members, "rep").select(*names, "text")
    return joined.mapInArrow(freed(tokens), "cluster long, chunk long, rep long, h1 long, h2 long, copies long, tokens binary")


def with_others(sets: DataFrame, levels, least: tuple[int, int] = LEAST) -> DataFrame:
    """``sets`` of clusters of many chunks, each once for every chunk of its cluster that holds one of its parts: ``other``; for its own at least."""

    def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        for batch in batches:
            found = [signatures(np.frombuffer(x, np.uint64), table, least) for x in batch.column("tokens").to_pylist()]
            n = [len(x) for x in found]
            flat = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            columns = [pa.array(np.repeat(batch.column(c).to_numpy(), n)) for c in ("cluster", "chunk", "h1", "h2")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(flat)], ["cluster", "chunk", "h1", "h2", "part"])

    own = written(sets.mapInArrow(freed(parts_of), "cluster long, chunk long, h1 long, h2 long, part long"), "chunk-parts")
    homes = written(own.select("cluster", "part", F.col("chunk").alias("other")).distinct(), "chunk-homes")
    goes = own.join(homes, ["cluster", "part"]).where("chunk <> other").select("h1", "h2", "other").distinct()
    away = sets.join(goes, ["h1", "h2"])
    return sets.withColumn("other", F.col("chunk")).unionByName(away)


def joined_chunks(rows: DataFrame, levels, least: tuple[int, int] = LEAST) -> DataFrame:
    """``rep, root, h1, h2, links`` from all links within each cluster's chunks and between every two of them; ``root`` is the least rep that these lead to."""
    names = ["rep", "root", "h1", "h2", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(levels.value, np.uint8)
        key, sets, rest, sides, held = None, [], [], [], 0

        def done() -> pa.RecordBatch:
            reps, h1, h2, copies = (np.array(x, np.int64) for x in zip(*rest))
            by = np.argsort(reps, kind="stable")  # the least number of a set is then its least rep
            counts, root = tree_join([sets[i] for i in by], copies[by], table, None if key[1] == key[2] else np.array(sides)[by], least)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (reps[by], reps[by][root], h1[by], h2[by], counts)], names)

        for batch in batches:
            for cluster, i, j, h1, h2, rep, copies, tokens, chunk in zip(*[c.to_pylist() for c in batch.columns]):
                if (cluster, i, j) != key:
                    # clusters have no links with each other: small ones share a tree
                    if sets and (held >= BLOCK_TOKENS or i != j or key[1] != key[2]):
                        yield done()
                        sets, rest, sides, held = [], [], [], 0
                    key = cluster, i, j
                elif rest[-1] == (rep, h1, h2, copies):
                    continue  # the same set, from a repeated row
                sets.append(np.frombuffer(tokens, np.uint64))
                rest.append((rep, h1, h2, copies))
                sides.append(int(chunk != i))
                held += len(sets[-1])
        if sets:
            yield done()

    dealt = rows.select("cluster", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "h1", "h2", "rep", "copies", "tokens", "chunk")
    return dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "h1", "h2").mapInArrow(freed(run), "rep long, root long, h1 long, h2 long, links long")


def ngram_components(docs: DataFrame, least: tuple[int, int] = LEAST, words: int = WORDS, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every document of ``docs (doc_id, text)``.

    ``n_links``: how many other rows with a doc_id it links with, those of equal sets among them.
    """
    spark = docs.sparkSession
    table = shingled(docs, words)
    levels = spark.sparkContext.broadcast(frequency_levels(table.where("slice is not null").select("slice", "counts")))
    table = table.where("slice is null")
    classes = written(table.where("h1 is not null and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count(F.lit(1)).alias("copies")), "classes")
    # a part has one row a task
    first = F.min("node").over(Window.partitionBy("part"))
    edges = parts(docs, levels, least, words).select(F.col("node").alias("a"), first.alias("b")).where("a <> b")
    clusters = connected_components(edges).select(F.col("id").alias("h1"), F.col("component").alias("cluster"))
    members = written(classes.join(F.broadcast(clusters) if clusters.count() <= BROADCAST_SETS else clusters, "h1"), "members")
    n_members = members.count()
    found = None
    if n_members:
        sizes = members.groupBy("cluster").agg(F.sum("n").alias("tokens")).where(F.col("tokens") > chunk_tokens)
        large = written(sizes.select("cluster", F.expr(f"(tokens + {chunk_tokens - 1}) div {chunk_tokens}").alias("chunks")), "large-clusters")
        n_large = large.count()
        dealt = members.withColumn("chunk", F.lit(0).cast("long"))
        if n_large:
            dealt = members.join(F.broadcast(large) if n_large <= BROADCAST_SETS else large, "cluster", "left")
            dealt = written(dealt.withColumn("chunk", F.coalesce(F.pmod(F.xxhash64("h2"), F.col("chunks")), F.lit(0).cast("long"))), "dealt")
        few = n_members <= BROADCAST_SETS
        small = member_sets(docs, dealt.where("chunks is null") if n_large else dealt, few, words).withColumn("other", F.col("chunk"))
        found = written(joined_chunks(small, levels, least), "found")
        if n_large:
            sets = written(member_sets(docs, dealt.where("chunks is not null"), few, words), "large-sets")
            more = written(joined_chunks(with_others(sets, levels, least), levels, least), "found-large")
            trees = connected_components(more.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("id", "rep")
            more = more.groupBy("rep", "h1", "h2").agg(F.sum("links").alias("links")).join(trees, "rep", "left")
            found = found.unionByName(more.select("rep", F.coalesce("component", "rep").alias("root"), "h1", "h2", "links"))
        found = found.where("root <> rep or links > 0").select("h1", "h2", "root", "links")
        classes = classes.join(F.broadcast(found) if few else found, ["h1", "h2"], "left").withColumn("rep", F.coalesce("root", "rep")).withColumn("copies", F.col("copies") + F.coalesce("links", F.lit(0)))
    classes = classes.select("h1", "h2", "rep", (F.col("copies") - 1).alias("others"))
    result = table.select("doc_id", "n", "h1", "h2").join(classes, ["h1", "h2"], "left")
    known = F.col("doc_id").isNotNull()
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.when(known, F.coalesce("rep", "doc_id")).alias("component_id"), F.when(known, F.coalesce("others", F.lit(0).cast("long"))).alias("n_links"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
