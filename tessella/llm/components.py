"""Connected components by spanning forests.

Every task first reduces its edges to a forest of stars, one edge for each node but the least of its tree. Where the forest has at most ``ONE_TASK``
edges, one task finishes it. Beyond that, alternating large-star and small-star steps, each a written table and again reduced by task, contract the
graph; their least neighbours are aggregated map-side and written before they are joined back, so that adaptive execution can split a hub's
edges over tasks. The number of steps grows with the logarithm of the longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from .batches import freed
from .store import written

ONE_TASK = 1 << 20
MOST_STEPS = 60
HELD = 1 << 20


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, root): every node of the edges (a, b) but the roots, with the least node that it can reach."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        x, y = root[u], root[v]
        differ = x != y
        if not differ.any():
            break
        u, v, x, y = u[differ], v[differ], x[differ], y[differ]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    below = root != np.arange(len(ids))
    return ids[below], ids[root[below]]


def forest(edges: DataFrame, roots: bool = False) -> DataFrame:
    """``u, v``: the edges of each task as stars, v the least node of its tree; with ``roots``, also a row (v, v) of each."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = v = np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            if sum(len(x) for x, _ in held) >= max(HELD, len(u)):
                u, v = stars(np.concatenate([u, *[x for x, _ in held]]), np.concatenate([v, *[y for _, y in held]]))
                held = []
        u, v = stars(np.concatenate([u, *[x for x, _ in held]]), np.concatenate([v, *[y for _, y in held]]))
        if roots:
            top = np.unique(v)
            u, v = np.concatenate([u, top]), np.concatenate([v, top])
        if len(u):
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return edges.mapInArrow(freed(reduce), "u long, v long")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", one_task: int = ONE_TASK) -> DataFrame:
    """``id, component`` of every node in ``edges``: the least node that it can reach. Loops and repeated edges do no harm; null ends are left out.
    """
    x = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where(f"`{a}` is not null and `{b}` is not null and u <> v")
    now, seen = written(forest(x), "edges"), None
    for _ in range(MOST_STEPS):
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark.n <= one_task:
            return written(forest(now.coalesce(1), True), "components").toDF("id", "component")
        if mark == seen:
            break
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = written(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        parent = written(large.groupBy("u").agg(F.min("v").alias("m")), "parents")
        small = large.join(parent, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").unionByName(parent.select("u", F.col("m").alias("v"))).distinct()
        now = written(small, "edges")
    else:
        raise RuntimeError("components did not settle")
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(found.select(F.col("component").alias("id"), "component").distinct())
