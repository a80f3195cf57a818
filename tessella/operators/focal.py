"""Circular focal sums: kernels, the cell form for sparse grids and the block form for dense ones.

A kernel is a small table of offsets and weights. The sparse form spreads each occupied cell over the kernel (cells x kernel rows); the dense
form cuts the grid into blocks with a halo, and sums runs of the kernel by differences of prefix sums, one Arrow task a block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import clip, guarded_ratio

TRIM = 1e-12
LEAST_VALID = 1e-6


def halo(radius_m: float, px: float, py: float) -> tuple[int, int]:
    """Margin cells in x and y."""
    return math.ceil(radius_m / px) + 2, math.ceil(radius_m / py) + 2


def _check(radius: float, px: float, py: float, order: int) -> None:
    if radius <= 0 or px <= 0 or py <= 0 or order < 8:
        raise ValueError("radius and cell sizes must be above 0, the quadrature's order 8 at least")


def covered(dx: np.ndarray, dy: np.ndarray, px: float, py: float, radius: float, order: int = 64) -> np.ndarray:
    """The share of each cell (dx, dy) that a circle around the centre of cell (0, 0) covers."""
    x, w = np.polynomial.legendre.leggauss(order)
    left, right = (np.abs(dx) - 0.5) * px, (np.abs(dx) + 0.5) * px
    mid = np.abs(dy) * py
    y = mid[..., None] + x * (py / 2)
    reach = np.sqrt(np.clip(radius**2 - y**2, 0, None))
    width = np.clip(np.minimum(right[..., None], reach) - np.maximum(left[..., None], -reach), 0, None)
    share = np.clip((width @ w) / 2 / px, 0, 1)
    near = np.hypot(np.clip(left, 0, None), np.clip(mid - py / 2, 0, None))
    far = np.hypot(right, mid + py / 2)
    return np.where(far <= radius, 1.0, np.where(near >= radius, 0.0, share))


def kernel(radius: float, px: float, py: float, mode: str = "weighted", order: int = 64) -> list[tuple[int, int, float]]:
    """(dr, dc, weight) rows; their number depends on the radius alone."""
    _check(radius, px, py, order)
    if mode == "binary":
        return [(r, c, 1.0) for r in range(-int(radius // py), int(radius // py) + 1) for m in [int(math.sqrt(radius**2 - (r * py) ** 2) // px)] for c in range(-m, m + 1)]
    if mode != "weighted":
        raise ValueError("mode must be weighted or binary")
    hx, hy = halo(radius, px, py)
    dy, dx = np.mgrid[-hy : hy + 1, -hx : hx + 1]
    w = covered(dx, dy, px, py, radius, order)
    keep = w > TRIM
    return [(int(a), int(b), float(c)) for a, b, c in zip(dy[keep], dx[keep], w[keep])]


def kernel_table(spark: SparkSession, rows: list[tuple[int, int, float]]) -> DataFrame:
    return spark.createDataFrame(rows, "dr int, dc int, w double")


def focal_sum(cells: DataFrame, rows: list[tuple[int, int, float]], values: list[str], n_rows: int, n_cols: int) -> DataFrame:
    """Sparse form: weighted sums of ``values`` at every cell that has an occupied one in reach."""
    k = F.broadcast(kernel_table(cells.sparkSession, rows))  # a fixed number of rows
    spread = cells.select("tile", "r", "c", *values).crossJoin(k).select("tile", (F.col("r") - F.col("dr")).alias("r"), (F.col("c") - F.col("dc")).alias("c"), *[(F.col(v) * F.col("w")).alias(v) for v in values])
    inside = F.col("r").between(0, n_rows - 1) & F.col("c").between(0, n_cols - 1)
    return spread.where(inside).groupBy("tile", "r", "c").agg(*[F.sum(v).alias(v) for v in values])


def box_sum(cells: DataFrame, value: str, reach: int) -> DataFrame:
    """Sums along a row over c - reach to c + reach, by value of c, so that missing cells do no harm."""
    from pyspark.sql import Window

    return cells.withColumn("box", F.sum(value).over(Window.partitionBy("tile", "r").orderBy("c").rangeBetween(-reach, reach)))


def urban_measures(cells: DataFrame, rows: list[tuple[int, int, float]], n_rows: int, n_cols: int) -> DataFrame:
    """``density`` and ``height`` from ``cells (tile, r, c, footprint, height_area, valid)``: shares of the kernel's whole weight, and of valid area."""
    total = sum(w for _, _, w in rows)
    sums = focal_sum(cells, rows, ["footprint", "height_area", "valid"], n_rows, n_cols)
    return sums.select("tile", "r", "c", clip(F.col("footprint") / F.lit(total)).alias("density"), guarded_ratio(F.col("height_area"), F.col("valid")).alias("height"))


def with_halo(cells: DataFrame, block: int, hx: int, hy: int) -> DataFrame:
    """Cells keyed by block (br, bc), those within a halo of other blocks also by theirs."""
    near = lambda k, h: F.array_distinct(F.array(F.floor((F.col(k) - h) / block), F.floor(F.col(k) / block), F.floor((F.col(k) + h) / block))).cast("array<int>")
    return cells.withColumn("br", F.explode(near("r", hy))).withColumn("bc", F.explode(near("c", hx))).where("br >= 0 and bc >= 0")


def block_sums(a: np.ndarray, rows: list[tuple[int, int, float]], hx: int, hy: int) -> np.ndarray:
    """Focal sums of a block with its halo: runs of weight 1 by prefix sums, the rest one by one."""
    h, w = a.shape[0] - 2 * hy, a.shape[1] - 2 * hx
    prefix = np.concatenate([np.zeros((a.shape[0], 1)), np.cumsum(a, 1, dtype=np.float64)], 1)
    out = np.zeros((h, w))
    full: dict[int, list[int]] = {}
    for dr, dc, weight in rows:
        if weight == 1.0:
            full.setdefault(dr, []).append(dc)
        else:
            out += weight * a[hy + dr : hy + dr + h, hx + dc : hx + dc + w]
    for dr, at in full.items():
        lo, hi = min(at), max(at)
        if len(at) != hi - lo + 1:
            raise ValueError("a kernel's full cells must be one run in each row")
        line = prefix[hy + dr : hy + dr + h]
        out += line[:, hx + hi + 1 : hx + hi + 1 + w] - line[:, hx + lo : hx + lo + w]
    return out


def focal_blocks(cells: DataFrame, rows: list[tuple[int, int, float]], value: str, n_rows: int, n_cols: int, block: int = 512) -> DataFrame:
    """Dense form of ``focal_sum`` for one value: ``tile, r, c, value`` of cells with a sum other than 0."""
    hx, hy = max(abs(c) for _, c, _ in rows), max(abs(r) for r, _, _ in rows)
    schema = pa.schema([("tile", pa.string()), ("r", pa.int32()), ("c", pa.int32()), (value, pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        tile, br, bc = (table.column(k)[0].as_py() for k in ("tile", "br", "bc"))
        r0, c0 = br * block, bc * block
        h, w = min(block, n_rows - r0), min(block, n_cols - c0)
        a = np.zeros((h + 2 * hy, w + 2 * hx))
        at = [table.column(k).to_numpy() for k in ("r", "c", value)]
        inside = (at[0] - r0 + hy < a.shape[0]) & (at[1] - c0 + hx < a.shape[1])
        a[at[0][inside] - r0 + hy, at[1][inside] - c0 + hx] = at[2][inside]
        out = block_sums(a, rows, hx, hy)
        rr, cc = np.nonzero(out)
        return pa.table([pa.array([tile] * len(rr), pa.string()), pa.array(rr + r0, pa.int32()), pa.array(cc + c0, pa.int32()), pa.array(out[rr, cc])], schema=schema)

    dealt = with_halo(cells.select("tile", "r", "c", F.col(value).cast("double").alias(value)), block, hx, hy).where((F.col("br") * block < n_rows) & (F.col("bc") * block < n_cols))
    return dealt.groupBy("tile", "br", "bc").applyInArrow(run, f"tile string, r int, c int, {value} double")


def urban_blocks(runs: DataFrame, rows: list[tuple[int, int, float]], n_rows: int, n_cols: int, factor: int, every: int = 1, block: int = 256) -> DataFrame:
    """``tile, r, c, density, height`` straight from runs ``(tile, r, c0, c1, fid, height)`` of buildings on a grid ``factor`` times finer.

    One Arrow task a block: it burns the runs that touch the block or its halo in order of ``fid``, takes the area means, and sums them over the kernel. Cells are those of
    every ``every``-th row and column whose sums aren't 0, numbered by these. A block's memory is some times ((block + 2 halos) * factor) squared numbers.
    """
    hx, hy = max(abs(c) for _, c, _ in rows), max(abs(r) for r, _, _ in rows)
    total = sum(w for _, _, w in rows)
    schema = pa.schema([("tile", pa.string()), ("r", pa.int32()), ("c", pa.int32()), ("density", pa.float64()), ("height", pa.float64())])

    def run(table: pa.Table) -> pa.Table:
        tile, br, bc = (table.column(k)[0].as_py() for k in ("tile", "br", "bc"))
        r0, c0 = br * block, bc * block
        h, w = min(block, n_rows - r0), min(block, n_cols - c0)
        fine = np.full(((h + 2 * hy) * factor, (w + 2 * hx) * factor), np.nan, np.float32)
        order = np.argsort(table.column("fid").to_numpy(), kind="stable")
        r, a, b, height = (table.column(k).to_numpy()[order] for k in ("r", "c0", "c1", "height"))
        r, a, b = r - (r0 - hy) * factor, np.maximum(a - (c0 - hx) * factor, 0), b - (c0 - hx) * factor + 1
        for i in np.flatnonzero((r >= 0) & (r < fine.shape[0]) & (b > 0)).tolist():
            fine[r[i], a[i] : b[i]] = height[i]
        built = ~np.isnan(fine)
        mean = lambda x: x.reshape(h + 2 * hy, factor, w + 2 * hx, factor).sum((1, 3), dtype=np.float64) / factor**2
        footprint, area, valid = (block_sums(mean(x), rows, hx, hy) for x in (built, np.where(built, fine, 0), built & (fine > 0)))
        first = [-(-x // every) * every - x for x in (r0, c0)]
        footprint, area, valid = (x[first[0] :: every, first[1] :: every] for x in (footprint, area, valid))
        rr, cc = np.nonzero((footprint > 0) | (area != 0))
        density = np.clip(footprint[rr, cc] / total, 0, 1)
        tall = np.divide(area[rr, cc], valid[rr, cc], out=np.zeros(len(rr)), where=valid[rr, cc] > LEAST_VALID)
        at = [((x + f) // every + k).astype(np.int32) for x, f, k in zip((r0, c0), first, (rr, cc))]
        return pa.table([pa.array([tile] * len(rr), pa.string()), pa.array(at[0]), pa.array(at[1]), pa.array(density), pa.array(tall)], schema=schema)

    part = lambda k, d: F.floor((F.floor(F.col(k) / factor) + d) / block).cast("int")
    last = lambda n: F.lit((n - 1) // block)
    near = lambda a, b, d, n: F.sequence(F.greatest(part(a, -d), F.lit(0)), F.least(part(b, d), last(n)))
    dealt = runs.select("tile", "r", "c0", "c1", "fid", F.col("height").cast("float").alias("height")).withColumn("br", F.explode(near("r", "r", hy, n_rows))).withColumn("bc", F.explode(near("c0", "c1", hx, n_cols)))
    return dealt.groupBy("tile", "br", "bc").applyInArrow(run, "tile string, r int, c int, density double, height double")


def dense_enough(cells: DataFrame, n_cells: int, kernel_rows: int, least: float = 0.02) -> bool:
    """Whether the block form is the better one: by occupancy, and by what the sparse form would spread."""
    n = cells.count()
    return n > least * n_cells or n * kernel_rows > 10 * n_cells
