"""Dense grids as blocks of bytes: cells to blocks, runs to classes, blocks to files."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims

BLOCK_SCHEMA = "tile string, br int, bc int, r0 int, c0 int, h int, w int, data binary"
MEASURES = ("dominant", "source", "water", "bare")


def split_runs(runs: DataFrame, block: int) -> DataFrame:
    """Runs ``(tile, r, c0, c1, ...)`` cut at block edges, keyed by block."""
    part = lambda k: F.floor(F.col(k) / block).cast("int")
    cut = runs.withColumn("br", part("r")).withColumn("bc", F.explode(F.sequence(part("c0"), part("c1"))))
    return cut.withColumn("c0", F.greatest("c0", F.col("bc") * block)).withColumn("c1", F.least("c1", (F.col("bc") + 1) * block - 1))


def painted_majority(runs: DataFrame, n_rows: int, n_cols: int, block: int, factor: int, thresholds: dict[int, float] = dims.CLASS_THRESHOLDS) -> DataFrame:
    """Class blocks from runs ``(tile, r, c0, c1, prio, fid, cls)`` on a grid ``factor`` times finer.

    Each block paints its runs in order of (prio, fid) and takes the thresholded majority: the dense form of ``paint`` and
    ``threshold_majority``, with its measures as counts of sub-samples, a byte a cell each. A block's memory is some times (block * factor) squared bytes, whatever the data.
    """
    ranks = [dims.TIE_RANK[c] for c in range(13)]

    def run(table: pa.Table) -> pa.Table:
        tile, br, bc = (table.column(k)[0].as_py() for k in ("tile", "br", "bc"))
        h, w = min(block, n_rows - br * block), min(block, n_cols - bc * block)
        fine = np.full((h * factor, w * factor), dims.NODATA, np.uint8)
        order = np.lexsort([table.column(k).to_numpy() for k in ("fid", "prio")])
        r, a, b, cls = (table.column(k).to_numpy()[order] for k in ("r", "c0", "c1", "cls"))
        r, a, b = r - br * block * factor, a - bc * block * factor, b - bc * block * factor + 1
        for i in range(len(r)):
            if r[i] < fine.shape[0]:
                fine[r[i], a[i] : b[i]] = cls[i]
        cells = fine.reshape(h, factor, w, factor)
        counts = np.stack([(cells == c).sum((1, 3)) for c in range(13)])
        least = np.array([thresholds[c] * factor * factor for c in range(13)])[:, None, None]
        key = np.where(counts >= least, counts * 16 + np.array(ranks)[:, None, None], -1)
        key[counts == 0] = -1
        best = np.where(key.max(0) >= 0, key.argmax(0), dims.NODATA).astype(np.uint8)
        won = np.where(best == dims.NODATA, 0, np.take_along_axis(counts, np.minimum(best, 12)[None], 0)[0])
        measures = [x.astype(np.uint8).tobytes() for x in (won, counts.sum(0), counts[0], counts[12])]
        return pa.table([pa.array([tile]), *[pa.array([x], pa.int32()) for x in (br, bc, br * block, bc * block, h, w)], *[pa.array([x], pa.binary()) for x in (best.tobytes(), *measures)]], names=["tile", "br", "bc", "r0", "c0", "h", "w", "data", *MEASURES])

    if factor > 15:
        raise ValueError("a cell has 225 sub-samples at most")
    return split_runs(runs, block * factor).groupBy("tile", "br", "bc").applyInArrow(run, BLOCK_SCHEMA + "".join(f", {k} binary" for k in MEASURES))


def measured_cells(blocks: DataFrame, factor: int) -> DataFrame:
    """``tile, r, c, cls, dominant, source, water, bare`` of blocks of ``painted_majority``: cells with a sub-sample, measures as shares of a cell."""

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                a, n = np.frombuffer(x["data"], np.uint8), factor * factor
                counts = [np.frombuffer(x[k], np.uint8) for k in MEASURES]
                at = np.flatnonzero(counts[1])
                r, c = np.divmod(at, x["w"])
                yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * len(at), pa.string()), pa.array(r + x["r0"], pa.int32()), pa.array(c + x["c0"], pa.int32()), pa.array(a[at].astype(np.int32)), *[pa.array(k[at] / n) for k in counts]], ["tile", "r", "c", "cls", *MEASURES])

    return blocks.mapInArrow(run, "tile string, r int, c int, cls int" + "".join(f", {k} double" for k in MEASURES))


def to_cells(blocks: DataFrame, value: str = "cls") -> DataFrame:
    """``tile, r, c, value`` of uint8 blocks."""

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                a = np.frombuffer(x["data"], np.uint8)
                r, c = np.divmod(np.arange(len(a)), x["w"])
                yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * len(a), pa.string()), pa.array(r + x["r0"], pa.int32()), pa.array(c + x["c0"], pa.int32()), pa.array(a.astype(np.int32))], ["tile", "r", "c", value])

    return blocks.mapInArrow(run, f"tile string, r int, c int, {value} int")


def to_blocks(cells: DataFrame, n_rows: int, n_cols: int, block: int, value: str = "cls", nodata: int = dims.NODATA) -> DataFrame:
    """uint8 blocks of the cells; places without one have ``nodata``."""

    def run(table: pa.Table) -> pa.Table:
        tile, br, bc = (table.column(k)[0].as_py() for k in ("tile", "br", "bc"))
        h, w = min(block, n_rows - br * block), min(block, n_cols - bc * block)
        a = np.full((h, w), nodata, np.uint8)
        a[table.column("r").to_numpy() - br * block, table.column("c").to_numpy() - bc * block] = table.column(value).to_numpy()
        return pa.table([pa.array([tile]), *[pa.array([x], pa.int32()) for x in (br, bc, br * block, bc * block, h, w)], pa.array([a.tobytes()], pa.binary())], names=["tile", "br", "bc", "r0", "c0", "h", "w", "data"])

    part = lambda k: F.floor(F.col(k) / block).cast("int")
    return cells.select("tile", "r", "c", value).withColumn("br", part("r")).withColumn("bc", part("c")).groupBy("tile", "br", "bc").applyInArrow(run, BLOCK_SCHEMA)


def raster_rows(blocks: DataFrame) -> DataFrame:
    """``tile, r, data``: whole raster rows, each put together from its blocks' slices."""

    def run(batches):
        for batch in batches:
            for x in batch.to_pylist():
                rows = [x["data"][i * x["w"] : (i + 1) * x["w"]] for i in range(x["h"])]
                yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * len(rows), pa.string()), pa.array(range(x["r0"], x["r0"] + len(rows)), pa.int32()), pa.array([x["bc"]] * len(rows), pa.int32()), pa.array(rows, pa.binary())], ["tile", "r", "bc", "part"])

    parts = blocks.mapInArrow(run, "tile string, r int, bc int, part binary")
    return parts.groupBy("tile", "r").agg(F.array_sort(F.collect_list(F.struct("bc", "part"))).alias("p")).select("tile", "r", F.aggregate(F.transform("p", lambda x: x["part"]), F.lit(b""), lambda a, b: F.concat(a, b)).alias("data"))
