"""Thresholded majority of sub-samples, one class a cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import dims


def threshold_majority(sub: DataFrame, factor: int, thresholds: dict[int, float] = dims.CLASS_THRESHOLDS, row: str = "sr", col: str = "sc") -> DataFrame:
    """``tile, r, c, cls, dominant, source, water, bare`` of the cells that have a sub-sample.

    A class is eligible if its share of the whole cell reaches its threshold; the most frequent eligible class wins, of equals the
    later one in the tie order. Without one the class is 255 and ``dominant`` 0. One aggregate of a count a class: its buffers have a fixed
    width, so it combines map-side in a hash table, and each cell is shuffled once.
    """
    n = factor * factor
    cell = sub.where(F.col("cls").between(0, 12)).select("tile", F.floor(F.col(row) / factor).cast("int").alias("r"), F.floor(F.col(col) / factor).cast("int").alias("c"), "cls")
    counts = cell.groupBy("tile", "r", "c").agg(*[F.count_if(F.col("cls") == c).alias(f"k{c}") for c in range(13)])
    ranked = [F.when((F.col(f"k{c}") > 0) & (F.col(f"k{c}") >= t * n), F.struct(F.col(f"k{c}").alias("k"), F.lit(dims.TIE_RANK[c]).alias("rank"), F.lit(c).alias("cls"))) for c, t in sorted(thresholds.items())]
    best = counts.withColumn("best", F.greatest(*ranked))
    total = sum((F.col(f"k{c}") for c in range(1, 13)), F.col("k0"))
    return best.select(
        "tile", "r", "c",
        F.coalesce(F.col("best")["cls"], F.lit(dims.NODATA)).alias("cls"),
        (F.coalesce(F.col("best")["k"], F.lit(0)) / F.lit(n)).alias("dominant"),
        (total / F.lit(n)).alias("source"), (F.col("k0") / F.lit(n)).alias("water"), (F.col("k12") / F.lit(n)).alias("bare"),
    )


def on_grid(majority: DataFrame, cells: DataFrame) -> DataFrame:
    """Every cell of the grid, 255 and zeros where no sub-sample was."""
    joined = cells.join(majority, ["tile", "r", "c"], "left")
    zeros = {k: 0.0 for k in ("dominant", "source", "water", "bare")}
    return joined.fillna(zeros | {"cls": dims.NODATA})
