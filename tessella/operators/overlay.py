"""Overlays: painting by precedence, masks, fallbacks and positional comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims


def grid(spark: SparkSession, rows: int, cols: int, tiles: DataFrame | None = None, r: str = "r", c: str = "c") -> DataFrame:
    """All cells of a grid, for each of ``tiles (tile)``; made where it is used, never shipped."""
    base = tiles.select("tile") if tiles is not None else spark.range(1).select(F.lit("T").alias("tile"))
    lines = base.select("tile", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias(r))
    return lines.select("tile", r, F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias(c))


def layered(layers: dict[str, DataFrame], order: tuple[str, ...] = dims.LAYERS) -> DataFrame:
    """The union of named layers with their precedence ``prio``, from 1."""
    some = [layers[name].withColumn("prio", F.lit(i + 1)) for i, name in enumerate(order) if name in layers]
    if not some:
        raise ValueError("no layer")
    return reduce(lambda a, b: a.unionByName(b), some)


def paint(cells: DataFrame, keys: list[str], order: list[str], value: str = "cls") -> DataFrame:
    """The last painted value of each cell: one map-side combined aggregate."""
    return cells.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def masked(inside: Column, a: Column, b: Column) -> Column:
    return F.when(inside, a).otherwise(b)


def fallback(cls: Column, legacy: Column) -> Column:
    """The legacy class where there is none."""
    return F.coalesce(F.nullif(cls, F.lit(dims.NODATA)), legacy, F.lit(dims.NODATA))


def on_cells(a: DataFrame, b: DataFrame, how: str = "inner", keys: tuple[str, ...] = ("tile", "r", "c")) -> DataFrame:
    """Two rasters side by side."""
    return a.join(b, list(keys), how)
