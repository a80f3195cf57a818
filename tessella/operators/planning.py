"""Plans over tiles: blocks, chunks, split pieces, sample places, and the work that is left."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tiles as T


def _upto(n) -> Column:
    return F.sequence(F.lit(0), F.lit(n - 1) if isinstance(n, int) else (n - 1).cast("int"))


def block_plan(rows: int, cols: int, block: int, spark) -> DataFrame:
    """``br, bc, r0, c0, h, w``: blocks of a grid, smaller ones at its ends."""
    step = lambda n: F.sequence(F.lit(0), F.lit(n - 1), F.lit(block))
    p = spark.range(1).select(F.explode(step(rows)).alias("r0")).select("r0", F.explode(step(cols)).alias("c0"))
    part = lambda k: F.floor(F.col(k) / block).cast("int")
    return p.select(part("r0").alias("br"), part("c0").alias("bc"), "r0", "c0", F.least(F.lit(block), rows - F.col("r0")).alias("h"), F.least(F.lit(block), cols - F.col("c0")).alias("w"))


def chunk_plan(tiles: DataFrame, pixels: int, rows: int, cols: int) -> DataFrame:
    """``tile, row, col, xoff, yoff, width, height, west, south, east, north`` of ``tiles (tile)``; boundaries are rounded, halves to even, so any number covers the tile."""
    at = lambda i, n: F.rint(i * F.lit(float(pixels)) / F.lit(float(n))).cast("int")
    p = tiles.select("tile", T.tile_corner(F.col("tile")).alias("corner"), F.explode(_upto(rows)).alias("row")).select("*", F.explode(_upto(cols)).alias("col"))
    p = p.withColumns({"yoff": at(F.col("row"), rows), "y1": at(F.col("row") + 1, rows), "xoff": at(F.col("col"), cols), "x1": at(F.col("col") + 1, cols)})
    lon, north, step = F.col("corner.lon"), F.col("corner.lat") + 1, F.lit(1.0 / pixels)
    return p.select(
        "tile", "row", "col", "xoff", "yoff", (F.col("x1") - F.col("xoff")).alias("width"), (F.col("y1") - F.col("yoff")).alias("height"),
        (lon + F.col("xoff") * step).alias("west"), (north - F.col("y1") * step).alias("south"), (lon + F.col("x1") * step).alias("east"), (north - F.col("yoff") * step).alias("north"),
    )


def split_plan(tiles: DataFrame, pixels: int, n: int) -> DataFrame:
    """``tile, row, col, name, xoff, yoff, size, west, south, east, north`` of n x n pieces; n must divide the tile."""
    if n < 1 or pixels % n:
        raise ValueError(f"{n} pieces don't divide {pixels} pixels")
    part, step = pixels // n, F.lit(1.0 / n)
    p = tiles.select("tile", T.tile_corner(F.col("tile")).alias("corner"), F.explode(_upto(n)).alias("row")).select("*", F.explode(_upto(n)).alias("col"))
    west, north = F.col("corner.lon") + F.col("col") * step, F.col("corner.lat") + 1 - F.col("row") * step
    name = F.format_string("%s_q%02d%02d", F.col("tile"), F.col("row"), F.col("col"))
    return p.select("tile", "row", "col", name.alias("name"), (F.col("col") * part).alias("xoff"), (F.col("row") * part).alias("yoff"), F.lit(part).alias("size"), west.alias("west"), (north - step).alias("south"), (west + step).alias("east"), north.alias("north"))


def sample_side(samples: int, least: int = 16) -> int:
    return max(least, round(samples**0.5))


def sample_places(spark, rows: int, cols: int, side: int) -> DataFrame:
    """``r, c`` of a regular side x side grid of places, without the raster's edges."""
    at = lambda i, n: F.floor(i * F.lit((n - 1) / (side + 1.0))).cast("int")
    lines = F.sequence(F.lit(1), F.lit(side))
    p = spark.range(1).select(F.explode(lines).alias("i")).select("i", F.explode(lines).alias("j"))
    return p.select(at(F.col("i"), rows).alias("r"), at(F.col("j"), cols).alias("c"))


def remaining(plan: DataFrame, manifest: DataFrame, fingerprint: str, keys: tuple[str, ...] = ("tile", "row", "col")) -> DataFrame:
    """What a manifest of completed work with the same fingerprint doesn't have."""
    done = manifest.where(F.col("fingerprint") == fingerprint).select(*keys).distinct()
    return plan.join(done, list(keys), "left_anti")


def selected_tiles(requested: DataFrame, available: DataFrame) -> DataFrame:
    """The tiles asked for that there are, each once, in order."""
    return requested.select("tile").distinct().join(available.select("tile"), "tile", "left_semi").orderBy("tile")


def first_seen(names: list[str]) -> list[str]:
    """Tile names without repeats, in the order given."""
    return list(dict.fromkeys(x.strip().upper() for x in names))
