"""Resampling: nearest, strided, area mean and bilinear."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nearest_index(k: Column, n: int, target: int) -> Column:
    """The source index of target index k: evenly spaced over both ends, halves to even."""
    return F.rint(k * F.lit((n - 1) / (target - 1))).cast("int")


def nearest_upsample(source: DataFrame, n: int, target: int, value: str = "cls") -> DataFrame:
    """``tile, r, c, value`` on a target x target grid: each source cell spreads to the target cells that read it, so no second join is needed."""
    spread = lambda i: F.filter(F.sequence(F.greatest(F.floor((i - 1) * F.lit((target - 1) / (n - 1))).cast("int"), F.lit(0)), F.least(F.ceil((i + 1) * F.lit((target - 1) / (n - 1))).cast("int"), F.lit(target - 1))), lambda k: nearest_index(k, n, target) == i)
    rows = source.select("tile", "r", "c", value).select("tile", F.explode(spread(F.col("r"))).alias("r"), "c", value)
    return rows.select("tile", "r", F.explode(spread(F.col("c"))).alias("c"), value)


def area_mean(cells: DataFrame, factor: int, value: str, row: str = "r", col: str = "c") -> DataFrame:
    """Means over factor x factor cells; cells that are missing count as 0."""
    keys = [F.col("tile"), F.floor(F.col(row) / factor).cast("int").alias("r"), F.floor(F.col(col) / factor).cast("int").alias("c")]
    return cells.groupBy(*keys).agg((F.sum(value) / F.lit(float(factor * factor))).alias(value))


def strided(cells: DataFrame, factor: int) -> DataFrame:
    """Every factor-th node in both directions."""
    keep = cells.where((F.col("r") % factor == 0) & (F.col("c") % factor == 0))
    return keep.withColumn("r", F.floor(F.col("r") / factor).cast("int")).withColumn("c", F.floor(F.col("c") / factor).cast("int"))


def bilinear(points: DataFrame, raster: DataFrame, key: str, value: str = "z") -> DataFrame:
    """``points (key, x, y)`` with the raster's value there, in pixel coordinates whose cell centres are at halves.

    Null unless all four neighbours have data. The raster meets the points once, on their exploded 2 x 2 neighbours. If both have a ``tile``,
    each tile is a raster of its own; else there is one for all.
    """
    tile = ["tile"] if "tile" in points.columns and "tile" in raster.columns else []
    fx, fy = F.col("x") - 0.5, F.col("y") - 0.5
    p = points.select(key, *tile, F.floor(fx).cast("int").alias("c0"), F.floor(fy).cast("int").alias("r0"), (fx - F.floor(fx)).alias("u"), (fy - F.floor(fy)).alias("v"))
    corners = F.array(*[F.struct((F.col("r0") + i).alias("r"), (F.col("c0") + j).alias("c"), ((F.col("v") if i else 1 - F.col("v")) * (F.col("u") if j else 1 - F.col("u"))).alias("w")) for i in (0, 1) for j in (0, 1)])
    near = p.select(key, *tile, F.explode(corners).alias("q")).select(key, *tile, "q.*")
    valid = raster.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*tile, "r", "c", F.col(value).cast("double").alias("z"))
    got = near.join(valid, [*tile, "r", "c"], "left").groupBy(key).agg(F.sum(F.col("w") * F.col("z")).alias("z"), F.count("z").alias("n"))
    return got.select(key, F.when(F.col("n") == 4, F.col("z")).alias(value))


def split_keys(df: DataFrame, part: int) -> DataFrame:
    """Lossless split: the piece and the place in it, by arithmetic on the keys."""
    q = lambda k: F.floor(F.col(k) / part).cast("int")
    return df.withColumns({"piece_row": q("r"), "piece_col": q("c"), "pr": F.col("r") % part, "pc": F.col("c") % part})


def merge_keys(pieces: DataFrame, part: int) -> DataFrame:
    return pieces.withColumns({"r": F.col("piece_row") * part + F.col("pr"), "c": F.col("piece_col") * part + F.col("pc")})
