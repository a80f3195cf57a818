"""Polygons as rings of points: envelopes, range joins, scan conversion and burning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RINGS = "array<struct<ring:int,pts:array<struct<x:double,y:double>>>>"


def points(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda g: g["pts"]))


def with_envelope(df: DataFrame, rings: str = "rings") -> DataFrame:
    """xmin, ymin, xmax, ymax: kept as columns they prune Parquet row groups."""
    p = points(F.col(rings))
    low = lambda k: F.array_min(F.transform(p, lambda q: q[k]))
    high = lambda k: F.array_max(F.transform(p, lambda q: q[k]))
    return df.select("*", low("x").alias("xmin"), low("y").alias("ymin"), high("x").alias("xmax"), high("y").alias("ymax"))


def in_box(west, south, east, north) -> Column:
    """Envelopes that meet the box, edges included."""
    return (F.col("xmax") >= west) & (F.col("xmin") <= east) & (F.col("ymax") >= south) & (F.col("ymin") <= north)


def box_join(boxes: DataFrame, shapes: DataFrame, step: float) -> DataFrame:
    """Pairs of ``boxes (west, south, east, north)`` and ``shapes`` with envelopes that meet: an equi-join on grid buckets of side ``step``, each pair once.

    A pair is kept only in the bucket that holds the lower left corner of their intersection.
    """
    span = lambda a, b: F.sequence(F.floor(a / step), F.floor(b / step))
    a = boxes.withColumn("bx", F.explode(span(F.col("west"), F.col("east")))).withColumn("by", F.explode(span(F.col("south"), F.col("north"))))
    b = shapes.withColumn("bx", F.explode(span(F.col("xmin"), F.col("xmax")))).withColumn("by", F.explode(span(F.col("ymin"), F.col("ymax"))))
    joined = a.join(b, ["bx", "by"]).where(in_box(F.col("west"), F.col("south"), F.col("east"), F.col("north")))
    once = (F.col("bx") == F.floor(F.greatest("west", "xmin") / step)) & (F.col("by") == F.floor(F.greatest("south", "ymin") / step))
    return joined.where(once).drop("bx", "by")


def edges(shapes: DataFrame, keep: list[str], rings: str = "rings") -> DataFrame:
    """One row an edge; rings close themselves."""
    g = shapes.select(*keep, F.explode(rings).alias("g")).select(*keep, F.col("g.pts").alias("p"))
    pairs = F.transform("p", lambda q, i: F.struct(q["x"].alias("x1"), q["y"].alias("y1"), F.element_at("p", (i + 1) % F.size("p") + 1)["x"].alias("x2"), F.element_at("p", (i + 1) % F.size("p") + 1)["y"].alias("y2")))
    return g.select(*keep, F.explode(pairs).alias("e")).select(*keep, "e.*")


def scan_runs(shapes: DataFrame, keep: list[str], rows: int, cols: int, rings: str = "rings") -> DataFrame:
    """``keep, r, c0, c1``: runs of cells whose centres are inside, by the even-odd rule, on a grid of unit cells.

    An edge crosses the centre lines in [ymin, ymax); a run has the centres in [x, x'). ``keep`` must identify a shape.
    """
    e = edges(shapes, keep, rings).where("y1 <> y2").withColumn("low", F.least("y1", "y2")).withColumn("high", F.greatest("y1", "y2"))
    first = F.greatest(F.ceil(F.col("low") - 0.5), F.lit(0)).cast("int")
    last = F.least(F.ceil(F.col("high") - 0.5) - 1, F.lit(rows - 1)).cast("int")
    e = e.withColumn("a", first).withColumn("b", last).where("a <= b").withColumn("r", F.explode(F.sequence("a", "b")))
    x = e.select(*keep, "r", (F.col("x1") + (F.col("r") + 0.5 - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))).alias("x"))
    order = Window.partitionBy(*keep, "r").orderBy("x")  # as many rows as a shape crosses a line
    x = x.withColumn("k", F.row_number().over(order)).withColumn("x2", F.lead("x").over(order)).where("k % 2 = 1 and x2 is not null")
    c0 = F.greatest(F.ceil(F.col("x") - 0.5), F.lit(0)).cast("int")
    c1 = F.least(F.ceil(F.col("x2") - 0.5) - 1, F.lit(cols - 1)).cast("int")
    return x.select(*keep, "r", c0.alias("c0"), c1.alias("c1")).where("c0 <= c1")


def scan_cells(shapes: DataFrame, keep: list[str], rows: int, cols: int, rings: str = "rings") -> DataFrame:
    return scan_runs(shapes, keep, rows, cols, rings).select(*keep, "r", F.explode(F.sequence("c0", "c1")).alias("c"))


def occupied(cells: DataFrame, keys: tuple[str, ...] = ("r", "c")) -> DataFrame:
    """A constant burn: shapes that overlap count once."""
    return cells.select(*keys).distinct()


def last_burn(cells: DataFrame, value: str, order: str = "fid", keys: tuple[str, ...] = ("r", "c")) -> DataFrame:
    """An attribute burn: the last shape wins, also with a 0."""
    return cells.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def reprojected(lon: Column, lat: Column, lon0: float, k: float = 0.9999, fe: float = 500_000.0, fn: float = -5_000_000.0, a: float = 6378137.0, f: float = 1 / 298.257222101) -> Column:
    """Transverse Mercator easting and northing of longitude and latitude in degrees, by the usual series."""
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    p, d = F.radians(lat), F.radians(lon - lon0)
    n = a / F.sqrt(1 - e2 * F.pow(F.sin(p), 2))
    t, c, x = F.pow(F.tan(p), 2), ep2 * F.pow(F.cos(p), 2), d * F.cos(p)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * p - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * F.sin(2 * p) + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * F.sin(4 * p) - 35 * e2**3 / 3072 * F.sin(6 * p))
    east = fe + k * n * (x + (1 - t + c) * F.pow(x, 3) / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * F.pow(x, 5) / 120)
    north = fn + k * (m + n * F.tan(p) * (x * x / 2 + (5 - t + 9 * c + 4 * c * c) * F.pow(x, 4) / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * F.pow(x, 6) / 720))
    return F.struct(east.alias("x"), north.alias("y"))


def geographic(x: Column, y: Column, lon0: float, k: float = 0.9999, fe: float = 500_000.0, fn: float = -5_000_000.0, a: float = 6378137.0, f: float = 1 / 298.257222101) -> Column:
    """Longitude and latitude in degrees of a transverse Mercator point."""
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    e1 = (1 - (1 - e2) ** 0.5) / (1 + (1 - e2) ** 0.5)
    mu = (y - fn) / k / (a * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    p = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
    s2 = F.pow(F.sin(p), 2)
    c, t = ep2 * F.pow(F.cos(p), 2), F.pow(F.tan(p), 2)
    n, r = a / F.sqrt(1 - e2 * s2), a * (1 - e2) / F.pow(1 - e2 * s2, 1.5)
    d = (x - fe) / (n * k)
    lat = p - n * F.tan(p) / r * (d * d / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * F.pow(d, 4) / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * F.pow(d, 6) / 720)
    lon = (d - (1 + 2 * t + c) * F.pow(d, 3) / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * F.pow(d, 5) / 120) / F.cos(p)
    return F.struct((F.lit(lon0) + F.degrees(lon)).alias("x"), F.degrees(lat).alias("y"))


def transformed(rings: Column, point) -> Column:
    """Every point of a shape through ``point(x, y)``."""
    return F.transform(rings, lambda g: F.struct(g["ring"].alias("ring"), F.transform(g["pts"], lambda q: point(q["x"], q["y"])).alias("pts")))
