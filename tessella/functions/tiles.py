"""Tile names, bounds, geotransforms and cell sizes, as column arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims

# The patterns of file and tile names.
FILE_PATTERN = r"(?i)^([NS])(\d{2})([EW])(\d{3})\.lcv$"
NAME_PATTERN = r"^([NS])(\d{2})([EW])(\d{3})$"


def _parts(name: Column, pattern: str) -> tuple[Column, Column]:
    sign = lambda i, minus: F.when(F.upper(F.regexp_extract(name, pattern, i)) == minus, -1).otherwise(1)
    number = lambda i: F.regexp_extract(name, pattern, i).try_cast("int")
    return sign(1, "S") * number(2), sign(3, "W") * number(4)


def tile_of_file(name: Column) -> Column:
    """(lat, lon) of the south-west corner from a file name; null if it isn't one."""
    lat, lon = _parts(name, FILE_PATTERN)
    return F.when(name.rlike(FILE_PATTERN), F.struct(lat.alias("lat"), lon.alias("lon")))


def tile_corner(name: Column) -> Column:
    """(lat, lon) of a tile name of seven letters, in either case, with spaces around it."""
    clean = F.upper(F.trim(name))
    lat, lon = _parts(clean, NAME_PATTERN)
    return F.when(clean.rlike(NAME_PATTERN), F.struct(lat.alias("lat"), lon.alias("lon")))


def corner_of(name: str) -> tuple[int, int]:
    """``tile_corner`` of one name on the driver."""
    m = re.match(NAME_PATTERN, name.strip().upper())
    if not m:
        raise ValueError(f"{name} is no tile")
    return int(m[2]) * (-1 if m[1] == "S" else 1), int(m[4]) * (-1 if m[3] == "W" else 1)


def bounds(corner: Column) -> Column:
    lat, lon = corner["lat"], corner["lon"]
    return F.struct(lon.alias("west"), lat.alias("south"), (lon + 1).alias("east"), (lat + 1).alias("north"))


def intervals(arcsec: Column) -> Column:
    """Cells along a degree, halves to even; grids registered by nodes have one more."""
    return F.rint(F.lit(3600.0) / arcsec).cast("long")


def node_geotransform(corner: Column, arcsec: Column) -> Column:
    """Origin half a cell outside the corner, so that centres lie on whole multiples of the cell."""
    step = F.lit(1.0) / intervals(arcsec)
    return F.struct((corner["lon"] - step / 2).alias("x0"), step.alias("dx"), (corner["lat"] + 1 + step / 2).alias("y0"), (-step).alias("dy"))


def block_geotransform(gt: Column, r0: Column, c0: Column, factor: int) -> Column:
    """Of a block that starts at cell (r0, c0), with cells ``factor`` times finer."""
    return F.struct((gt["x0"] + c0 * gt["dx"]).alias("x0"), (gt["dx"] / factor).alias("dx"), (gt["y0"] + r0 * gt["dy"]).alias("y0"), (gt["dy"] / factor).alias("dy"))


def cell_metres(lat: Column, arcsec: Column) -> Column:
    """North-south and east-west metres of a cell, at the middle of a tile whose south edge is ``lat``."""
    ns = arcsec * dims.METRES_PER_ARCSECOND
    return F.struct(ns.alias("ns"), (ns * F.cos(F.radians(lat + 0.5))).alias("ew"))


def global_node(corner: Column, r: Column, c: Column, n: int = 3600) -> Column:
    """A key that tiles share on their common edges."""
    return F.struct(((corner["lat"] + 1) * n - r).alias("gr"), (corner["lon"] * n + c).alias("gc"))
