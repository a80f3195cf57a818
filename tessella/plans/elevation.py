"""The elevation build: chunks, quantised tiles, comparison, split and their checks."""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..config import ElevationConfig, fingerprint, split_name
from ..functions import scalar as S
from ..functions import tiles as T
from ..operators import planning, qa, resample
from ..sources import imagery, rasters, tables
from ..streaming import ingest


def build(spark: SparkSession, config: ElevationConfig, folder: str, load: Callable[[dict], np.ndarray]) -> DataFrame:
    """``tile, r, c, z`` of all tiles; chunks that a manifest of the same options has are not fetched again."""
    tiles = spark.createDataFrame([(t,) for t in planning.first_seen(list(config.tiles))], "tile string")
    plan = planning.chunk_plan(tiles, config.pixels, config.chunk_rows, config.chunk_cols)
    key = fingerprint(config)
    done, out = f"{folder}/manifest", f"{folder}/{config.label}"
    if not config.overwrite:
        qa.gate_checkpoint(ingest.manifest(spark, done), key)

    def process(left: DataFrame) -> DataFrame:
        got = imagery.read_chunks(left, load)
        return got.select("tile", "row", "col", "r", "c", S.quantise_elevation(F.col("z")).alias("z"))

    ingest.ingest(plan, done, out, key, process)
    return ingest.ingested(spark, done, out, key, ["tile", "r", "c"]).select("tile", "r", "c", "z")


def write_tiles(z: DataFrame, config: ElevationConfig, folder: str) -> DataFrame:
    """16-bit BIL files with headers, one a tile: ``tile, path, length``."""
    n, step = config.pixels, 1 / config.pixels

    def header(tile: str) -> str:
        lat, lon = T.corner_of(tile)
        return rasters.bil_header(n, n, lon, lat + 1, step)

    if config.overwrite:
        for t in planning.first_seen(list(config.tiles)):
            rasters.remove_sidecars(f"{tile_folder(config, folder)}/{t}.bil")
    files = rasters.write_raster_files(rasters.int16_rows(z, n), tile_folder(config, folder), n, 2 * n, ".bil", header)
    found = z.sparkSession.createDataFrame(files.collect(), files.schema)  # a row a tile
    qa.gate_file_size(found, 2 * n * n)
    return found


def stored(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """``tile, r, c, z`` of BIL files; a missing one raises."""
    return rasters.read_bil(spark, [f"{folder}/{x}.bil" for x in names])


def compare(spark: SparkSession, z: DataFrame, reference: DataFrame | None, config: ElevationConfig, x0: float = 0.0, y0: float = 0.0, scale: float = 1.0, gt: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Difference statistics by tile at a regular grid of places.

    ``reference (tile, r, c, z)`` has a raster a tile, read bilinearly at ``x0 + scale * x``. One without ``tile`` is one raster for all, read where its
    geotransform ``gt`` (west, cell width, north, cell height) puts a place's longitude and latitude; for a single tile ``gt`` may be left out. Without a reference, a row a tile says so.
    """
    if reference is None:
        return z.select("tile").distinct().withColumn("status", F.lit("NO_REFERENCE"))
    if "tile" not in reference.columns and gt is None and len(config.tiles) > 1:
        raise ValueError("one reference for several tiles needs its geotransform")
    places = planning.sample_places(spark, config.pixels, config.pixels, planning.sample_side(config.compare_samples)).distinct()
    new = z.where("z is not null").join(F.broadcast(places), ["r", "c"])  # as many places as samples
    x, y = x0 + scale * (F.col("c") + 0.5), y0 + scale * (F.col("r") + 0.5)
    if gt is not None:
        corner, n = T.tile_corner(F.col("tile")), config.pixels
        x = (corner["lon"] + (F.col("c") + 0.5) / n - gt[0]) / gt[1]
        y = (gt[2] - (corner["lat"] + 1 - (F.col("r") + 0.5) / n)) / gt[3]
    points = new.select(F.struct("tile", "r", "c").alias("id"), "tile", x.alias("x"), y.alias("y"))
    old = resample.bilinear(points, reference, "id").select("id.*", F.col("z").alias("old"))
    return qa.difference_statistics(new.join(old, ["tile", "r", "c"]).withColumn("d", F.col("z") - F.col("old")), "d", ["tile"])


def check_tiles(spark: SparkSession, config: ElevationConfig, folder: str) -> None:
    """The stored tiles have the plan's size, type, no-data value and place."""
    n, rows = config.pixels, []
    for t in planning.first_seen(list(config.tiles)):
        path = f"{tile_folder(config, folder)}/{t}.bil"
        with open(path.removesuffix(".bil") + ".hdr") as f:
            h = rasters.parse_bil_header(f.read())
        lat, lon = T.corner_of(t)
        rows.append((t, path, os.path.getsize(path), list(map(float, rasters.header_bounds(path).values())), [float(x) for x in (lon, lat, lon + 1, lat + 1)], h["NCOLS"], h["NROWS"], f"{h['PIXELTYPE']}{h['NBITS']}", float(h["NODATA"])))
    found = spark.createDataFrame(rows, "tile string, path string, length long, gt array<double>, want array<double>, width int, height int, dtype string, nodata double").withColumn("srid", F.lit(4326))
    qa.gate_file_size(found, 2 * n * n)
    qa.gate_geotransform(found, 2e-11, n, "SIGNEDINT16", float(dims.ELEVATION_NODATA))


def pieces_of(spark: SparkSession, config: ElevationConfig) -> DataFrame:
    tiles = spark.createDataFrame([(t,) for t in planning.first_seen(list(config.tiles))], "tile string")
    return planning.split_plan(tiles, config.pixels, config.split_grid)


def write_pieces(z: DataFrame, config: ElevationConfig, folder: str) -> DataFrame:
    """The tiles cut into BIL files of their pieces, without loss: ``tile`` (a piece's name), ``path, length``."""
    spark, part = z.sparkSession, config.pixels // config.split_grid
    corners = {x["name"]: (x["west"], x["north"]) for x in pieces_of(spark, config).collect()}  # a row a piece
    keys = resample.split_keys(z, part)
    cells = keys.select(F.format_string("%s_q%02d%02d", "tile", "piece_row", "piece_col").alias("tile"), F.col("pr").alias("r"), F.col("pc").alias("c"), "z")
    step = 1 / config.pixels
    files = rasters.write_raster_files(rasters.int16_rows(cells, part), f"{folder}/{piece_folder(config)}", part, 2 * part, ".bil", lambda name: rasters.bil_header(part, part, *corners[name], step))
    found = spark.createDataFrame(files.collect(), files.schema)
    qa.gate_file_size(found, 2 * part * part)
    return found


def check_pieces(spark: SparkSession, config: ElevationConfig, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(mismatches by piece over all cells of the stored tiles and the stored pieces, seams by the stored headers, totals over all pieces); raises if a gate doesn't hold."""
    part, keys = config.pixels // config.split_grid, ["tile", "piece_row", "piece_col"]
    plan = pieces_of(spark, config).collect()
    where = f"{folder}/{piece_folder(config)}"
    whole = resample.split_keys(stored(spark, tile_folder(config, folder), planning.first_seen(list(config.tiles))), part)
    named = spark.createDataFrame([(x["name"], x["tile"], x["row"], x["col"]) for x in plan], "name string, of string, piece_row int, piece_col int")
    pieces = stored(spark, where, [x["name"] for x in plan]).withColumnsRenamed({"tile": "name", "r": "pr", "c": "pc"})
    pieces = pieces.join(F.broadcast(named), "name").withColumnRenamed("of", "tile")  # a row a piece
    counts = qa.mismatches(whole, pieces, [*keys, "pr", "pc"], "z", keys)
    qa.gate_lossless(counts)
    bounds = [(x["tile"], x["row"], x["col"], *rasters.header_bounds(f"{where}/{x['name']}.bil").values()) for x in plan]
    found = spark.createDataFrame(bounds, "tile string, row int, col int, west double, south double, east double, north double")
    planned = spark.createDataFrame(plan).select("tile", "row", "col", *[F.col(k).alias(f"want_{k}") for k in ("west", "south", "east", "north")])
    both = found.join(planned, ["tile", "row", "col"])
    gt = both.select(F.array("west", "south", "east", "north").alias("gt"), F.array("want_west", "want_south", "want_east", "want_north").alias("want"), F.lit(4326).alias("srid"))
    qa.gate_geotransform(gt, 1e-11)
    qa.gate_seams(found, 1e-9)
    totals = counts.groupBy("tile").agg(F.count(F.lit(1)).alias("pieces"), F.sum("compared").alias("compared"), F.sum("mismatches").alias("mismatches"), F.max("max_abs").alias("max_abs"))
    return counts, qa.seams(found), totals


def run(spark: SparkSession, config: ElevationConfig, folder: str, load: Callable[[dict], np.ndarray] | None = None, reference: DataFrame | None = None, gt: tuple[float, float, float, float] | None = None) -> dict[str, DataFrame]:
    """The stages that ``config.stage`` names, by name of their result. Only a build fetches and writes tiles; the other stages read those that are stored.

    Without ``load`` chunks come from ``config.service_url``. ``folder`` is one that all executors share.
    """
    out: dict[str, DataFrame] = {}
    if config.stage in ("build", "all"):
        load = load or imagery.service_loader(config.service_url, f"{folder}/chunks", config.interpolation, config.retries, config.timeout_s)
        out["tiles"] = write_tiles(build(spark, config, folder, load), config, folder)
    names = planning.first_seen(list(config.tiles))
    out["cells"] = z = stored(spark, tile_folder(config, folder), names)
    if config.stage != "build":
        check_tiles(spark, config, folder)
    if config.stage in ("qa", "all"):
        manifest = ingest.manifest(spark, f"{folder}/manifest").join(spark.createDataFrame([(t,) for t in names], "tile string"), "tile", "left_semi")
        qa.gate_storage(manifest, z.select("tile").distinct())
    if config.stage in ("compare", "all"):
        out["comparison"] = compare(spark, z, reference, config, gt=gt)
        _report(out["comparison"].orderBy("tile"), f"{folder}/comparison.csv")
    if config.stage in ("split", "all"):
        out["pieces"] = write_pieces(z, config, folder)
    if config.stage in ("split", "split-qa", "all"):
        out["split_mismatches"], out["seams"], out["split_totals"] = check_pieces(spark, config, folder)
        for name, keys in (("split_mismatches", ["tile", "piece_row", "piece_col"]), ("seams", ["tile", "row", "col", "side"]), ("split_totals", ["tile"])):
            _report(out[name].orderBy(*keys), f"{folder}/{name}.csv")
    if config.stage in ("split", "all"):
        paths = [f"{folder}/{piece_folder(config)}/{x.name}.bil" for x in pieces_of(spark, config).select("name").collect()]
        rasters.write_mosaic(f"{folder}/{piece_folder(config)}.vrt", {p: rasters.header_bounds(p) | {"step": 1 / config.pixels} for p in paths}, required=True)
    if config.stage in ("build", "all"):
        paths = [f"{tile_folder(config, folder)}/{t}.bil" for t in names]
        rasters.write_mosaic(f"{tile_folder(config, folder)}.vrt", {p: rasters.header_bounds(p) | {"step": 1 / config.pixels} for p in paths})
    return out


def _report(rows: DataFrame, path: str) -> None:
    tables.write_report([x.asDict() for x in rows.collect()], path)  # a row a tile, piece or seam


def tile_folder(config: ElevationConfig, folder: str) -> str:
    return f"{folder}/{config.label}_BIL"


def piece_folder(config: ElevationConfig) -> str:
    return split_name(config.label, config.split_grid)
