"""The land-cover build: prepared layers, natural classes, legacy fallback, urban classes, gates and reports, for all tiles in one plan."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..config import LandCoverConfig, fingerprint, pixels_per_degree
from ..functions import scalar as S
from ..functions import tiles as T
from ..operators import blocks, fill, focal, geometry, majority, overlay, planning, qa, quantile, resample
from ..sources import rasters, tables


def prepare_stands(stands: DataFrame, p70: float | None = dims.FOREST_P70) -> DataFrame:
    """``fid, cls, rings`` of forest stands (``rfaza, sklep, povrsina, lzsku``); every stand is kept. Without ``p70`` it is computed from them."""
    p70 = quantile.stock_p70(stands) if p70 is None else p70
    stock = S.safe_ratio(S.safe_double(F.col("lzsku")), S.safe_double(F.col("povrsina")))
    return stands.select("fid", S.forest_class(S.safe_int(F.col("rfaza")), S.safe_int(F.col("sklep")), stock, p70).alias("cls"), "rings")


def prepare_mapped(shapes: DataFrame, code: str, mapping: dict[int, int]) -> DataFrame:
    """Shapes whose code is listed, with its class. The filter comes first, and on a column of whole numbers it is one that Parquet applies itself."""
    whole = dict(shapes.dtypes)[code] in ("tinyint", "smallint", "int", "bigint")
    kept = shapes.where((F.col(code) if whole else S.safe_int(F.col(code))).isin(*mapping))
    return kept.select("fid", S.recode(mapping, F.col(code)).alias("cls"), "rings")


def prepare_hydro(shapes: DataFrame, symbols: tuple[str, ...] = dims.HYDRO_SYMBOLS) -> DataFrame:
    return shapes.where(F.col("simbol").cast("string").isin(*symbols)).select("fid", F.lit(0).alias("cls"), "rings")


def prepare_buildings(shapes: DataFrame) -> DataFrame:
    """Buildings under construction or in use, with heights that make sense."""
    return shapes.where(S.safe_int(F.col("stan_konst")).isin(2, 3)).select("fid", S.building_height(S.safe_double(F.col("visina"))).alias("height"), "rings")


def prepare_layers(sources: dict[str, DataFrame], config: LandCoverConfig) -> dict[str, DataFrame]:
    """The five layers from ``land_use, stands, cover, hydro``; missing ones are left out."""
    out = {}
    if "land_use" in sources:
        out["land_use"] = prepare_mapped(sources["land_use"], "raba_id", dims.LAND_USE)
        out["land_use_physical"] = prepare_mapped(sources["land_use"], "raba_id", dims.LAND_USE_PHYSICAL)
    if "stands" in sources:
        out["forest"] = prepare_stands(sources["stands"], config.p70)
    if "cover" in sources:
        out["cover_specific"] = prepare_mapped(sources["cover"], "vrsta_pok", dims.COVER_SPECIFIC)
    if "hydro" in sources:
        out["hydro"] = prepare_hydro(sources["hydro"], config.hydro_symbols)
    return out


def runs_on_tiles(shapes: DataFrame, keep: list[str], tiles: DataFrame, arcsec: float, factor: int, step: float = 1 / 16) -> DataFrame:
    """``tile, keep, r, c0, c1``: shapes in longitude and latitude, scan-converted on each tile's node grid, ``factor`` times finer.

    Shapes meet tiles by buckets of ``step`` degrees on their envelopes, and only those they touch.
    """
    n = (pixels_per_degree(arcsec) + 1) * factor
    gt = T.node_geotransform(F.col("corner"), F.lit(float(arcsec)))
    boxes = tiles.select("tile", T.tile_corner(F.col("tile")).alias("corner")).select("tile", gt.alias("gt"))
    width = F.col("gt.dx") * (n // factor)
    boxes = boxes.select("tile", "gt", F.col("gt.x0").alias("west"), (F.col("gt.x0") + width).alias("east"), (F.col("gt.y0") - width).alias("south"), F.col("gt.y0").alias("north"))
    near = geometry.box_join(boxes, geometry.with_envelope(shapes.select(*keep, "rings")), step)
    d = F.col("gt.dx") / factor
    to_grid = lambda x, y: F.struct(((x - F.col("gt.x0")) / d).alias("x"), ((F.col("gt.y0") - y) / d).alias("y"))
    return geometry.scan_runs(near.select("tile", *keep, geometry.transformed(F.col("rings"), to_grid).alias("rings")), ["tile", *keep], n, n)


def kernels(config: LandCoverConfig) -> list[tuple[int, list[tuple[int, int, float]]]]:
    """A kernel for each latitude that tiles have."""
    ns = 3600 / pixels_per_degree(config.urban_arcsec) * dims.METRES_PER_ARCSECOND
    lats = sorted({T.corner_of(t)[0] for t in config.tiles})
    return [(lat, focal.kernel(config.urban_radius_m, ns * math.cos(math.radians(lat + 0.5)), ns, config.kernel_mode, config.kernel_quadrature)) for lat in lats]


@dataclass
class LandCover:
    """Tables of a build; each is lazy. ``cells``: tile, r, c, original, inside, natural, cls, status and measures."""

    cells: DataFrame
    urban: DataFrame
    counters: DataFrame
    histogram: DataFrame


def natural_classes(layers: dict[str, DataFrame], tiles: DataFrame, config: LandCoverConfig, dense: bool = True) -> DataFrame:
    """Thresholded majority of the painted layers, as cells with their measures: by blocks, or if not ``dense`` by rows of sub-samples, which suits a few small shapes."""
    shapes = overlay.layered({k: v.select("fid", "cls", "rings") for k, v in layers.items()})
    runs = runs_on_tiles(shapes, ["prio", "fid", "cls"], tiles, config.arcsec, config.supersample)
    side = pixels_per_degree(config.arcsec) + 1
    if dense:
        return blocks.measured_cells(blocks.painted_majority(runs, side, side, config.block_size, config.supersample, config.thresholds), config.supersample)
    fine = runs.select("tile", F.col("r").alias("sr"), F.explode(F.sequence("c0", "c1")).alias("sc"), "prio", "fid", "cls")
    return majority.threshold_majority(overlay.paint(fine, ["tile", "sr", "sc"], ["prio", "fid"]), config.supersample, config.thresholds)


def urban_measures(buildings: DataFrame, tiles: DataFrame, config: LandCoverConfig, dense: bool = True) -> DataFrame:
    """``tile, r, c, density, height`` on the target grid, from buildings on the finer analysis grid: by blocks, or if not ``dense`` by rows of fine cells."""
    factor = config.urban_supersample
    runs = runs_on_tiles(buildings, ["fid", "height"], tiles, config.urban_arcsec, factor)
    side = pixels_per_degree(config.urban_arcsec) + 1
    per = round(pixels_per_degree(config.urban_arcsec) / pixels_per_degree(config.arcsec))
    if dense:
        parts = [focal.urban_blocks(runs.where(T.tile_corner(F.col("tile"))["lat"] == lat), kernel, side, side, factor, per, config.block_size) for lat, kernel in kernels(config)]
        return reduce(DataFrame.unionByName, parts)
    fine = geometry.last_burn(runs.select("tile", "fid", "height", "r", F.explode(F.sequence("c0", "c1")).alias("c")), "height", keys=("tile", "r", "c"))
    fine = fine.select("tile", "r", "c", F.lit(1.0).alias("footprint"), F.col("height").alias("height_area"), (F.col("height") > 0).cast("double").alias("valid"))
    key = ["tile", F.floor(F.col("r") / factor).cast("int").alias("r"), F.floor(F.col("c") / factor).cast("int").alias("c")]
    cells = fine.groupBy(*key).agg(*[(F.sum(v) / F.lit(float(factor**2))).alias(v) for v in ("footprint", "height_area", "valid")])
    parts = [focal.urban_measures(cells.where(T.tile_corner(F.col("tile"))["lat"] == lat), kernel, side, side) for lat, kernel in kernels(config)]
    return resample.strided(reduce(DataFrame.unionByName, parts), per)


def build(spark: SparkSession, layers: dict[str, DataFrame], buildings: DataFrame | None, legacy: DataFrame, mask: DataFrame, config: LandCoverConfig) -> LandCover:
    """All tiles of ``legacy (tile, r, c, cls, side)``: outside ``mask (tile, r, c)`` the original stays, also in tiles without any mask cell."""
    side = pixels_per_degree(config.arcsec) + 1
    wanted = spark.createDataFrame([(t,) for t in config.tiles], "tile string")
    tiles = planning.selected_tiles(wanted, legacy.select("tile").distinct())
    old = legacy.join(tiles, "tile", "left_semi")
    sides = [x.side for x in old.select("side").distinct().collect()]
    same = [old.where(F.col("side") == n).select("tile", "r", "c", "cls") if n == side else resample.nearest_upsample(old.where(F.col("side") == n), n, side) for n in sides]
    if not same:
        raise ValueError("none of the tiles has a legacy grid")
    original = same[0]
    for x in same[1:]:
        original = original.unionByName(x)
    base = original.join(mask.select("tile", "r", "c").withColumn("inside", F.lit(True)), ["tile", "r", "c"], "left").withColumn("inside", F.coalesce("inside", F.lit(False)))
    filled = fill.fill_legacy_urban(base).select("tile", "r", "c", F.when(F.col("inside"), S.legacy_class(F.col("cls"))).otherwise(F.col("cls")).alias("legacy"))
    natural = majority.on_grid(natural_classes(layers, tiles, config), original.select("tile", "r", "c")).withColumnRenamed("cls", "natural")
    x = base.withColumnRenamed("cls", "original").join(filled, ["tile", "r", "c"]).join(natural, ["tile", "r", "c"])
    x = x.withColumn("before", overlay.masked(F.col("inside"), overlay.fallback(F.col("natural"), F.col("legacy")), F.col("original")))
    rule = {"lo_density": config.lo_density, "tall_density": config.tall_density, "tall_height": config.tall_height, "dense_density": config.dense_density, "dense_height": config.dense_height}
    urban = urban_measures(buildings, tiles, config) if buildings is not None else spark.createDataFrame([], "tile string, r int, c int, density double, height double")
    x = x.join(urban, ["tile", "r", "c"], "left").fillna({"density": 0.0, "height": 0.0})
    x = x.withColumn("cls", S.urban_class(F.col("before"), F.col("density"), F.col("height"), F.col("inside"), rule))
    built = F.col("cls").isin(13, 14) & (F.col("before") != F.col("cls"))
    cells = x.withColumn("status", qa.qa_status(F.col("inside"), F.col("natural"), F.col("dominant"), built)).withColumn("hi_tall", S.hi_tall(F.col("density"), F.col("height"), rule)).withColumn("hi_dense", S.hi_dense(F.col("density"), F.col("height"), rule))
    counters = qa.tile_counters(cells.drop("cls").withColumnRenamed("natural", "cls"), config.thresholds)
    extra = cells.groupBy("tile").agg(F.count_if(F.col("inside") & (F.col("status") == dims.QA_URBAN) & (F.col("cls") == 13)).alias("urban_lo"), F.count_if(F.col("inside") & (F.col("status") == dims.QA_URBAN) & (F.col("cls") == 14)).alias("urban_hi"), F.count_if("hi_tall").alias("hi_tall"), F.count_if("hi_dense").alias("hi_dense"))
    return LandCover(cells, urban, counters.join(extra, "tile").orderBy("tile"), qa.class_histogram(cells, keep=F.col("inside")).orderBy("tile"))


def check(result: LandCover) -> None:
    """All gates; raises at the first one that doesn't hold."""
    cells = result.cells
    qa.gate_no_legacy_urban(cells.select("inside", F.col("legacy").alias("cls")))
    qa.gate_outside_unchanged(cells)
    qa.gate_class_range(cells)
    qa.gate_status_partition(cells)
    qa.gate_water_kept(cells.select(F.col("before").alias("natural"), "cls"))
    qa.gate_forest_structure(result.histogram)


def outputs(result: LandCover, side: int, block: int = 512) -> DataFrame:
    """Rows of the final grids, ready for ``write_raster_files``."""
    return blocks.raster_rows(blocks.to_blocks(result.cells.select("tile", "r", "c", "cls"), side, side, block))


# The fields that a source must have.
REQUIRED = {"land_use": ["raba_id"], "stands": ["rfaza", "sklep", "povrsina", "lzsku"], "cover": ["vrsta_pok"], "hydro": ["simbol"]}


def prepared(spark: SparkSession, sources: dict[str, DataFrame], config: LandCoverConfig, folder: str, rebuild: bool = False, lon0: float | None = None) -> dict[str, DataFrame]:
    """``prepare_layers`` as written tables under ``folder/<key>``; the key depends on the options and the layers' names, and a layer that is there is not made again unless ``rebuild``.
    A source without its fields, or without rows, raises.

    With ``lon0``, the sources' coordinates are transverse Mercator metres around that meridian, and come out as longitude and latitude.
    """
    out: dict[str, DataFrame] = {}
    for name, df in sources.items():
        qa.gate_fields(df, REQUIRED.get(name, []))
    for name, df in prepare_layers(sources, config).items():
        path = f"{folder}/{fingerprint(config)}/{name}{'' if lon0 is None else f'-{lon0:g}'}"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if rebuild or not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            if lon0 is not None:
                df = df.withColumn("rings", geometry.transformed(F.col("rings"), lambda x, y: geometry.geographic(x, y, lon0)))
            df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.schema(df.schema).parquet(path)
    return out


def boundary_mask(spark: SparkSession, boundary: DataFrame | None, fallback: DataFrame, tiles: DataFrame, arcsec: float = 1.0) -> DataFrame:
    """``tile, r, c`` of the node cells inside the state: by its one boundary shape, or by all shapes of ``fallback`` where there is none. Several boundary shapes raise."""
    shapes = fallback
    if boundary is not None:
        n = boundary.limit(2).count()
        if n > 1:
            raise ValueError("the boundary must be one shape")
        shapes = boundary if n else fallback
    runs = runs_on_tiles(shapes.select("fid", "rings"), ["fid"], tiles, arcsec, 1)
    return runs.select("tile", "r", F.explode(F.sequence("c0", "c1")).alias("c")).distinct()


def warped_mask(raster: DataFrame, gt: tuple[float, float, float, float], tiles: DataFrame, arcsec: float = 1.0, nodata: float = 0.0) -> DataFrame:
    """``tile, r, c`` of the node cells whose centre lies in a cell with data of ``raster (r, c, value)``, whose geotransform is (west, cell width, north, cell height).

    Each raster cell spreads to the node cells that it covers, so that the nearest lookup needs no join.
    """
    n = pixels_per_degree(arcsec)
    west, dx, north, dy = (F.lit(float(x)) for x in gt)
    some = raster.where(is_inside(F.col("value"), nodata))
    # nodes lie on multiples of 1 / n degree; a cell has those in [west, east) and (south, north]
    i0, i1 = F.ceil((west + F.col("c") * dx) * n - 1e-9), F.ceil((west + (F.col("c") + 1) * dx) * n - 1e-9) - 1
    j0, j1 = F.floor((north - (F.col("r") + 1) * dy) * n + 1e-9) + 1, F.floor((north - F.col("r") * dy) * n + 1e-9)
    nodes = some.select(i0.alias("i0"), i1.alias("i1"), j0.alias("j0"), j1.alias("j1")).where("i0 <= i1 and j0 <= j1").select(F.explode(F.sequence("i0", "i1")).alias("i"), "j0", "j1").select("i", F.explode(F.sequence("j0", "j1")).alias("j"))
    # a node on a degree line belongs to the tiles on both sides
    corner = T.tile_corner(F.col("tile"))
    boxes = F.broadcast(tiles.select("tile", (corner["lon"] * n).alias("x"), (corner["lat"] * n).alias("y")))  # tiles, not cells
    met = nodes.join(boxes, F.col("i").between(F.col("x"), F.col("x") + n) & F.col("j").between(F.col("y"), F.col("y") + n))
    return met.select("tile", (F.col("y") + n - F.col("j")).cast("int").alias("r"), (F.col("i") - F.col("x")).cast("int").alias("c")).distinct()


def write(spark: SparkSession, result: LandCover, config: LandCoverConfig, folder: str) -> dict[str, str | None]:
    """All outputs of a build that passes its gates, by name: byte grids, RF profile, documentation, report by tile, and if asked for status and class rasters with their mosaics.

    ``folder`` is one that all executors share. What comes to the driver has a row a tile.
    """
    side = pixels_per_degree(config.arcsec) + 1
    step = 1 / (side - 1)
    check(result)

    def place(tile: str) -> tuple[float, float, float]:
        lat, lon = T.corner_of(tile)
        return lon - step / 2, lat + 1 + step / 2, step

    grids = rasters.write_raster_files(outputs(result, side), f"{folder}/lcv", side, side)
    qa.gate_file_size(spark.createDataFrame(grids.collect(), grids.schema), side * side)
    out: dict[str, str | None] = {"grids": f"{folder}/lcv", "profile": f"{folder}/lcv/landheight.dat", "report": f"{folder}/qa_by_tile.csv", "documentation": f"{folder}/doc"}
    tables.write_rf_profile(spark, f"{folder}/lcv/landheight.dat")
    tables.write_documentation(spark, f"{folder}/doc", asdict(config), config.thresholds)
    tables.write_report([x.asDict() for x in result.counters.join(result.histogram, "tile").orderBy("tile").collect()], f"{folder}/qa_by_tile.csv")
    for name, value, wanted in (("status", "status", config.qa), ("preview", "cls", config.preview)):
        if wanted:
            rows = blocks.raster_rows(blocks.to_blocks(result.cells.select("tile", "r", "c", F.col(value).cast("int").alias("cls")), side, side, config.block_size))
            made = rasters.write_geotiffs(rows, f"{folder}/{name}", side, side, place, dims.NODATA).collect()
            files = [{"path": x.path, "west": place(x.tile)[0], "north": place(x.tile)[1], "step": step, "width": side, "height": side} for x in made]
            text = rasters.mosaic_xml(files, "Byte", dims.NODATA)
            out[name] = text and f"{folder}/{name}.vrt"
            if text:
                tables.write_text(f"{folder}/{name}.vrt", text)
    return out


def is_inside(mask_value: Column, nodata: float = 0.0) -> Column:
    """A mask cell counts if it has data."""
    return mask_value.isNotNull() & (mask_value != nodata)
