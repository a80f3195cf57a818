"""One query an operator, over the adapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import dims
from ..functions import scalar as S
from ..functions import tiles as T
from ..operators import blocks, fill, focal, geometry, majority, overlay, planning, qa, quantile, resample
from ..sources import tables
from ..sources.vectors import pick_layer
from . import adapters as A

ARCSECONDS = (1.0, 0.5, 0.25, 1 / 9, 0.1, 0.7)
PAINT = ["prio", "l_orderkey", "l_linenumber", "l_partkey"]


def _plain(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Whole numbers as bigint, others as double, perhaps rounded."""
    cast = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}
    out = [F.col(c).cast(cast[t]).alias(c) if t in cast else F.col(c) for c, t in df.dtypes]
    df = df.select(*out)
    return df if digits is None else df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _natural(spark: SparkSession, sf: str) -> DataFrame:
    painted = overlay.paint(A.subcells(spark, sf), ["tile", "sr", "sc"], PAINT)
    return majority.on_grid(majority.threshold_majority(painted, A.FACTOR), overlay.grid(spark, A.SIDE, A.SIDE, A.legacy(spark, sf).select("tile").distinct()))


def _masked(spark: SparkSession, sf: str) -> DataFrame:
    old = A.legacy(spark, sf).withColumnRenamed("cls", "legacy")
    return overlay.on_cells(_natural(spark, sf), old, "left").withColumn("inside", F.coalesce("inside", F.lit(False)))


def landcover_majority(spark: SparkSession, sf: str) -> DataFrame:
    x = _masked(spark, sf)
    return _plain(x.select("tile", "r", "c", "cls", "dominant", "source", overlay.fallback(F.col("cls"), S.legacy_class(F.col("legacy"))).alias("final")))


def landcover_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same natural classes, by the block form: runs of one sub-cell each."""
    x = A.subcells(spark, sf).withColumn("fid", F.row_number().over(Window.partitionBy("tile", "sr", "sc").orderBy(*PAINT))).withColumnRenamed("sr", "r")
    runs = x.select("tile", "r", F.col("sc").alias("c0"), F.col("sc").alias("c1"), "prio", "fid", "cls")
    return _plain(blocks.to_cells(blocks.painted_majority(runs, A.SIDE, A.SIDE, 8, A.FACTOR)).select("tile", "r", "c", "cls"))


def class_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(qa.class_histogram(_masked(spark, sf), keep=F.col("inside")))


def qa_counters(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(qa.tile_counters(_masked(spark, sf)), 6)


def qa_status_partition(spark: SparkSession, sf: str) -> DataFrame:
    x = _masked(spark, sf)
    code = qa.qa_status(F.col("inside"), F.col("cls"), F.col("dominant"), F.col("legacy").isin(13, 14))
    return _plain(x.select(code.alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).withColumn("status", qa.status_name(F.col("code"))))


def layer_precedence(spark: SparkSession, sf: str) -> DataFrame:
    x = A.subcells(spark, sf)
    parts = {name: x.where(F.col("prio") == i + 1).drop("prio") for i, name in enumerate(("land_use", "forest", "hydro"))}
    painted = overlay.paint(overlay.layered(parts, ("land_use", "forest", "hydro")), ["tile", "sr", "sc"], PAINT)
    return _plain(painted.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("sr") * 64 + F.col("sc")).alias("places")))


def recode_codes(spark: SparkSession, sf: str) -> DataFrame:
    codes = [*dims.LAND_USE, 9999, 1]
    x = A.table(spark, sf, "orders").select("o_orderkey", F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("o_orderkey") % len(codes) + 1).cast("int")).alias("code"), "o_custkey")
    text = F.when(F.col("o_custkey") % 3 == 0, F.concat(F.col("code").cast("string"), F.lit(".0"))).when(F.col("o_custkey") % 17 == 1, F.lit("n/a")).otherwise(F.col("code").cast("string"))
    return _plain(x.select("o_orderkey", S.recode(dims.LAND_USE, text).alias("cls")).where("cls is not null"))


def hydro_filter(spark: SparkSession, sf: str) -> DataFrame:
    symbol = F.expr("CASE event_type WHEN 'click' THEN '11,02' WHEN 'view' THEN '31,01' WHEN 'purchase' THEN '34' WHEN 'signup' THEN '99' END")
    return _plain(A.table(spark, sf, "events").select("event_id", symbol.alias("symbol")).select("event_id", "symbol", S.hydro_class(F.col("symbol")).alias("cls")).where("cls = 0"))


def building_clean(spark: SparkSession, sf: str) -> DataFrame:
    x = A.table(spark, sf, "part").select("p_partkey", (F.col("p_size") % 5).alias("stan"), (F.col("p_retailprice") - 1100).alias("h")).where("stan in (2, 3)")
    return _plain(x.select("p_partkey", "stan", S.building_height(F.col("h")).alias("height")))


def forest_structure(spark: SparkSession, sf: str) -> DataFrame:
    x = A.stands(spark, sf)
    stock = S.safe_ratio(F.col("stock"), F.col("area"))
    return _plain(x.select("fid", S.forest_class(F.col("phase"), F.col("closure"), stock, 900.0).alias("cls")))


def weighted_quantile(spark: SparkSession, sf: str) -> DataFrame:
    x = A.stands(spark, sf).where("area > 0 and stock >= 0").select(S.safe_ratio(F.col("stock"), F.col("area")).alias("ratio"), "area")
    return _plain(quantile.weighted_quantiles(x, "ratio", "area", [0.1, 0.5, 0.7, 0.95, 1.0]), 6)


def tile_parse(spark: SparkSession, sf: str) -> DataFrame:
    names = spark.createDataFrame([(x,) for x in ["N45E014.lcv", "n46e013.LCV", "S01W002.lcv", "N45E14.lcv", "N45E014.bil", "XN45E014.lcv"]], "name string")
    found = names.select("name", T.tile_of_file(F.col("name")).alias("c"))
    return _plain(found.select("name", F.col("c.lat").alias("lat"), F.col("c.lon").alias("lon")))


def tile_bounds(spark: SparkSession, sf: str) -> DataFrame:
    x = A.tiles(spark).select("tile", T.bounds(T.tile_corner(F.lower(F.concat(F.lit(" "), "tile")))).alias("b"))
    return _plain(x.select("tile", "b.*"))


def _arcs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(x,) for x in ARCSECONDS], "arcsec double")


def grid_params(spark: SparkSession, sf: str) -> DataFrame:
    x = A.tiles(spark).crossJoin(F.broadcast(_arcs(spark))).withColumn("corner", T.tile_corner(F.col("tile")))  # 6 rows
    gt, m = T.node_geotransform(F.col("corner"), F.col("arcsec")), T.cell_metres(F.col("corner.lat"), F.col("arcsec"))
    n = T.intervals(F.col("arcsec"))
    return _plain(x.select("tile", F.round("arcsec", 6).alias("arcsec"), n.alias("n"), (n + 1).alias("nodes"), F.round(gt["x0"], 9).alias("x0"), F.round(gt["y0"], 9).alias("y0"), F.round(m["ns"], 6).alias("ns"), F.round(m["ew"], 6).alias("ew")))


def block_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(planning.block_plan(3601, 3601, 512, spark))


def chunk_plan(spark: SparkSession, sf: str) -> DataFrame:
    plans = [planning.chunk_plan(A.tiles(spark), 5143, n, n).withColumn("n", F.lit(n)) for n in (1, 5, 7, 12)]
    out = plans[0]
    for p in plans[1:]:
        out = out.unionByName(p)
    return _plain(out, 9)


def split_plan(spark: SparkSession, sf: str) -> DataFrame:
    plans = [planning.split_plan(A.tiles(spark), 32400, n).withColumn("n", F.lit(n)) for n in (1, 4, 8)]
    return _plain(plans[0].unionByName(plans[1]).unionByName(plans[2]), 9)


def resolution_label(spark: SparkSession, sf: str) -> DataFrame:
    return _arcs(spark).select(F.round("arcsec", 6).alias("arcsec"), S.resolution_label(F.col("arcsec")).alias("label"))


def bbox_filter(spark: SparkSession, sf: str) -> DataFrame:
    boxes = overlay.grid(spark, 4, 4).select((F.col("r") * 4 + F.col("c")).alias("box"), (F.col("c") * 32).cast("double").alias("west"), ((F.col("c") + 1) * 32).cast("double").alias("east"), (F.col("r") * 32).cast("double").alias("south"), ((F.col("r") + 1) * 32).cast("double").alias("north"))
    return _plain(geometry.box_join(boxes, geometry.with_envelope(A.footprints(spark, sf)), 16.0).select("box", "fid"))


def _burned(spark: SparkSession, sf: str) -> DataFrame:
    return geometry.scan_cells(A.footprints(spark, sf), ["fid", "height"], 128, 128)


def scanline_raster(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_burned(spark, sf).groupBy("r", "c").agg(F.count(F.lit(1)).alias("n")))


def height_burn(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(geometry.last_burn(_burned(spark, sf), "height"))


def area_mean_downsample(spark: SparkSession, sf: str) -> DataFrame:
    cells = geometry.occupied(_burned(spark, sf)).select(F.lit("T").alias("tile"), "r", "c", F.lit(1.0).alias("share"))
    return _plain(resample.area_mean(cells, 4, "share").drop("tile"))


def _urban_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Footprint share, height area and valid share on a 32 x 32 grid of 4 x 4 sub-cells."""
    cells = geometry.last_burn(_burned(spark, sf), "height").select(F.lit("T").alias("tile"), "r", "c", F.lit(1.0).alias("footprint"), F.col("height").cast("double").alias("height_area"), F.when(F.col("height") > 0, 1.0).otherwise(0.0).alias("valid"))
    key = [F.col("tile"), F.expr("cast(r div 4 AS int)").alias("r"), F.expr("cast(c div 4 AS int)").alias("c")]
    return cells.groupBy(*key).agg(*[(F.sum(v) / 16.0).alias(v) for v in ("footprint", "height_area", "valid")])


def footprint_stats(spark: SparkSession, sf: str) -> DataFrame:
    x = _urban_cells(spark, sf).groupBy("tile").agg(F.count_if(F.col("footprint") > 0).alias("touched"), F.sum("footprint").alias("equivalent"))
    return _plain(x.select("touched", "equivalent", (F.col("equivalent") * 100 / F.col("touched")).alias("coverage_pct")), 6)


def strided_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(resample.strided(geometry.last_burn(_burned(spark, sf), "height"), 4))


def nearest_upsample(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(resample.nearest_upsample(A.legacy(spark, sf), 32, 101))


def bilinear_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(resample.bilinear(A.sample_points(spark, sf), A.elevation(spark, sf), "id"), 6)


def quantise_elevation(spark: SparkSession, sf: str) -> DataFrame:
    x = A.table(spark, sf, "events").select("event_id", ((F.col("value") - 245) * 200).alias("z"), F.when(F.col("event_id") % 7 == 0, 0).otherwise(1).alias("valid"))
    return _plain(x.select("event_id", S.quantise_elevation(F.col("z"), F.col("valid")).alias("z")))


def elevation_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Rasters and themselves shifted by one cell, at a regular grid of places, by tile."""
    z = A.elevation(spark, sf)
    places = planning.sample_places(spark, 40, 25, planning.sample_side(256))
    new = z.join(F.broadcast(places.distinct()), ["r", "c"])  # as many rows as samples
    old = z.select("tile", "r", (F.col("c") - 1).alias("c"), F.col("z").alias("old"))
    return _plain(qa.difference_statistics(new.join(old, ["tile", "r", "c"]).withColumn("d", F.col("z") - F.col("old")), "d", ["tile"]), 6)


def focal_binary(spark: SparkSession, sf: str) -> DataFrame:
    rows = focal.kernel(5.0, 1.0, 0.8, "binary")
    return _plain(focal.focal_sum(A.sparse(spark, sf), rows, ["v"], 200, 200).drop("tile"))


def focal_box(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(focal.box_sum(A.sparse(spark, sf), "v", 3).select("r", "c", "box"))


def _kernel() -> list[tuple[int, int, float]]:
    return focal.kernel(2.5, 1.0, 0.8, "weighted", 64)


def focal_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(focal.urban_measures(_urban_cells(spark, sf), _kernel(), 32, 32).drop("tile"), 6)


def focal_block(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(focal.focal_blocks(A.sparse(spark, sf), focal.kernel(5.0, 1.0, 0.8, "binary"), "v", 200, 200, 64).drop("tile"), 6)


def urban_classify(spark: SparkSession, sf: str) -> DataFrame:
    x = A.built(spark, sf).select("tile", "r", "c", (F.col("v") % 8 / 16).alias("density"), (F.col("v") * 3 % 25).alias("height"))
    base = A.legacy(spark, sf).withColumnRenamed("cls", "base")
    j = overlay.on_cells(base, x, "left").fillna({"density": 0.0, "height": 0.0})
    return _plain(j.select("tile", "r", "c", S.urban_class(F.col("base"), F.col("density"), F.col("height"), F.col("inside")).alias("cls"), S.hi_tall(F.col("density"), F.col("height")).alias("hi_tall"), S.hi_dense(F.col("density"), F.col("height")).alias("hi_dense")))


def neighbour_count(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(fill.neighbour_count(A.legacy(spark, sf).where("cls = 5")))


def legacy_fill_round(spark: SparkSession, sf: str) -> DataFrame:
    x = A.legacy(spark, sf)
    target = F.col("inside") & F.col("cls").isin(13, 14)
    return _plain(fill.best_neighbour(x.where(target), x.where(~target)))


def legacy_fill(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(fill.fill_legacy_urban(A.legacy(spark, sf)).select("tile", "r", "c", "cls", "inside"))


def legacy_remap(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(A.legacy(spark, sf).select("tile", "r", "c", S.legacy_class(F.col("cls")).alias("cls")))


def rf_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(tables.rf_lines(spark).orderBy("cls"))


def rf_heights(spark: SparkSession, sf: str) -> DataFrame:
    x = A.legacy(spark, sf).join(F.broadcast(dims.rf_profile(spark)), "cls")  # 15 rows
    return _plain(x.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.sum("height").alias("height"), F.sum("density").alias("density")))


def split_lossless(spark: SparkSession, sf: str) -> DataFrame:
    z = A.elevation(spark, sf).select("tile", "r", "c", S.quantise_elevation((F.col("z") - 245) * 200).alias("z"))
    back = resample.merge_keys(resample.split_keys(z, 10).withColumn("z", F.when((F.col("pr") == 3) & (F.col("pc") == 3), F.col("z") + 1).otherwise(F.col("z"))), 10)
    a, b = resample.split_keys(z, 10), resample.split_keys(back.select("tile", "r", "c", "z"), 10)
    return _plain(qa.mismatches(a, b, ["tile", "piece_row", "piece_col", "pr", "pc"], "z", ["tile", "piece_row", "piece_col"]))


def seam_check(spark: SparkSession, sf: str) -> DataFrame:
    x = qa.seams(planning.split_plan(A.tiles(spark), 32400, 4))
    return _plain(x.select("tile", "row", "col", "side", (F.col("gap") < 1e-12).alias("closed")))


def resume_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    plan = planning.chunk_plan(A.tiles(spark), 5143, 12, 12).select("tile", "row", "col")
    done = A.table(spark, sf, "events").select(F.element_at(F.array(*[F.lit(t) for t in dims.TILES]), (F.col("event_id") % 8 + 1).cast("int")).alias("tile"), F.expr("cast(event_id div 8 % 12 AS int)").alias("row"), F.expr("cast(event_id div 96 % 12 AS int)").alias("col"), F.when(F.col("event_id") % 1152 % 5 == 0, "old").otherwise("new").alias("fingerprint"))
    return _plain(planning.remaining(plan, done, "new"))


def layer_catalog_pick(spark: SparkSession, sf: str) -> DataFrame:
    n = A.table(spark, sf, "nation")
    catalog = n.select(F.concat(F.lit("/d/"), "n_name").alias("path"), F.lit("layer").alias("layer"), F.when(F.col("n_nationkey") % 3 == 0, F.array(F.lit("RABA_ID"), F.lit("x"))).otherwise(F.array(F.lit("y"))).alias("fields"), (F.col("n_regionkey") * 10).alias("n"), F.length("n_name").alias("size"))
    return _plain(pick_layer(catalog, ["raba_id"]).select("path", "layer", "n", "size"))


def selected_tiles(spark: SparkSession, sf: str) -> DataFrame:
    asked = A.table(spark, sf, "nation").select(F.element_at(F.array(*[F.lit(t) for t in (*dims.TILES, "N47E014")]), (F.col("n_nationkey") % 9 + 1).cast("int")).alias("tile"))
    return planning.selected_tiles(asked, A.tiles(spark))


def sample_places(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(planning.sample_places(spark, 1200, 900, planning.sample_side(4096, 3)))


def mask_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """The mask of a coarse grid on a finer one."""
    x = resample.nearest_upsample(A.legacy(spark, sf).withColumn("inside", F.col("inside").cast("int")), 32, 63, "inside")
    return _plain(x.groupBy("tile", "r").agg(F.sum("inside").alias("inside"), F.count(F.lit(1)).alias("n")))


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(_arcs(spark).select(F.round("arcsec", 6).alias("arcsec"), T.intervals(F.col("arcsec")).alias("pixels")))


ALL = (
    landcover_majority, landcover_blocks, class_histogram, qa_counters, qa_status_partition, layer_precedence, recode_codes, hydro_filter, building_clean, forest_structure, weighted_quantile,
    tile_parse, tile_bounds, grid_params, block_plan, chunk_plan, split_plan, resolution_label, bbox_filter, scanline_raster, height_burn, area_mean_downsample, footprint_stats, strided_sample,
    nearest_upsample, bilinear_sample, quantise_elevation, elevation_compare, focal_binary, focal_box, focal_weighted, focal_block, urban_classify, neighbour_count, legacy_fill_round, legacy_fill,
    legacy_remap, rf_profile, rf_heights, split_lossless, seam_check, resume_anti_join, layer_catalog_pick, selected_tiles, sample_places, mask_nearest, pixels,
)
