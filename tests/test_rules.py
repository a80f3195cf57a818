"""Truth tables of the rules."""

import math

import pytest
from pyspark.sql import functions as F

from tessella import dims
from tessella.config import ElevationConfig, LandCoverConfig, effective_thresholds, fingerprint, parse_class_thresholds, parse_hydro_symbols, pixels_per_degree, resolution_label, sample_factor
from tessella.functions import scalar as S
from tessella.functions import tiles as T
from tessella.operators import majority, overlay, quantile


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"at int, {schema}").select("at", *columns).orderBy("at").drop("at").collect()]


def forest(phase, closure, stock, p70=dims.FOREST_P70):
    closed, dense = closure in (1, 2), stock is not None and stock >= p70
    if phase in dims.FOREST_PHASES:
        return dims.FOREST_PHASES[phase][0 if closed else 1]
    if phase == 7:
        return 5 if closed or dense else 4
    return 5 if dense else 4 if stock is not None and stock >= 200 else 2


def test_forest(spark):
    rows = [(p, c, s) for p in [*range(13), 99, None] for c in (0, 1, 2, 3, None) for s in (None, 0.0, 199.9, 200.0, 383.16, 383.17)]
    got = values(spark, rows, "p int, c int, s double", S.forest_class(F.col("p"), F.col("c"), F.col("s")))
    assert [x[0] for x in got] == [forest(*r) for r in rows]


def test_urban(spark):
    rows = [(5, 0.14, 17.0, True), (5, 0.14, 16.9, True), (0, 0.27, 11.0, True), (5, 0.27, 11.0, True), (5, 0.07, 99.0, True), (5, 0.5, 50.0, False)]
    got = values(spark, rows, "b int, d double, h double, i boolean", S.urban_class(F.col("b"), F.col("d"), F.col("h"), F.col("i")))
    assert [x[0] for x in got] == [14, 13, 0, 14, 5, 5]


def test_quantiser_and_percent(spark):
    rows = [(0.5,), (1.5,), (-0.5,), (40000.0,), (float("nan"),), (-32768.0,), (None,), (float("inf"),), (-40000.0,)]
    assert [x[0] for x in values(spark, rows, "z double", S.quantise_elevation(F.col("z")))] == [0, 2, 0, 32767, None, None, None, None, None]
    assert [x[0] for x in values(spark, [(0.005,), (0.015,), (2.0,), (-1.0,)], "z double", S.percent(F.col("z")))] == [0, 2, 100, 0]


def test_parsing(spark):
    rows = [("12",), (" 7.9 ",), ("abc",), ("",), (None,), ("1e20",), ("nan",), ("-3.5",)]
    assert [x[0] for x in values(spark, rows, "s string", S.safe_int(F.col("s")))] == [12, 7, None, None, None, None, None, -3]
    assert [x[0] for x in values(spark, [(2,), (9,), (0,), (200,)], "c int", S.legacy_class(F.col("c")))] == [3, 6, 0, 200]
    assert [x[0] for x in values(spark, [(1 / 9,), (0.25,), (1.0,), (0.7,)], "a double", S.resolution_label(F.col("a")))] == ["1over9", "1over4", "1over1", "0p7arcsec"]
    assert [x[0] for x in values(spark, [(3661.0,), (59.6,), (0.5,), (-1.0,), (None,)], "a double", S.duration(F.col("a")))] == ["01:01:01", "00:01:00", "00:00:00", "--:--:--", "--:--:--"]
    assert [x[0] for x in values(spark, [(50.0,), (300.0,), (-1.0,), (None,), (float("nan"),)], "a double", S.building_height(F.col("a")))] == [50.0, 0.0, 0.0, 0.0, 0.0]


def test_tiles(spark):
    got = values(spark, [("N45E014",), (" s01w002 ",), ("N45E14",)], "t string", T.tile_corner(F.col("t")))
    assert [x[0] and tuple(x[0]) for x in got] == [(45, 14), (-1, -2), None]


MICRO = [
    ({0: 47, 8: 17}, 8, 17 / 64),
    ({0: 48, 8: 16}, 0, 0.75),
    ({3: 32, 4: 32}, 4, 0.5),
    ({10: 16}, 10, 0.25),
    ({10: 15}, 255, 0.0),
]


def test_majority(spark):
    rows = []
    for k, (counts, _, _) in enumerate(MICRO):
        flat = [c for c, n in counts.items() for _ in range(n)]
        rows += [("T", i // 8, 8 * k + i % 8, c) for i, c in enumerate(flat)]
    got = majority.threshold_majority(spark.createDataFrame(rows, "tile string, sr int, sc int, cls int"), 8).orderBy("c").collect()
    assert [(x.cls, x.dominant) for x in got] == [(c, d) for _, c, d in MICRO]
    assert got[3].source == 0.25 and got[0].water == 47 / 64
    empty = majority.on_grid(majority.threshold_majority(spark.createDataFrame([], "tile string, sr int, sc int, cls int"), 8), overlay.grid(spark, 2, 2))
    assert {(x.cls, x.dominant) for x in empty.collect()} == {(255, 0.0)}


def test_quantile(spark):
    df = spark.createDataFrame([(1.0, 2.0), (5.0, 3.0), (9.0, 5.0), (100.0, 0.0), (float("nan"), 3.0), (7.0, None)], "v double, w double")
    assert {x.q: x.value for x in quantile.weighted_quantiles(df, "v", "w", [0.5, 0.7, 0.2]).collect()} == {0.5: 5.0, 0.7: 9.0, 0.2: 1.0}
    assert all(math.isnan(x.value) for x in quantile.weighted_quantiles(df.limit(0), "v", "w", [0.5]).collect())
    with pytest.raises(ValueError):
        quantile.stock_p70(spark.createDataFrame([], "lzsku string, povrsina string"))


def test_precedence(spark):
    a = spark.createDataFrame([(1, 1, 7, 5), (1, 2, 7, 5)], "r int, c int, cls int, fid int")
    b = spark.createDataFrame([(1, 1, 0, 1)], "r int, c int, cls int, fid int")
    got = overlay.paint(overlay.layered({"hydro": b, "land_use": a}), ["r", "c"], ["prio", "fid"])
    assert {(x.r, x.c): x.cls for x in got.collect()} == {(1, 1): 0, (1, 2): 7}


def test_config():
    assert parse_class_thresholds("01=0.30; 08=0,40") == {1: 0.3, 8: 0.4}
    for bad in ("13=0.5", "1=0", "1=1.5", "x"):
        with pytest.raises(ValueError):
            parse_class_thresholds(bad)
    got = effective_thresholds(0.3, zero_clutter=0.6, bare=0.9, per_class={5: 0.1})
    assert (got[0], got[12], got[5], got[1]) == (0.6, 0.9, 0.1, 0.3)
    assert effective_thresholds()[0] == 0.75
    assert parse_hydro_symbols("11,02; 33") == ("11,02", "33")
    assert pixels_per_degree(0.7) == 5143 and sample_factor(1.0, 0.25) == 4 and resolution_label(0.7) == "0p7arcsec"
    with pytest.raises(ValueError):
        pixels_per_degree(0.7, True)
    for bad in ({"supersample": 3}, {"block_size": 8}, {"kernel_mode": "x"}, {"urban_arcsec": 0.3}):
        with pytest.raises(ValueError):
            LandCoverConfig(**bad)
    for bad in ({"stage": "x"}, {"arcsec": 0.05}, {"split_grid": 0}):
        with pytest.raises(ValueError):
            ElevationConfig(**bad)
    assert fingerprint(LandCoverConfig()) != fingerprint(LandCoverConfig(p70=400.0))
    assert LandCoverConfig().thresholds == dims.CLASS_THRESHOLDS


def test_block_geotransform(spark):
    gt = F.struct(F.lit(13.5).alias("x0"), F.lit(0.25).alias("dx"), F.lit(46.5).alias("y0"), F.lit(-0.25).alias("dy"))
    got = spark.range(1).select(T.block_geotransform(gt, F.lit(4), F.lit(2), 5).alias("g")).first().g
    assert tuple(got) == (14.0, 0.05, 45.5, -0.05)
