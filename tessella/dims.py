"""Rule tables, as plain values and as small DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODATA = 255
QA_FALLBACK, QA_URBAN, QA_OUTSIDE = 253, 254, 255
ELEVATION_NODATA = -32768

# Class -> (height in m, density in %).
RF_PROFILE = {
    0: (0, 0),
    1: (8, 115),
    2: (12, 65),
    3: (19, 130),
    4: (24, 105),
    5: (30, 140),
    6: (4, 45),
    7: (6, 35),
    8: (3, 65),
    9: (3, 40),
    10: (2, 15),
    11: (2, 20),
    12: (0, 0),
    13: (10, 150),
    14: (20, 175),
}
# Land-use code -> class; codes that aren't listed are dropped.
LAND_USE = {
    1100: 11, 1130: 10, 1131: 10, 1160: 9, 1161: 9, 1180: 11, 1181: 11, 1211: 9, 1212: 9,
    1221: 7, 1222: 7, 1230: 7, 1240: 7, 1300: 10, 1320: 10, 1321: 10, 1330: 10, 1410: 6, 1420: 6, 1500: 6,
    1600: 10, 1610: 10, 1800: 7, 2000: 3, 4100: 10, 4210: 8, 4220: 10, 5000: 10, 6000: 12, 7000: 0,
}
LAND_USE_PHYSICAL = {6000: 12, 7000: 0}
# Topographic cover code -> class; generic forest is no part of the override layer.
COVER = {11: 12, 12: 12, 13: 12, 14: 12, 21: 3, 22: 7, 23: 9, 24: 7, 25: 9, 26: 8, 27: 8, 31: 0, 32: 0, 33: 12}
GENERIC_FOREST = 21
COVER_SPECIFIC = {k: v for k, v in COVER.items() if k != GENERIC_FOREST}
# Water symbols.
HYDRO_SYMBOLS = ("11,02", "31,01", "15,02", "33", "34", "36", "37")
# Legacy class -> class; others stay.
LEGACY_REMAP = {0: 0, 1: 3, 2: 3, 3: 3, 4: 3, 5: 3, 6: 6, 7: 7, 8: 8, 9: 6, 10: 10, 11: 11, 12: 12}
# Of classes with equal counts the later one wins.
TIE_ORDER = (10, 11, 9, 6, 8, 7, 2, 1, 3, 4, 5, 12, 0)
TIE_RANK = {c: i for i, c in enumerate(TIE_ORDER)}
# Least share of a cell's area.
WATER_THRESHOLD = BARE_THRESHOLD = 0.75
OTHER_THRESHOLD = 0.25
CLASS_THRESHOLDS = {c: 0.75 if c in (0, 12) else 0.25 for c in range(13)}
# Forest rule. Phase -> (class if closure is 1 or 2, class otherwise); the other phases go by stock.
FOREST_PHASES = {1: (1, 2), 8: (2, 2), 9: (2, 2), 10: (2, 2), 2: (3, 2), 3: (5, 4), 4: (4, 4), 5: (5, 5), 6: (5, 5), 11: (5, 5)}
FOREST_P70 = 383.16062176165804
FOREST_STOCK = 200.0
# Urban rule.
URBAN = {"radius_m": 45.0, "lo_density": 0.0725, "tall_density": 0.1375, "tall_height": 17.0, "dense_density": 0.27, "dense_height": 11.0}
# Layers by precedence, later ones over earlier ones.
LAYERS = ("land_use", "forest", "land_use_physical", "cover_specific", "hydro")
TILES = tuple(f"N{lat}E0{lon}" for lat in (45, 46) for lon in (13, 14, 15, 16))
METRES_PER_ARCSECOND = 30.87


def lookup(mapping: dict, key: Column) -> Column:
    """The mapping as an expression; null for other keys. Small tables need no join."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key) if pairs else F.lit(None)


def rf_profile(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, h, d) for c, (h, d) in RF_PROFILE.items()], "cls int, height int, density int")


def thresholds(spark: SparkSession, values: dict[int, float] = CLASS_THRESHOLDS) -> DataFrame:
    return spark.createDataFrame([(c, t, TIE_RANK[c]) for c, t in values.items()], "cls int, threshold double, tie_rank int")
