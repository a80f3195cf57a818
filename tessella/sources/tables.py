"""Text outputs: CSV with a byte-order mark, the RF profile, definitions and metadata."""

from __future__ import annotations

import csv
import glob
import io
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions.scalar import rf_number

# The classes' names.
CLASS_NAMES = {
    0: "Water",
    1: "F1 Young closed / low dense forest",
    2: "F2 Low-medium open forest",
    3: "F3 Medium closed forest",
    4: "F4 Tall open / regeneration mosaic forest",
    5: "F5 Tall dense / multilayer forest",
    6: "Open woody succession / young woodland",
    7: "Sparse taller tree cover / orchards",
    8: "Dense shrubland / dwarf pine / reedbed",
    9: "Structured perennial crops",
    10: "Grassland / low open vegetation",
    11: "Arable land / field crops",
    12: "Bare Ground",
    13: "Urban and Built-up LO",
    14: "Urban and Built-up HI",
}
# Stands, area in ha, area share in % and mean stock per ha of forest classes 1 to 5 in an earlier national run; None is not known.
FOREST_PRIOR = {
    1: (25345, 32195.13, 2.7343508180, 8.63711375),
    2: (43912, 121858.70, 10.3495291377, 121.33334756),
    3: (80695, 188773.73, 16.0326609349, 245.07961992),
    4: (None, 433463.13, 36.8142717266, None),
    5: (95238, 401141.62, 34.0691873828, 418.99693181),
}
STALE = "RF_CALIBRATION_PENDING_*.txt"


def write_text(path: str, text: str, encoding: str = "utf-8") -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    temp = f"{path}.{uuid.uuid4().hex}.part"
    with open(temp, "w", encoding=encoding, newline="") as f:
        f.write(text)
    os.replace(temp, path)


def write_report(rows: list[dict], path: str, columns: list[str] | None = None) -> bool:
    """A semicolon CSV with a byte-order mark: the columns given, or all keys in the order seen; no rows, no file. For reports of one row a tile."""
    if not rows:
        return False
    columns = columns or list(dict.fromkeys(k for r in rows for k in r))
    out = io.StringIO()
    writer = csv.DictWriter(out, columns, restval="", delimiter=";", extrasaction="ignore", lineterminator="\n")
    writer.writeheader()
    writer.writerows({k: "" if v is None else v for k, v in r.items()} for r in rows)
    write_text(path, out.getvalue(), "utf-8-sig")
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """The distributed form, without a byte-order mark."""
    df.write.mode("overwrite").option("sep", ";").option("header", True).csv(path)


def rf_lines(spark: SparkSession) -> DataFrame:
    """``cls, line``: height and density of every class, whole numbers without decimals."""
    return dims.rf_profile(spark).select("cls", F.concat_ws(",", rf_number(F.col("height")), rf_number(F.col("density"))).alias("line")).orderBy("cls")


def write_rf_profile(spark: SparkSession, path: str) -> None:
    write_text(path, "".join(f"{r.line}\n" for r in rf_lines(spark).collect()))  # 15 rows


def write_documentation(spark: SparkSession, folder: str, config: dict, thresholds: dict[int, float] = dims.CLASS_THRESHOLDS) -> None:
    """The classes with their names, RF values and least shares, the forest prior and the options of a build; stale notes of earlier ones go."""
    share = lambda c: {"min_area_fraction": thresholds.get(c), "min_area_pct": None if c not in thresholds else 100.0 * thresholds[c]}
    rows = [{"class": f"{c:02d}", "name": CLASS_NAMES[c], "height_m": h, "density_pct": d} | share(c) for c, (h, d) in dims.RF_PROFILE.items()]
    write_report(rows, f"{folder}/class_definitions.csv")
    write_report([{"class": c, "stands": n, "area_ha": a, "area_pct": p, "lzha_mean": m} for c, (n, a, p, m) in FOREST_PRIOR.items()], f"{folder}/forest_prior.csv")
    for x in glob.glob(f"{glob.escape(folder)}/{STALE}"):
        os.remove(x)
    write_text(f"{folder}/metadata.json", json.dumps(config, indent=1, sort_keys=True, default=str))
