"""Counters, statistics and quality gates, each one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import dims
from ..functions.scalar import percent


class GateError(RuntimeError):
    """A quality gate doesn't hold."""


def tile_counters(cells: DataFrame, thresholds: dict[int, float] = dims.CLASS_THRESHOLDS) -> DataFrame:
    """Per tile, from ``cells (tile, inside, cls, dominant, source, water, bare)``: counts and means over cells inside the mask; zeros if there are none."""
    i = F.col("inside")
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    mean = lambda k: F.coalesce(F.avg(F.when(i, F.col(k))) * 100, F.lit(0.0))
    has = F.col("cls") != dims.NODATA
    share = lambda k, c, ok: i & (F.col(k) > 0) & ((F.col(k) >= thresholds[c]) if ok else (F.col(k) < thresholds[c]))
    return cells.groupBy("tile").agg(
        count(i).alias("mask_cells"), count(i & has).alias("classified"), count(i & ~has & (F.col("source") > 0)).alias("low_support"), count(i & ~has).alias("fallback"),
        count(share("water", 0, True)).alias("water_eligible"), count(share("water", 0, False)).alias("water_rejected"),
        count(share("bare", 12, True)).alias("bare_eligible"), count(share("bare", 12, False)).alias("bare_rejected"),
        mean("dominant").alias("mean_dominant_pct"), mean("source").alias("mean_source_pct"),
    )


def qa_status(inside: Column, natural: Column, dominant: Column, urban: Column) -> Column:
    """0 to 100: share of the natural class; 253 fallback; 254 urban; 255 outside."""
    return F.when(~inside, dims.QA_OUTSIDE).when(urban, dims.QA_URBAN).when(natural == dims.NODATA, dims.QA_FALLBACK).otherwise(percent(dominant))


def status_name(code: Column) -> Column:
    return F.when(code == dims.QA_OUTSIDE, "outside").when(code == dims.QA_URBAN, "urban").when(code == dims.QA_FALLBACK, "fallback").otherwise("natural")


def class_histogram(cells: DataFrame, classes=range(15), keep: Column | None = None) -> DataFrame:
    """Per tile, columns ``n00`` to ``n14``; a pivot by conditional counts, so its columns don't depend on the data."""
    keep = F.lit(True) if keep is None else keep
    return cells.groupBy("tile").agg(*[F.count_if(keep & (F.col("cls") == c)).alias(f"n{c:02d}") for c in classes])


def difference_statistics(df: DataFrame, diff: str, by: list[str] | None = None) -> DataFrame:
    """Bias, errors and shares of a difference; ``NO_VALID_OVERLAP`` without rows."""
    d = F.col(diff).cast("double")
    d = F.when(~F.isnan(d), d)
    a = F.abs(d)
    share = lambda cond: (F.avg(cond.cast("double")) * 100)
    q = lambda p: F.percentile(a, p)
    return df.groupBy(*(by or [])).agg(
        F.count(d).alias("samples"), F.when(F.count(d) > 0, "OK").otherwise("NO_VALID_OVERLAP").alias("status"), F.avg(d).alias("bias_m"), F.avg(a).alias("mae_m"), F.sqrt(F.avg(d * d)).alias("rmse_m"),
        q(0.5).alias("median_abs_m"), q(0.9).alias("p90_abs_m"), q(0.95).alias("p95_abs_m"), q(0.99).alias("p99_abs_m"), F.max(a).alias("max_abs_m"),
        share(a <= 1).alias("within_1m_pct"), share(a <= 2).alias("within_2m_pct"), share(a <= 5).alias("within_5m_pct"), share(a > 10).alias("over_10m_pct"),
    )


def mismatches(a: DataFrame, b: DataFrame, keys: list[str], value: str, by: list[str]) -> DataFrame:
    """Per ``by``: compared places, unequal ones and the largest difference; null equals null only."""
    x = a.select(*keys, F.col(value).cast("int").alias("x")).join(b.select(*keys, F.col(value).cast("int").alias("y")), keys)
    return x.groupBy(*by).agg(F.count(F.lit(1)).alias("compared"), F.count_if(~F.col("x").eqNullSafe(F.col("y"))).alias("mismatches"), F.coalesce(F.max(F.abs(F.col("x") - F.col("y"))), F.lit(0)).alias("max_abs"))


def seams(pieces: DataFrame) -> DataFrame:
    """``tile, row, col, side, gap`` between each piece and its right and lower neighbour."""
    a, b = pieces.alias("a"), pieces.alias("b")
    same = F.col("a.tile") == F.col("b.tile")
    right = a.join(b, same & (F.col("a.row") == F.col("b.row")) & (F.col("b.col") == F.col("a.col") + 1)).select("a.tile", "a.row", "a.col", F.lit("right").alias("side"), F.abs(F.col("b.west") - F.col("a.east")).alias("gap"))
    below = a.join(b, same & (F.col("a.col") == F.col("b.col")) & (F.col("b.row") == F.col("a.row") + 1)).select("a.tile", "a.row", "a.col", F.lit("below").alias("side"), F.abs(F.col("b.north") - F.col("a.south")).alias("gap"))
    return right.unionByName(below)


def _hold(df: DataFrame, **bad: Column) -> None:
    """Raises with the names of the conditions that a row meets, and how many do."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(True))).alias(k) for k, c in bad.items()]).first()
    if found := {k: v for k, v in row.asDict().items() if v}:
        raise GateError(", ".join(f"{k}: {v}" for k, v in found.items()))


def gate_no_legacy_urban(cells: DataFrame) -> None:
    _hold(cells, legacy_urban_inside=F.col("inside") & F.col("cls").isin(13, 14))


def gate_outside_unchanged(cells: DataFrame) -> None:
    """``cells (inside, cls, original)``."""
    _hold(cells, changed_outside=~F.col("inside") & (F.col("cls") != F.col("original")))


def gate_class_range(cells: DataFrame, most: int = 14) -> None:
    _hold(cells, class_out_of_range=F.col("inside") & ~F.col("cls").between(0, most))


def gate_status_partition(cells: DataFrame) -> None:
    """Natural, fallback and urban cells are the mask's cells (``cells (inside, status)``)."""
    s = F.col("status")
    _hold(cells, no_status_inside=F.col("inside") & ~(s.between(0, 100) | s.isin(dims.QA_FALLBACK, dims.QA_URBAN)), status_outside=~F.col("inside") & (s != dims.QA_OUTSIDE))


def gate_water_kept(cells: DataFrame) -> None:
    """``cells (natural, cls)``: no urban class where water was."""
    _hold(cells, urban_over_water=(F.col("natural") == 0) & F.col("cls").isin(13, 14))


def gate_forest_structure(histogram: DataFrame) -> None:
    """A large tile with much generic forest and no other forest class means that the stands are missing."""
    total = sum((F.col(f"n{c:02d}") for c in range(1, 15)), F.col("n00"))
    _hold(histogram, forest_collapsed=(total > 100_000) & (F.col("n03") > 10_000) & (F.col("n01") + F.col("n02") + F.col("n04") + F.col("n05") == 0))


def gate_file_size(files: DataFrame, size: int) -> None:
    """``files (path, length)``."""
    _hold(files, wrong_size=F.col("length") != size)


def gate_geotransform(rasters: DataFrame, tolerance: float, pixels: int | None = None, dtype: str | None = None, nodata: float | None = None, srid: int = 4326) -> None:
    """``rasters`` with their found and expected geotransform as arrays ``gt`` and ``want``, and size, type, no-data value and SRID."""
    off = F.exists(F.arrays_zip("gt", "want"), lambda x: F.abs(x["gt"] - x["want"]) > tolerance) | (F.size("gt") != F.size("want"))
    bad = {"geotransform": off, "srid": F.col("srid") != srid}
    if pixels is not None:
        bad["size"] = (F.col("width") != pixels) | (F.col("height") != pixels)
    if dtype is not None:
        bad["dtype"] = F.col("dtype") != dtype
    if nodata is not None:
        bad["nodata"] = ~F.col("nodata").eqNullSafe(F.lit(nodata))
    _hold(rasters, **bad)


def gate_seams(pieces: DataFrame, tolerance: float = 1e-12) -> None:
    _hold(seams(pieces), open_seam=F.col("gap") >= tolerance)


def gate_lossless(counts: DataFrame) -> None:
    _hold(counts, mismatches=F.col("mismatches") > 0)


def gate_checkpoint(manifest: DataFrame, fingerprint: str) -> None:
    """Everything completed was made with these options."""
    _hold(manifest, other_options=F.col("fingerprint") != fingerprint)


def gate_storage(manifest: DataFrame, stored: DataFrame) -> None:
    """``tile``s with a checkpoint have a raster, and the other way round."""
    both = manifest.select("tile").distinct().withColumn("m", F.lit(1)).join(stored.select("tile").distinct().withColumn("s", F.lit(1)), "tile", "full")
    _hold(both, no_raster=F.col("s").isNull(), no_checkpoint=F.col("m").isNull())


def gate_parts(parts: DataFrame, merged: DataFrame) -> None:
    """No empty part (``parts (part, n)``), and as many merged rows as the parts have."""
    row = parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") == 0).alias("empty")).first()
    if row.empty or row.n != merged.count():
        raise GateError(f"{row.empty} empty parts, {row.n} rows in all")


def gate_square(files: DataFrame) -> None:
    """Lengths are squares of 2 at least."""
    side = F.floor(F.sqrt(F.col("length") + 0.5))
    _hold(files, not_square=(side * side != F.col("length")) | (side < 2))


def gate_fields(df: DataFrame, required: list[str]) -> None:
    """The fields are there, in any case, and there is a row."""
    missing = {x.lower() for x in required} - {x.lower() for x in df.columns}
    if missing:
        raise GateError(f"missing fields: {', '.join(sorted(missing))}")
    if not df.limit(1).count():
        raise GateError("no rows")
