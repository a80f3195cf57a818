"""Scalar column functions: parsing, guards, rounding, quantising, recoding and the forest and urban rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import dims


def safe_double(x: Column) -> Column:
    """Null unless the value is a finite number."""
    d = x.try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < float("inf")), d)


def safe_int(x: Column) -> Column:
    """The number without its fraction; null for blanks, junk and what an int can't hold."""
    d = safe_double(F.trim(x.cast("string")))
    return F.when(F.abs(d) < 2147483648.0, d.cast("int"))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def building_height(h: Column) -> Column:
    """Heights over 0 and under 300 m; 0 for all others."""
    return F.when((h > 0) & (h < 300) & ~F.isnan(h), h).otherwise(F.lit(0.0))


def percent(x: Column) -> Column:
    """0 to 100, halves to even."""
    return F.least(F.greatest(F.rint(x * 100), F.lit(0.0)), F.lit(100.0)).cast("int")


def clip(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def guarded_ratio(num: Column, den: Column, least: float = 1e-6) -> Column:
    return F.when(den > least, num / den).otherwise(F.lit(0.0))


def invalid_elevation(z: Column, valid: Column | None = None, nodata: float = dims.ELEVATION_NODATA) -> Column:
    bad = z.isNull() | F.isnan(z) | (F.abs(z) == float("inf")) | (F.abs(z - F.lit(float(nodata))) <= 1e-5) | (z <= -32767.5)
    return bad if valid is None else bad | (valid == 0)


def quantise_elevation(z: Column, valid: Column | None = None) -> Column:
    """16-bit metres, halves to even, clipped to +-32767; null where there is no data."""
    z = z.cast("double")
    return F.when(~invalid_elevation(z, valid), clip(F.rint(z), -32767.0, 32767.0).cast("smallint"))


def resolution_label(arcsec: Column) -> Column:
    inverse = 1 / arcsec
    whole = F.abs(inverse - F.rint(inverse)) < 1e-10
    return F.when(whole, F.format_string("1over%d", F.rint(inverse).cast("long"))).otherwise(F.translate(F.concat(arcsec.cast("string"), F.lit("arcsec")), ".", "p"))


def recode(mapping: dict, code: Column) -> Column:
    """Class of a code that may come as text or number; null if it isn't listed."""
    return dims.lookup(mapping, safe_int(code))


def hydro_class(symbol: Column, symbols=dims.HYDRO_SYMBOLS) -> Column:
    return F.when(symbol.cast("string").isin(*symbols), F.lit(0))


def legacy_class(cls: Column) -> Column:
    return F.coalesce(dims.lookup(dims.LEGACY_REMAP, cls), cls)


def forest_class(phase: Column, closure: Column, stock: Column, p70: float = dims.FOREST_P70, stock_least: float = dims.FOREST_STOCK) -> Column:
    """Structure class of a stand; unknown phases go by stock, a null stock counts as little."""
    closed = F.coalesce(closure.isin(1, 2), F.lit(False))
    dense = F.coalesce(stock >= p70, F.lit(False))
    out = None
    for p, (a, b) in dims.FOREST_PHASES.items():
        value = F.lit(a) if a == b else F.when(closed, a).otherwise(b)
        out = F.when(phase == p, value) if out is None else out.when(phase == p, value)
    out = out.when((phase == 7) & closed, 5).when(phase == 7, F.when(dense, 5).otherwise(4))
    return out.otherwise(F.when(dense, 5).when(F.coalesce(stock >= stock_least, F.lit(False)), 4).otherwise(2))


def urban_class(base: Column, density: Column, height: Column, inside: Column, rule: dict = dims.URBAN) -> Column:
    """14 for high, 13 for low built-up areas; only inside the mask, never over water. A float32 density is compared with a float32 limit."""
    hi = hi_tall(density, height, rule) | hi_dense(density, height, rule)
    can = inside & (base != 0)
    return F.when(can & hi, 14).when(can & (density >= rule["lo_density"]), 13).otherwise(base)


def hi_tall(density: Column, height: Column, rule: dict = dims.URBAN) -> Column:
    return (density >= rule["tall_density"]) & (height >= rule["tall_height"])


def hi_dense(density: Column, height: Column, rule: dict = dims.URBAN) -> Column:
    return (density >= rule["dense_density"]) & (height >= rule["dense_height"])


def rf_number(x: Column) -> Column:
    """A number without a fraction if it has none."""
    x = x.cast("double")
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def duration(seconds: Column) -> Column:
    """hh:mm:ss of the nearest whole second, halves to even; --:--:-- for what isn't a duration."""
    s = safe_double(seconds)
    n = F.rint(s).cast("long")
    return F.when(s.isNull() | (s < 0), F.lit("--:--:--")).otherwise(F.format_string("%02d:%02d:%02d", F.expr("0L") + F.floor(n / 3600).cast("long"), F.floor(n % 3600 / 60).cast("long"), n % 60))
