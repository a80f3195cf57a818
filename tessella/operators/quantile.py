"""Weighted lower quantiles: no interpolation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import safe_double, safe_ratio


def weighted_quantiles(df: DataFrame, value: str, weight: str, qs: list[float], buckets: int = 4096) -> DataFrame:
    """``q, value``: the first value at which the running weight reaches q times the whole.

    Rows of equal value are summed first. Then values are dealt over at most ``buckets`` ranges between approximate quantiles, whose sums
    (that many rows) are run through in one task; only ranges in which a quantile falls are sorted. Without rows the values are NaN.
    """
    v, w = safe_double(F.col(value)), safe_double(F.col(weight))
    rows = df.select(v.alias("v"), w.alias("w")).where("v is not null and w > 0").groupBy("v").agg(F.sum("w").alias("w"))
    n = min(buckets, max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    bounds = rows.agg(F.percentile_approx("v", [i / n for i in range(1, n)], 100 * n).alias("b"))
    spread = rows.crossJoin(F.broadcast(bounds)).select("v", "w", F.size(F.filter("b", lambda b: b < F.col("v"))).alias("bucket"))  # one row of bounds
    sums = spread.groupBy("bucket").agg(F.sum("w").alias("bw"))
    along = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select("bucket", F.sum("bw").over(along).alias("upto"), "bw", F.sum("bw").over(Window.partitionBy()).alias("total"))
    want = sums.select("*", F.explode(F.array(*[F.lit(float(q)) for q in qs])).alias("q")).where((F.col("upto") >= F.col("q") * F.col("total")))
    first = want.groupBy("q").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("bw")).alias("before"), "total"), "bucket").alias("x")).select("q", "x.*")
    inside = spread.join(F.broadcast(first), "bucket")  # one row a q
    run = F.sum("w").over(Window.partitionBy("q").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    hits = inside.withColumn("run", run + F.col("before"))
    last = hits.groupBy("q").agg(F.min(F.when(F.col("run") >= F.col("q") * F.col("total"), F.col("v"))).alias("a"), F.max("v").alias("b")).select("q", F.coalesce("a", "b").alias("value"))
    asked = df.sparkSession.createDataFrame([(float(q),) for q in qs], "q double")
    return asked.join(last, "q", "left").select("q", F.coalesce("value", F.lit(float("nan"))).alias("value"))


def stock_p70(stands: DataFrame, stock: str = "lzsku", area: str = "povrsina", q: float = 0.7) -> float:
    """The area-weighted quantile of stock by area, over stands with area > 0 and stock >= 0."""
    a, s = safe_double(F.col(area)), safe_double(F.col(stock))
    rows = stands.select(a.alias("area"), s.alias("stock")).where("area > 0 and stock >= 0").select(safe_ratio(F.col("stock"), F.col("area")).alias("ratio"), "area")
    value = weighted_quantiles(rows, "ratio", "area", [q]).first().value
    if value != value:
        raise ValueError("no stand has an area above 0 and a stock")
    return value
