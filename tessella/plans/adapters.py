"""Grids and polygons made from the ordinary tables, by exact integer arithmetic, so that every operator has an oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims

FACTOR, SIDE = 2, 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subcells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 x 64 sub-samples of a 32 x 32 grid, in three layers by return flag; a tile has 1024 orders' lines."""
    x = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('T', l_orderkey div 1024) AS tile", "cast((l_orderkey * 7 + l_linenumber * 3) % 64 AS int) AS sr", "cast((l_partkey * 5 + l_suppkey) % 64 AS int) AS sc",
        "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS prio", "l_orderkey", "l_linenumber", "l_partkey",
    )
    return x.withColumn("cls", F.expr("cast(if(l_partkey % 4 = 0, l_partkey % 13, ((sr div 8) * 8 + (sc div 8)) % 13) AS int)"))


def stands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS fid", "nullif(o_orderkey % 13, 12) AS phase", "o_custkey % 5 AS closure", "cast(1 + o_orderkey % 97 AS double) AS area", "o_totalprice * 0.01D * (1 + o_orderkey % 97) AS stock"
    )


def legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32 x 32 class grids with their masks, a tile for every 1024 orders."""
    return table(spark, sf_dir, "orders").selectExpr("concat('T', o_orderkey div 1024) AS tile", "cast(o_orderkey % 1024 div 32 AS int) AS r", "cast(o_orderkey % 32 AS int) AS c", "cast(o_custkey % 15 AS int) AS cls", "o_orderstatus <> 'P' AS inside")


def triangle(x0: Column, y0: Column, w: Column, t: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.struct(F.lit(0).alias("ring"), F.array(p(x0, y0), p(x0 + w, y0), p(x0, y0 + t)).alias("pts")))


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles on a 128 x 128 grid of unit cells, with heights."""
    x = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS fid", "cast(p_partkey * 37 % 112 AS double) + 0.25D AS x0", "cast(p_partkey * 53 % 112 AS double) + 0.25D AS y0", "cast(2 + p_size % 9 AS double) AS w", "cast(2 + p_partkey % 7 AS double) AS t", "p_size AS height"
    )
    return x.select("fid", "height", triangle(F.col("x0"), F.col("y0"), F.col("w"), F.col("t")).alias("rings"))


def elevation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 x 25 grids of measured values, a tile for every 1000 events."""
    return table(spark, sf_dir, "events").selectExpr("concat('T', event_id div 1000) AS tile", "cast(event_id % 1000 div 25 AS int) AS r", "cast(event_id % 25 AS int) AS c", "value AS z")


def sample_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places on the tiles of ``elevation``, 1500 a tile."""
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "concat('T', o_orderkey div 1500) AS tile", "o_custkey % 231 * 0.1D + 0.5D AS x", "o_orderkey % 389 * 0.1D + 0.5D AS y")


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each order, at the order's cell of ``legacy``."""
    x = table(spark, sf_dir, "lineitem").selectExpr("concat('T', l_orderkey div 1024) AS tile", "cast(l_orderkey % 1024 div 32 AS int) AS r", "cast(l_orderkey % 32 AS int) AS c")
    return x.groupBy("tile", "r", "c").agg(F.count(F.lit(1)).cast("double").alias("v"))


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts on a 200 x 200 grid."""
    x = table(spark, sf_dir, "lineitem").selectExpr("'T' AS tile", "cast(l_orderkey % 200 AS int) AS r", "cast(l_partkey % 200 AS int) AS c")
    return x.groupBy("tile", "r", "c").agg(F.count(F.lit(1)).cast("double").alias("v"))


def tiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in dims.TILES], "tile string")
