"""Resumable ingestion: a plan's chunks that no manifest has yet, processed as micro-batches or in one go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.planning import remaining

MANIFEST = "tile string, row int, col int, fingerprint string"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Completed work; an empty table where there is none yet."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    exists = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(MANIFEST).parquet(path) if exists else spark.createDataFrame([], MANIFEST)


def ingest(plan: DataFrame, path: str, out: str, fingerprint: str, process: Callable[[DataFrame], DataFrame]) -> int:
    """Processes what is left of ``plan (tile, row, col, ...)``, appends the rows to ``out`` and then the chunks to the manifest; returns how many.

    A run that dies in between does its chunks again: readers join ``out`` with the manifest's chunks and keep one copy by key.
    """
    spark = plan.sparkSession
    left = remaining(plan, manifest(spark, path), fingerprint).cache()
    n = left.count()
    if n:
        process(left).write.mode("append").partitionBy("tile").parquet(out)
        left.select("tile", "row", "col", F.lit(fingerprint).alias("fingerprint")).write.mode("append").parquet(path)
    left.unpersist()
    return n


def ingested(spark: SparkSession, path: str, out: str, fingerprint: str, keys: list[str]) -> DataFrame:
    """Rows of completed chunks, each key once."""
    done = manifest(spark, path).where(F.col("fingerprint") == fingerprint).select("tile", "row", "col").distinct()
    return spark.read.parquet(out).join(done, ["tile", "row", "col"], "left_semi").dropDuplicates(keys)


def stream_chunks(spark: SparkSession, folder: str, schema: str, checkpoint: str, sink: Callable[[DataFrame, int], None]):
    """Runs over the plan files that have come into a folder since the last run, and stops; the checkpoint remembers them."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 100).parquet(folder)
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
