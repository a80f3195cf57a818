"""Neighbour counts and the iterative fill of legacy built-up cells."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: list[str] = []
MOST_ROUNDS = 1000
LEGACY_URBAN = (13, 14)
FILL_CLASSES = (1, 12)
LAST_RESORT = 10


def spread8(cells: DataFrame, keep: list[str]) -> DataFrame:
    """Each cell at its eight neighbours' places."""
    offsets = F.array(*[F.struct(F.lit(i).alias("dr"), F.lit(j).alias("dc")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    return cells.select("tile", "r", "c", *keep, F.explode(offsets).alias("o")).select("tile", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"), *keep)


def neighbour_count(cells: DataFrame) -> DataFrame:
    """``tile, r, c, n``: how many of the eight neighbours are in ``cells``; places without any are left out."""
    return spread8(cells, []).groupBy("tile", "r", "c").agg(F.count(F.lit(1)).alias("n"))


def best_neighbour(todo: DataFrame, donors: DataFrame) -> DataFrame:
    """``tile, r, c, cls`` of the cells in ``todo`` that have a donor: the most frequent class, of equals the lowest."""
    near = spread8(donors.where(F.col("cls").between(*FILL_CLASSES)), ["cls"]).join(todo.select("tile", "r", "c"), ["tile", "r", "c"], "left_semi")
    counts = near.groupBy("tile", "r", "c", "cls").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("tile", "r", "c").agg(F.max_by("cls", F.struct(F.col("n"), -F.col("cls"))).alias("cls"))


def _place(spark: SparkSession, name: str) -> str:
    """A new folder's name where all executors can read: in the session's checkpoint folder, or, in local mode only, in a temporary one of this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="tessella-"))
            atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
        root = f"file://{_LOCAL[0]}"
    return f"{root.rstrip('/')}/tessella-{name}-{uuid.uuid4().hex[:12]}"


def _settled(df: DataFrame) -> DataFrame:
    """A written table; cuts the lineage so that lost executors do no harm."""
    path = _place(df.sparkSession, "fill")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fill_legacy_urban(cells: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``cells (tile, r, c, cls, inside)`` without classes 13 and 14 inside the mask.

    Rounds are synchronous: each fills every target with a filled or natural neighbour. Targets that no round can fill become class 10, once nothing is
    filled anywhere in their tile. Only cells next to targets take part in a round.
    """
    target = F.col("inside") & F.col("cls").isin(*LEGACY_URBAN)
    base = _settled(cells.select("tile", "r", "c", "cls", "inside"))
    todo = _settled(base.where(target).select("tile", "r", "c"))
    donors = base.where(~target & F.col("cls").between(*FILL_CLASSES)).select("tile", "r", "c", "cls")
    # only donors that touch a target can ever count
    donors = _settled(donors.join(spread8(todo, []).distinct(), ["tile", "r", "c"], "left_semi"))
    new, rounds = _place(cells.sparkSession, "filled"), 0  # one table, to which every round adds
    for _ in range(most_rounds):
        if not todo.limit(1).count():
            break
        got = _settled(best_neighbour(todo, donors))
        if not got.limit(1).count():
            todo.select("tile", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.lit(LAST_RESORT).alias("new")).write.mode("append").parquet(new)
            rounds += 1
            break
        # A tile where a round fills nothing is through: its targets can't be reached any more.
        stuck = todo.join(got.select("tile").distinct(), "tile", "left_anti").withColumn("cls", F.lit(LAST_RESORT))
        got.unionByName(stuck).select("tile", F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"), F.col("cls").cast("int").alias("new")).write.mode("append").parquet(new)
        rounds += 1
        todo = _settled(todo.join(got, ["tile", "r", "c"], "left_anti").join(got.select("tile").distinct(), "tile", "left_semi"))
        donors = got  # a target that is left has had no donor so far: only cells just filled can be its
    else:
        raise RuntimeError(f"the fill didn't end within {most_rounds} rounds")
    if not rounds:
        return base
    made = cells.sparkSession.read.schema("tile string, r int, c int, new int").parquet(new)
    joined = base.join(made, ["tile", "r", "c"], "left")
    return joined.select("tile", "r", "c", F.coalesce("new", "cls").alias("cls"), "inside")
