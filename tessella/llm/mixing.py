"""Mixing sources to target weights by entropy balancing.

Each source's documents get rates r(t) = min(2, exp(lambda * t / t_max)) by their size t: those closest to one copy each, in
relative entropy, whose expected words meet the source's target. Every lambda solves a convex dual of one unknown; Newton
steps, kept within a bracket, run for all sources at once over the histogram (source, size), one distributed
aggregate a step. Sums are of integers, so that neither the order of tasks nor a lost executor changes a digit.

Rates become copies by systematic rounding along the sizes: the running sum of rates, rounded, says how many copies the documents
of one size get together, and ranks by hash within that size (dealt over salts of about ``SALT_ROWS`` documents) which ones. The words so taken
differ from the target by one document's size at most; one document a source gives or leaves part of a copy for the rest.

Edge cases: null text counts as empty, size 0. A null source is a source, the last. Sources without words have the target 0. Repeated
rows are documents of their own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math

import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from .batches import numbered, place, renamed
from .store import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SALT_ROWS = 2048
BROADCAST_ROWS = 300_000
STEPS = 60
WORDS = r"[^\x20\x09-\x0D]+"
#: Words are summed as integers of this many parts.
PARTS = 10**6


def sized(docs: DataFrame) -> DataFrame:
    """A written table ``doc_id, source, size, tag``; the tag is a hash of source and text."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long")
    return written(renamed(docs, "doc_id", "source", "text").select("doc_id", "source", size.alias("size"), F.xxhash64("source", "text").alias("tag")), "sizes")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """A written table ``source, source_size, largest, target``. Weights go by code point of the source, null last."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.max("size").alias("largest"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # of sources, not documents
    sources = written(sources.withColumn("w", F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))), "sources")
    total = sources.agg(F.sum("source_size").alias("n")).first().n or 0
    level, cap = 0.0, F.col("source_size") * most
    while total:  # the level only rises: as often as sources reach their limit, at most
        x = sources.agg(F.sum(F.when(cap < level * F.col("w"), cap)).alias("full"), F.sum(F.when(cap >= level * F.col("w"), F.col("w"))).alias("w")).first()
        new = (total * share - (x.full or 0)) / x.w if x.w else level
        if new <= level:
            break
        level = new
    return sources.select("source", "source_size", "largest", F.least(cap.cast("double"), F.lit(level) * F.col("w")).alias("target"))


def tilts(sizes: DataFrame, goals: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """A written table ``source, size, n, rate`` of the histogram's cells."""
    cells = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")).alias("h").join(goals.alias("g"), F.col("h.source").eqNullSafe(F.col("g.source")))
    u = F.when(F.col("largest") > 0, F.col("size") / F.col("largest")).otherwise(F.lit(0.0))
    cells = written(cells.select("h.source", "size", "n", "target", u.alias("u"), (F.col("target") >= most * F.col("source_size")).alias("full")), "cells")
    state = written(goals.where(F.col("target") < most * F.col("source_size")).select("source", "target", F.lit(0.0).alias("x"), F.lit(-1e6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(False).alias("done")), "tilt")
    raw = F.exp(F.least(F.col("x") * F.col("u"), F.lit(1.0 + math.log(most))))
    whole = lambda c: F.round(c * PARTS).cast("decimal(38,0)")
    for _ in range(steps):
        at = cells.alias("c").where(~F.col("full")).join(state.select("source", "x").alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select("c.source", "x", "u", "n", "size")
        words = F.col("n") * F.col("size")
        sums = at.groupBy("source").agg(F.sum(whole(words * F.least(raw, F.lit(float(most))))).alias("f"), F.sum(whole(F.when(raw < most, words * F.col("u") * raw).otherwise(0.0))).alias("d"))
        s = state.alias("s").join(sums.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left").select("s.*", (F.coalesce("f", F.lit(0)).cast("double") / PARTS - F.col("target")).alias("over"), (F.coalesce("d", F.lit(0)).cast("double") / PARTS).alias("d"))
        s = s.withColumn("lo", F.when(F.col("over") < 0, F.col("x")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("over") > 0, F.col("x")).otherwise(F.col("hi")))
        newton = F.when(F.col("d") > 0, F.col("x") - F.col("over") / F.when(F.col("d") > 0, F.col("d")))
        middle = F.when(F.col("hi") == 1e6, F.greatest(F.col("lo") * 2, F.lit(1.0))).when(F.col("lo") == -1e6, F.least(F.col("hi") * 2, F.lit(-1.0))).otherwise((F.col("lo") + F.col("hi")) / 2)
        far = (F.col("lo") == -1e6) | (F.col("hi") == 1e6)
        ok = newton.isNotNull() & (newton > F.col("lo")) & (newton < F.col("hi")) & (~far | (F.abs(newton) <= 4 * F.abs(F.col("x")) + 8))
        done = F.abs(F.col("over")) <= F.greatest(F.lit(0.001), F.col("target") * 1e-9)
        state = written(s.select("source", "target", F.when(F.col("done") | done, F.col("x")).when(ok, newton).otherwise(middle).alias("x"), "lo", "hi", (F.col("done") | done).alias("done")), "tilt")
        if not state.where(~F.col("done")).limit(1).count():
            break
    else:
        raise RuntimeError(f"the tilts did not settle within {steps} steps")
    joined = cells.alias("c").join(state.select("source", "x").alias("s"), F.col("c.source").eqNullSafe(F.col("s.source")), "left")
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(raw, F.lit(float(most))))
    return written(joined.select("c.source", "size", "n", F.round(rate, 9).alias("rate")), "rates")


def copies(sizes: DataFrame, cells: DataFrame) -> DataFrame:
    """``doc_id, source, size, tag, rate, salt, rank, copies`` of every document."""
    along = Window.partitionBy("source").orderBy("size")
    ends = F.floor(F.sum(F.col("n") * F.col("rate")).over(along.rowsBetween(Window.unboundedPreceding, 0)) + 0.5)
    cells = cells.withColumn("end", ends)
    cells = cells.select("source", "size", "n", "rate", (F.col("end") - F.coalesce(F.lag("end").over(along), F.lit(0))).alias("all"), F.expr(f"(n + {SALT_ROWS - 1}) div {SALT_ROWS}").alias("salts"))
    deal = F.xxhash64("doc_id", "tag")
    docs = sizes.alias("d").join(cells.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.size") == F.col("c.size")))
    docs = docs.select("doc_id", "d.source", "d.size", "tag", "n", "rate", "all", F.pmod(deal, F.col("salts")).alias("salt"))
    subs = docs.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("all").alias("all"))
    upto = F.sum("m").over(Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0))
    part = lambda c: F.floor(F.col("all").cast("decimal(20,0)") * c.cast("decimal(18,0)") / F.col("n").cast("decimal(18,0)")).cast("long")
    subs = subs.withColumn("upto", upto).select(F.col("source").alias("s2"), F.col("size").alias("z2"), F.col("salt").alias("t2"), "m", (part(F.col("upto")) - part(F.col("upto") - F.col("m"))).alias("share"))
    both = docs.join(subs, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("z2")) & (F.col("salt") == F.col("t2")))
    rank = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy(deal, "doc_id", "tag"))
    both = both.withColumn("rank", rank)
    count = F.expr("share div m").cast("long") + (F.col("rank") <= F.col("share") % F.col("m")).cast("long")
    return both.select("doc_id", "source", "size", "tag", "rate", "salt", "rank", count.alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``doc_id, source, size, tag, source_size, target, rate, copies, taken`` of every document."""
    sizes = sized(docs)
    goals = targets(sizes, weights, share, most)
    counted = written(copies(sizes, tilts(sizes, goals, most)), "copies")
    got = counted.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    missing = goals.alias("g").join(got.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source"))).select(F.col("g.source").alias("of"), "source_size", "target", (F.round("target").cast("long") - F.col("got")).alias("rest"))
    rows = counted.join(missing, F.col("source").eqNullSafe(F.col("of")))
    room = F.when(F.col("rest") > 0, (most - F.col("copies")) * F.col("size") >= F.col("rest")).when(F.col("rest") < 0, F.col("copies") * F.col("size") >= -F.col("rest")).otherwise(False)
    one = rows.where(room).groupBy("source").agg(F.min(F.struct("size", "salt", "rank")).alias("one")).select(F.col("source").alias("of1"), "one")
    rows = rows.join(one, F.col("source").eqNullSafe(F.col("of1")), "left")
    part = F.when(F.col("one") == F.struct("size", "salt", "rank"), F.col("rest")).otherwise(F.lit(0))
    return rows.select("doc_id", "source", "size", "tag", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size") + F.coalesce(part, F.lit(0))).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs``, each row as often as its copies say; rows without copies go. Rows of equal doc_id, source and text share their copies evenly."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    key = place(docs, "doc_id")
    of = mix(docs).groupBy("doc_id", "tag").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__rows")).where("__copies > 0")
    of = written(of.select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), "__copies", "__rows"), "copies-by-id")
    known = of.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("__copies") % F.col("__rows") > 0, 1)).alias("uneven")).first()
    if known.n <= BROADCAST_ROWS:  # else the texts are dealt by their hash
        of = F.broadcast(of)
    tag = F.xxhash64(place(docs, "source"), place(docs, "text"))
    rows = numbered(docs).withColumn("__own", tag)
    rows = rows.join(of, F.col(key).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__tag")))
    even = F.expr("__copies % __rows = 0")
    out = rows.where(even).withColumn("__copies", F.expr("__copies div __rows")) if known.uneven else rows.withColumn("__copies", F.expr("__copies div __rows"))
    if known.uneven:
        rank = F.row_number().over(Window.partitionBy(key, "__own").orderBy("__tag"))
        some = rows.where(~even).withColumn("__rank", rank).withColumn("__copies", F.expr("__copies div __rows + cast(__rank <= __copies % __rows as long)")).drop("__rank")
        out = out.unionByName(some)
    return out.where("__copies > 0").withColumn("__copy", F.explode(F.expr("sequence(1L, __copies)"))).select(*names).toDF(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
