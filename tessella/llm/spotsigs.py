"""SpotSigs: chains of content words that follow common-word anchors form a document's signature set.

A spot is an anchor and the next ``CHAIN`` content words, whatever anchors stand between them. The fingerprint is the set of spots as
sorted 32-bit hashes in hex; the likeness of two sets is Jaccard's. ``similar`` finds all pairs of like sets in a corpus: sets are partitioned by their length, in steps
of the least similarity, so that likes lie in the same or neighbouring partitions, and compared by pruned Jaccard.

``neighbours`` finds each document's next one, in descending doc_id order, without sorting the corpus in one task: rows are dealt into
ranges between quantiles of doc_id that occur, and the row on a border goes to both sides.

Edge cases: null text counts as empty. A text without spots has one signature of its own words, an empty one that of no words.
Rows of equal doc_id follow each other by text; a null doc_id comes last. The only document is its own next one. Extra columns are ignored.
"""

from __future__ import annotations

import math

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession, Window

from .batches import renamed
from .store import written

CHAIN = 2
LEAST = 0.8
# Anchors, common words of English, French, Spanish and German.
ANCHORS = (
    "the of and to in is was for on that with as by at from this be it an are or a "
    "le la les de des du et un une dans pour que qui sur par avec est "
    "el los las y en se por con para una su no lo "
    "der die das und von zu mit den im ist ein eine auf dem nicht sich"
).split()


def alternatives(words: tuple[str, ...]) -> str:
    """A regular expression of words with their common beginnings shared."""
    by: dict[str, list[str]] = {}
    for x in sorted(set(words)):
        by.setdefault(x[:1], []).append(x[1:])
    end = "" in by
    parts = [k + alternatives(tuple(v)) for k, v in by.items() if k]
    return parts[0] if len(parts) == 1 and not end else f"(?:{'|'.join(parts)}){'?+' if end else ''}" if parts else ""


def spots(text: Column, chain: int = CHAIN) -> Column:
    """The sorted signature set of a text, as array<int>.

    Anchors get a mark; then every run of anchors with ``chain`` content words behind it becomes a line of its anchors and these words. All repetitions
    in the expressions are possessive, and a line begins where the last one ended: no recursion, and time in proportion to the text.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    tagged = F.regexp_replace(F.concat(F.lit(" "), words, F.lit(" ")), f"(?<= ){alternatives(tuple(ANCHORS))}(?= )", "¶$0")
    then = r"([^ ]+) " + r"(?:¶[^ ]+ )*+([^ ]+) " * (chain - 1)
    lines = F.regexp_replace(F.ltrim(tagged), rf"\G(?:[^ ¶][^ ]*+ )*+((?:¶[^ ]++ )++)(?={then})", "$1|" + " ".join(f"${k + 2}" for k in range(chain)) + "\n")
    runs = F.filter(F.split(lines, "\n"), lambda x: x.contains("|"))

    def run(x: Column) -> Column:
        behind = F.substring_index(x, "|", -1)
        return F.transform(F.split(F.substring_index(x, " |", 1), " "), lambda y: F.hash(F.concat_ws(" ", F.ltrim(y, F.lit("¶")), behind)))

    def signed(x: Column) -> Column:
        return F.when(F.size(x) > 0, x).otherwise(F.array(F.hash(words)))

    # arrays of one, so that what is found is found once
    found = F.array_sort(F.array_distinct(F.flatten(F.transform(runs, run))))
    return F.element_at(F.transform(F.array(found), signed), 1)


def fingerprint(sigs: Column) -> Column:
    return F.array_join(F.transform(sigs, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def length_partition(sigs: Column, least: float = LEAST) -> Column:
    """Sets at least ``least`` alike differ by one partition at most."""
    return F.floor(F.log(F.size(sigs).cast("double")) / F.lit(-math.log(least)) + 1e-9).cast("int")


def members(docs: DataFrame) -> DataFrame:
    """A written table ``doc_id, rep, sigs``: each document's signature set, and the least doc_id that has an equal one; rows without doc_id are left out."""
    own = renamed(docs, "doc_id", "text").where("doc_id is not null").select("doc_id", spots(F.col("text")).alias("sigs"))
    keys = [F.xxhash64("sigs").alias("k1"), F.hash("sigs").alias("k2")]
    table = written(own.select("*", *keys), "spot-sets")
    reps = table.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    return written(table.join(written(reps, "spot-classes"), ["k1", "k2"]).select("doc_id", "rep", "sigs"), "spot-members")


def similar(table: DataFrame, least: float = LEAST) -> DataFrame:
    """``a, b, likeness`` of all pairs of representatives in a table of ``members`` that are at least ``least`` alike, ``a`` the one with the smaller set.

    Sets meet within a partition of length and between neighbouring ones, over spots that a pair must share: of each set, its rarest first, as many as
    it may lack and one more. Lengths and what remains behind a shared spot rule out most pairs before their sets are compared. Adaptive
    execution splits a spot that many sets have.
    """
    sets = table.where("doc_id = rep").dropDuplicates(["rep"]).select("rep", "sigs", F.size("sigs").alias("n"), length_partition(F.col("sigs"), least).alias("part"))
    sets = written(sets, "spot-reps")
    each = sets.select("rep", "n", "part", F.explode("sigs").alias("spot"))
    often = written(each.groupBy("spot").agg(F.count(F.lit(1)).alias("often")).where("often > 1"), "spot-counts")
    # spots of one set alone come first in its order, and meet nobody
    own = Window.partitionBy("rep")
    at = F.col("n") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("often", "spot"))
    index = each.join(often, "spot").select("rep", "n", "part", "spot", at.alias("at")).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
    index = written(index, "spot-index")
    small = index.select("spot", F.explode(F.array("part", F.col("part") + 1)).alias("part"), F.col("rep").alias("a"), F.col("n").alias("na"), F.col("at").alias("ata"))
    large = index.select("spot", "part", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("at").alias("atb"))
    most = F.least("ata", "atb") + F.least(F.col("na") - F.col("ata"), F.col("nb") - F.col("atb"))
    pairs = small.join(large, ["spot", "part"]).where((F.col("na") < F.col("nb")) | (F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # what lies before and behind a shared spot bounds what the two have in common
    pairs = pairs.where((F.col("na") >= F.col("nb") * least - 1e-9) & (most >= (F.col("na") + F.col("nb")) * (least / (1 + least)) - 1e-9))
    found = pairs.select("a", "b").distinct()
    found = found.join(sets.select(F.col("rep").alias("a"), F.col("sigs").alias("x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("sigs").alias("y")), "b")
    return found.select("a", "b", likeness(F.col("x"), F.col("y")).alias("likeness")).where(F.col("likeness") >= least - 1e-12)


def ranges(column: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are below the value, by two short searches."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    every = F.lit(bounds)
    coarse = F.size(F.filter(F.lit(bounds[step - 1 :: step]), lambda b: b < column)) * step
    return F.when(column.isNull(), F.lit(0)).otherwise(coarse + F.size(F.filter(F.slice(every, coarse + 1, F.lit(step)), lambda b: b < column)))


def neighbours(docs: DataFrame, columns: list[str], n_ranges: int | None = None) -> DataFrame:
    """``docs (doc_id, text, ...)`` with ``next_<c>`` for each of ``columns``: the next document's, by descending doc_id, after the last the first's."""
    n = n_ranges or 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("q"), F.max("doc_id").alias("top")).first()
    bounds = sorted({int(x) for x in found.q or [] if x is not None})
    own = ranges(F.col("doc_id"), bounds)
    # (range, kind): 0 the row itself, 1 as the first of the range below, 2 as the one after the last
    places = [F.struct(own.alias("range"), F.lit(0).alias("kind"))]
    if bounds:
        places.append(F.when(F.col("doc_id").isin(bounds) if len(bounds) < 50 else F.array_contains(F.lit(bounds), F.col("doc_id")), F.struct((own + 1).alias("range"), F.lit(1).alias("kind"))))
    wrap = F.col("doc_id").eqNullSafe(F.lit(found.top))
    places.append(F.when(wrap, F.struct(F.lit(0).alias("range"), F.lit(2).alias("kind"))))
    dealt = docs.withColumn("place", F.explode(F.filter(F.array(*places), lambda x: x.isNotNull())))
    dealt = dealt.select("*", F.col("place.range").alias("range"), F.col("place.kind").alias("kind")).drop("place")
    order = Window.partitionBy("range").orderBy(F.when(F.col("kind") == 2, 1).otherwise(0), F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where("kind = 0").drop("range", "kind")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likenesses."""
    docs = renamed(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = neighbours(docs.withColumn("sigs", spots(F.col("text"))), ["text", "sigs"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "sigs", "next_sigs", edited.alias("edited")).select("*", spots(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"), length_partition(F.col("sigs")).alias("length_partition"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
