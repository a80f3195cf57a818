"""Site-relative line frequency: a line that more than ``MAX_RATIO`` of a host's pages have is boilerplate, and is dropped.

A page counts a line once, without spaces around it; blank lines are neither counted nor dropped. Lines meet as 96 bits of hash,
counted map-side first, so a host with a third of all pages is no hot group. A host has at most (lines of a mean page) /
``MAX_RATIO`` such lines; they come back to the pages as one array a host, broadcast only if all hosts' together are few.

Edge cases: a null host is a host of its own. Null text stays null, empty text empty. A text may lose all lines; its row
stays. Repeated rows are pages of their own. Other columns, whatever their names, are passed on; an integer ``n_chars`` is brought up to date.
"""

from __future__ import annotations

import pyspark.sql.functions as F
from pyspark.sql import Column, DataFrame, SparkSession

from .batches import numbered, place, renamed
from .store import written

MAX_RATIO = 0.02
MIN_PAGES = 5
BROADCAST_LINES = 200_000


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and path; null where there is none. ``line_dedup(pages.select("page_id", host_of(F.col("url")).alias("host"), F.col("html").alias("text")), "host")``
    cleans web pages by site."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*+://(?:[^/?#@]*+@)?+(\[[^\]/]*+\]|[^/?#:]++)", 1)), F.lit(""))


def _key(line: Column) -> Column:
    return F.struct(F.xxhash64(F.trim(line)).alias("h"), F.hash(F.trim(line)).alias("g"))


def boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``host, bad``: each host's boilerplate lines, as hashes."""
    pages = renamed(docs, host, "text").toDF("host", "text")
    lines = F.array_distinct(F.transform(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), _key))
    counts = pages.select("host", F.explode(lines).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).withColumnRenamed("host", "of")
    return counts.join(totals, F.col("host").eqNullSafe(F.col("of"))).where(F.col("n") > F.lit(max_ratio) * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("bad"))


def line_dedup(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counts: bool = False) -> DataFrame:
    """``docs`` without boilerplate lines; with ``counts``, two more columns ``n_lines`` and ``n_dropped``."""
    bad = written(boilerplate(docs, host, max_ratio, min_pages), "boilerplate").withColumnRenamed("host", "__host").withColumnRenamed("bad", "__bad")
    n = bad.agg(F.coalesce(F.sum(F.size("__bad")), F.lit(0)).alias("n")).first().n
    at = place(docs, "text")
    old = F.col(at)
    joined = numbered(docs).join(F.broadcast(bad) if n <= BROADCAST_LINES else bad, F.col(place(docs, host)).eqNullSafe(F.col("__host")), "left")
    lines = F.split(old, "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("__bad"), _key(x)))
    text = F.when(F.col("__bad").isNull(), old).otherwise(F.array_join(kept, "\n"))
    names = [f"_{i}" for i in range(len(docs.columns))]
    sizes = {p: t for p, (c, t) in zip(names, docs.dtypes) if c == "n_chars" and t in ("bigint", "int")}
    out = [text.alias(p) if p == at else F.length(text).cast(sizes[p]).alias(p) if p in sizes else F.col(p) for p in names]
    if counts:
        all_lines = F.size(F.filter(lines, lambda x: F.trim(x) != ""))
        dropped = F.when(F.col("__bad").isNull(), F.lit(0)).otherwise(F.size(lines) - F.size(kept))
        out += [F.greatest(F.coalesce(all_lines, F.lit(0)), F.lit(0)).cast("long").alias("n_lines"), F.greatest(F.coalesce(dropped, F.lit(0)), F.lit(0)).cast("long").alias("n_dropped")]
    return joined.select(*out).toDF(*docs.columns, *(["n_lines", "n_dropped"] if counts else []))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text"), counts=True)


OP5_SQL = f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents),
c AS (SELECT source, trim(line) AS line, count(DISTINCT doc_id) AS n FROM l WHERE trim(line) <> '' GROUP BY 1, 2),
p AS (SELECT source, count(*) AS pages FROM documents GROUP BY 1),
b AS (SELECT c.source, list(line) AS bad FROM c JOIN p ON c.source IS NOT DISTINCT FROM p.source WHERE n >= {MIN_PAGES} AND n > CAST({MAX_RATIO} AS DOUBLE) * pages GROUP BY 1)
SELECT d.doc_id, d.source,
  CASE WHEN bad IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x: trim(x) = '' OR NOT list_contains(bad, trim(x))), chr(10)) END AS text,
  coalesce(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '')), 0) AS n_lines,
  CASE WHEN bad IS NULL THEN 0 ELSE coalesce(len(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '' AND list_contains(bad, trim(x)))), 0) END AS n_dropped
FROM documents d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
"""
