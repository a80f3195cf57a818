"""A corpus pipeline: toxic documents go, boilerplate lines go, one document of each near-duplicate group stays, sources are mixed, and what is left is packed.

Each stage takes (spark, docs, sf_dir) and works on all rows of its predecessor's output, which is written as Parquet and read again. All but the
last return the columns of ``documents``; the last returns the pieces that ``pack`` describes. Mixing repeats a document as often as it has
copies, so its doc_id may occur twice from there on.

Edge cases, for every stage: an empty table stays empty. Null and empty texts are scored, kept, mixed with size 0 and packed as their end id alone. Rows with a null doc_id have no near copies
and stay; rows of equal doc_id are scored, cleaned and mixed one by one, and go together if their group's least doc_id is another. A null source is a source. Very long texts are
read whole. Extra columns are passed on up to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.batches import numbered, place
from tessella.llm.jaccard_join import ngram_components
from tessella.llm.line_dedup import line_dedup
from tessella.llm.mixing import mixed
from tessella.llm.packing import pack
from tessella.llm.store import written
from tessella.llm.toxicity import toxicity

#: Word n-grams and least Jaccard similarity of near duplicates.
NEAR_WORDS, NEAR_LEAST = 5, (4, 5)
BROADCAST_IDS = 1_000_000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5."""
    scored = numbered(toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    score = scored.columns[-1]
    return scored.where(F.col(score) < 0.5).drop(score).toDF(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate in their source."""
    return line_dedup(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of near duplicates; documents without words or doc_id stay."""
    found = ngram_components(docs, NEAR_LEAST, NEAR_WORDS)
    gone = written(found.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:  # else the texts are dealt by doc_id
        gone = F.broadcast(gone)
    return numbered(docs).join(gone, F.col(place(docs, "doc_id")) == F.col("__gone"), "left_anti").toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
