"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the presence of its lower-cased words, of their heads (the first 4 to 8 bytes of longer words, for inflected and
compound forms), of word pairs and of pairs with one word between them, hashed to 2^20 coordinates. FTRL-proximal gives every coordinate a rate of its own; its L1 term leaves most weights at exactly zero, so that
the model is a short list of (coordinate, weight), which every task gets.

``MAX_TRAIN`` bounds the labelled rows that the model is fitted on: those with the smallest crc32 of their doc_id. Every
document is scored, by all of its text.

Edge cases: null text counts as empty; its score is that of the bias. Several labels of a document count as their largest. Null
labels and null doc_ids aren't learned from. Without rows to learn from every score is 0. Repeated rows get equal scores.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import pyspark.sql.types as T
from pyspark.sql import DataFrame, SparkSession

from .batches import freed, numbered, place, renamed, slices

BITS = 20
MAX_TRAIN = 12_000
FOLDS = 5
HEADS = (4, 5, 6, 7, 8)
PARAMETERS = {"alpha": 0.3, "beta": 1.0, "l1": 3.0, "l2": 0.1, "epochs": 3}
#: ASCII marks, which part words; everything else but white space belongs to a word.
_PARTS = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def features(text: str | None, bits: int = BITS) -> np.ndarray:
    """Coordinates, with repeats, of a text's words, heads, pairs and skip-pairs."""
    words = (text or "").lower().encode("utf-8", "replace").translate(_PARTS).split()
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]
    skip = one[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + one[2:]
    heads = [np.array([zlib.crc32(x[:k]) for x in words if len(x) > k], np.uint64) + np.uint64(k << 40) for k in HEADS]
    mixed = np.concatenate([one, *heads, two, skip]) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - bits)).astype(np.int32)


def fit(rows: list[tuple[np.ndarray, int]], bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 3.0, l2: float = 0.1, epochs: int = 3) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, weights, bias) after ``epochs`` passes over (distinct coordinates, label) in the order given."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    zb, nb = 0.0, 0.0

    def weights(zi, ni):
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    for _ in range(epochs):
        for at, y in rows:
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            b = -zb / ((beta + nb**0.5) / alpha)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
            g = float(p) - y
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - rate * w
            n[at] = ni + g * g
            zb += g - ((nb + g * g) ** 0.5 - nb**0.5) / alpha * b
            nb += g * g
    used = np.flatnonzero(np.abs(z) > l1)
    return used.astype(np.int32), weights(z[used], n[used]).astype(np.float32), -zb / ((beta + nb**0.5) / alpha)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[bytes, bytes, float] | None:
    """The model, fitted in one executor task on at most ``max_train`` rows; None without rows."""

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("rank"), part.column("doc_id"), part.column("y"), pa.array([np.unique(features(x)).tobytes() for x in part.column("text").to_pylist()], pa.binary())], ["rank", "doc_id", "y", "at"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(at, np.int32), y) for batch in batches for at, y in zip(batch.column("at").to_pylist(), batch.column("y").to_pylist())]
        if rows:
            at, w, bias = fit(rows, **PARAMETERS)
            yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()]), pa.array([w.tobytes()]), pa.array([float(bias)])], ["at", "w", "bias"])

    rank = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = renamed(labels, "doc_id", "toxic").where("doc_id is not null and toxic is not null").where(rank % FOLDS != 0)
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("y")).withColumn("rank", rank).orderBy("rank", "doc_id").limit(max_train)
    rows = renamed(docs, "doc_id", "text").join(F.broadcast(known), "doc_id").select("rank", "doc_id", "y", "text")
    seen = rows.mapInArrow(freed(coordinates), "rank long, doc_id long, y int, at binary")
    got = seen.repartition(1).sortWithinPartitions("rank", "doc_id", "at").mapInArrow(freed(learn), "at binary, w binary, bias double").collect()
    return (bytes(got[0].at), bytes(got[0].w), got[0].bias) if got else None


def score(docs: DataFrame, model: tuple[bytes, bytes, float] | None) -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) as its last column; a column of that name keeps its place and name too."""
    text, rows = place(docs, "text"), numbered(docs)
    kept = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    model_ref = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = model_ref.value
        dense = np.zeros(1 << BITS, np.float32)
        bias = -np.inf
        if got:
            dense[np.frombuffer(got[0], np.int32)] = np.frombuffer(got[1], np.float32)
            bias = got[2]
        used = dense != 0
        for batch in batches:
            for part in slices(batch, text):
                out = []
                for x in part.column(text).to_pylist():
                    at = features(x)
                    at = np.unique(at[used[at]])
                    out.append(float(bias + dense[at].sum(dtype=np.float64)))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(1 / (1 + np.exp(-np.clip(np.array(out, float), -700, 700))) if got else np.zeros(len(out)))], [*kept, "score"])

    return rows.mapInArrow(freed(apply), schema).toDF(*docs.columns, "score")


def toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``docs`` with their score."""
    return score(docs, train(docs, labels, max_train))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = renamed(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
