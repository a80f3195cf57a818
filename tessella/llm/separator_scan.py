"""Token counts by scanning flat token files for their end-of-document identifier.

The files hold ids and nothing else. They are cut into blocks of a fixed size; each block is searched in one
vectorised comparison, and what it knows (how many separators, where each ends) is stitched to its
neighbours by an exclusive prefix scan: counts add up to document numbers, positions run on as a maximum.
The scan has two levels, so that no task sees more than ``SUPER`` blocks or the super-blocks of one file.

Edge cases: null and empty texts have one token, the separator. A file without separators, or with tokens after its
last one, yields a last row with ``terminated`` false. Empty files and empty tables yield no rows.
Repeated documents are counted one by one. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from .batches import freed, partitions, renamed, slices, task_id
from .store import AtomicFile, filesystem, scratch, written
from .tokens import encoder

SEPARATOR = 50256
BLOCK_BYTES = 4 << 20
SUPER = 1024


def write_flat(docs: DataFrame, folder: str, separator: int = SEPARATOR, tokenizer: str | None = None) -> DataFrame:
    """Encodes ``docs (doc_id, text)`` into flat files of little-endian uint16 ids, one file a partition.

    Returns the key table ``file, ordinal, doc_id``: the order of documents in each file. The ids of a text never
    hold the separator, as special tokens' strings are encoded as ordinary text. A vocabulary over 2^16 raises an error.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        name, out, ordinal = f"{folder}/tokens-{task_id():06d}.bin", None, 0
        for batch in batches:
            for part in slices(batch, "text"):
                if out is None:
                    if max(encoder(tokenizer).tokenizer.get_vocab_size(), separator + 1) > 1 << 16:
                        raise ValueError("flat files hold ids below 65536")
                    out = AtomicFile(name)
                ids, offsets = encoder(tokenizer).encode(part.column("text"))
                out.write(np.insert(ids, offsets[1:], separator).astype("<u2").tobytes())
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array(range(ordinal, ordinal + n), pa.int64()), part.column("doc_id").cast(pa.int64())], ["file", "ordinal", "doc_id"])
                ordinal += n
        if out:
            out.commit()

    return written(renamed(docs, "doc_id", "text").mapInArrow(freed(write), "file string, ordinal long, doc_id long"), "flat-keys")


def scan_separators(files: DataFrame, separator: int = SEPARATOR, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents of the flat files in ``files (file, bytes)``: ``file, ordinal, start, n_tokens, terminated``, positions in ids."""
    if block_bytes % width or width not in (1, 2, 4, 8):
        raise ValueError("block_bytes must be a multiple of width, which is 1, 2, 4 or 8")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                source, path = filesystem(row["file"])
                with source.open_input_file(path) as f:
                    f.seek(row["at"])
                    data = np.frombuffer(f.read(min(block_bytes, row["bytes"] - row["at"])), f"<u{width}")
                ends = np.flatnonzero(data == separator) + 1 + row["at"] // width
                yield pa.RecordBatch.from_pylist([{"file": row["file"], "block": row["block"], "n": len(ends), "last": int(ends[-1]) if len(ends) else None, "ends": ends.tolist()}], schema=pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("ends", pa.list_(pa.int64()))]))

    sized = files.where("bytes > 0")
    blocks = sized.select("file", "bytes", F.posexplode(F.expr(f"sequence(0L, bytes - 1, {block_bytes}L)")).alias("block", "at")).withColumn("block", F.col("block").cast("long"))
    found = written(blocks.repartition(partitions(files.sparkSession), "file", "block").mapInArrow(freed(search), "file string, block long, n long, last long, ends array<long>"), "scan-blocks").withColumn("super", F.expr(f"block div {SUPER}"))
    inner = Window.partitionBy("file", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("file").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = found.groupBy("file", "super").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    supers = supers.select("file", "super", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n0"), F.max("last").over(outer).alias("last0"))
    stitched = (
        found.select("file", "super", "block", "n", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("n1"), F.max("last").over(inner).alias("last1"))
        .where("n > 0")
        .join(supers, ["file", "super"])
        .select("file", "block", (F.col("n0") + F.col("n1")).alias("base"), F.coalesce("last1", "last0", F.lit(0)).alias("carry"))
    )
    # the scan sees counts only; the separators' places meet theirs block by block
    whole = found.where("n > 0").select("file", "block", "ends").join(written(stitched, "scan-stitched"), ["file", "block"]).select("file", "base", "carry", "ends", F.posexplode("ends").alias("k", "end")).select(
        "file", (F.col("base") + F.col("k")).alias("ordinal"), F.expr("if(k = 0, carry, ends[k - 1])").alias("start"), "end"
    )
    tails = (
        found.groupBy("file").agg(F.sum("n").alias("ordinal"), F.coalesce(F.max("last"), F.lit(0)).alias("start"))
        .join(sized.select("file", F.expr(f"bytes div {width}").alias("end")), "file").where("end > start")
    )
    return whole.withColumn("terminated", F.lit(True)).unionByName(tails.withColumn("terminated", F.lit(False))).select("file", "ordinal", "start", (F.col("end") - F.col("start")).alias("n_tokens"), "terminated")


def file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``file, bytes`` of the flat files in a folder; only the listing is read. A folder that is missing or empty has none."""
    source, path = filesystem(folder)
    from pyarrow import fs

    if source.get_file_info(path).type != fs.FileType.Directory:
        return spark.createDataFrame([], "file string, bytes long")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    return listed.select(F.concat(F.lit(f"{folder}/"), F.element_at(F.split("path", "/"), -1)).alias("file"), F.col("length").alias("bytes"))


def token_counts(docs: DataFrame, tokenizer: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_tokens`` (the end-of-document id counts) of every document, read back from flat token files."""
    spark = docs.sparkSession
    folder = scratch(spark, "flat")
    keys = write_flat(docs, folder, tokenizer=tokenizer)
    found = scan_separators(file_sizes(spark, folder), block_bytes=block_bytes)
    return keys.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
