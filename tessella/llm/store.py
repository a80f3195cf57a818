"""Shared-folder storage: scratch tables and binary files that every executor can read.

The folder is the one that the session names in ``spark.checkpoint.dir``. Only where that is unset, and
only in local mode (tests), a temporary folder of this machine stands in for it.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .batches import numbered

_LOCAL: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the URI that the session names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="tessella-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return f"file://{_LOCAL[0]}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared root; nothing is created."""
    return f"{shared_root(spark)}/tessella-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage, survives lost executors.

    In the file columns are called by their place, so that names which clash do no harm.
    """
    spark, rows = df.sparkSession, numbered(df)
    path = scratch(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path).toDF(*df.columns)


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a URI; works in executors as in the driver."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{os.path.abspath(uri.removeprefix('file:'))}")


def read_range(source, start: int, length: int) -> bytes:
    """``length`` bytes of an open file from ``start`` on."""
    source.seek(start)
    return source.read(length)


class AtomicFile:
    """Writes under a name of this attempt and renames at the end, so a retried task leaves one whole file."""

    def __init__(self, uri: str):
        self._fs, self._path = filesystem(uri)
        self._fs.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._temp = f"{self._path}.{uuid.uuid4().hex}.part"
        self._out = self._fs.open_output_stream(self._temp)
        self.size = 0

    def write(self, data) -> None:
        self._out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self._out.close()
        self._fs.move(self._temp, self._path)
