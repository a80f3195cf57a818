"""Small helpers for Arrow batch functions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch into runs of rows whose ``column`` has about ``max_bytes``; one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(size) - size) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def freed(function):
    """A batch function that, when its input ends, gives memory back to the system: workers are reused, and an executor's next stage needs the room.

    Called on the driver, it also has the session send batches of ``BATCH_BYTES`` at most, so that long texts don't pile up in a batch.
    """
    from pyspark.sql import SparkSession

    key, session = "spark.sql.execution.arrow.maxBytesPerBatch", SparkSession.getActiveSession()
    if session and not 0 < int(session.conf.get(key).rstrip("b")) <= BATCH_BYTES:
        session.conf.set(key, str(BATCH_BYTES))

    def run(batches):
        yield from function(batches)
        import ctypes

        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # a C library without it
            pass

    return run


def task_id() -> int:
    """The number of the partition that this task makes."""
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def numbered(df):
    """``df`` with its columns named by place: names that clash, in case or altogether, do no harm."""
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def place(df, name: str) -> str:
    """The numbered name of the first column that is called ``name`` exactly."""
    if name not in df.columns:
        raise ValueError(f"a column {name} is needed")
    return f"_{df.columns.index(name)}"


def renamed(df, *columns: str):
    """Only ``columns`` of ``df``, by exact name: other columns stay out of the way, whatever they are called."""
    import pyspark.sql.functions as F

    return numbered(df).select(*[F.col(place(df, c)).alias(c) for c in columns])


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
