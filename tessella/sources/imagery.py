"""Elevation from an image service: one input partition a chunk, retries within the task."""

from __future__ import annotations

import os
import struct
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .rasters import read_geotiff

LEAST_BYTES = 1024
PLACE_TOLERANCE = 2e-10
# The service's names of its resampling kinds.
KINDS = {"bilinear": "RSP_BilinearInterpolation", "nearest": "RSP_NearestNeighbor", "cubic": "RSP_CubicConvolution", "majority": "RSP_Majority"}


def export_url(base: str, chunk: dict, interpolation: str = "bilinear", nodata: int = -32768) -> str:
    """The request for a chunk ``(west, south, east, north, width, height)`` as Float32; ``base`` is the service's address, with or without its operation."""
    # The fields that the public service reads.
    query = {
        "bbox": ",".join(format(chunk[k], ".15f") for k in ("west", "south", "east", "north")), "bboxSR": 4326, "imageSR": 4326, "size": f"{chunk['width']},{chunk['height']}",
        "format": "tiff", "pixelType": "F32", "noData": nodata, "interpolation": KINDS[interpolation], "compression": "LZ77", "adjustAspectRatio": "false", "f": "image",
    }
    return f"{base.rstrip('/').removesuffix('/exportImage')}/exportImage?{urllib.parse.urlencode(query)}"


def decode_chunk(data: bytes, chunk: dict, tolerance: float = PLACE_TOLERANCE) -> np.ndarray:
    """The chunk's float32 cells, NaN where there is no data; raises ValueError unless size, place, SRID and type are the plan's."""
    x = read_geotiff(data)
    step = (chunk["east"] - chunk["west"]) / chunk["width"]
    want = [chunk["west"], step, 0.0, chunk["north"], 0.0, -(chunk["north"] - chunk["south"]) / chunk["height"]]
    bad = []
    if x["data"].shape != (chunk["height"], chunk["width"]):
        bad.append(f"{x['data'].shape} cells")
    if x["srid"] != 4326:
        bad.append(f"SRID {x['srid']}")
    if x["dtype"] != "float32":
        bad.append(x["dtype"])
    if any(abs(a - b) > tolerance for a, b in zip(x["gt"], want)):
        bad.append(f"geotransform {x['gt']}")
    if bad:
        raise ValueError(f"chunk {chunk['row']}, {chunk['col']}: {', '.join(bad)}")
    z = x["data"]
    return z if x["nodata"] is None else np.where(np.abs(z - x["nodata"]) <= 1e-5, np.float32(np.nan), z)


def service_loader(base: str, folder: str, interpolation: str = "bilinear", retries: int = 5, timeout: float = 900, opener: Callable = urllib.request.urlopen) -> Callable[[dict], np.ndarray]:
    """``load(chunk)`` for ``read_chunks``: the service's answer, kept as a file in ``folder``, which all executors share, and used again if it is valid."""

    def load(chunk: dict) -> np.ndarray:
        def valid(path: str) -> bool:
            try:
                with open(path, "rb") as f:
                    decode_chunk(f.read(), chunk)
            except (ValueError, struct.error, zlib.error, KeyError, IndexError):
                return False
            return True

        path = fetch(export_url(base, chunk, interpolation), f"{folder}/{chunk['tile']}-{chunk['row']:02d}-{chunk['col']:02d}.tif", retries, timeout, opener=opener, valid=valid)
        with open(path, "rb") as f:
            return decode_chunk(f.read(), chunk)

    return load


def fetch(url: str, path: str, retries: int = 5, timeout: float = 900, wait: Callable[[float], None] = time.sleep, opener: Callable = urllib.request.urlopen, valid: Callable[[str], bool] | None = None) -> str:
    """The file at ``path``: kept if it is valid already, else fetched under another name, checked the same way, and renamed."""
    if os.path.exists(path) and os.path.getsize(path) >= LEAST_BYTES and (valid is None or valid(path)):
        return path
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    last: Exception | None = None
    for attempt in range(retries):
        temp = f"{path}.{uuid.uuid4().hex}.part"
        try:
            with opener(url, timeout=timeout) as answer:
                data = answer.read()
                said, status = answer.headers.get("Content-Length"), getattr(answer, "status", 200)
            if status != 200:
                raise OSError(f"status {status}")
            if len(data) < LEAST_BYTES or said is not None and int(said) != len(data):
                raise OSError(f"{len(data)} bytes of {said or LEAST_BYTES}")
            with open(temp, "wb") as f:
                f.write(data)
            if valid is not None and not valid(temp):
                raise OSError("the answer isn't what was asked for")
            os.replace(temp, path)
            return path
        except (OSError, urllib.error.URLError) as error:
            last = error
            if os.path.exists(temp):
                os.remove(temp)
            if attempt + 1 < retries:
                wait(min(60.0, 2.0**attempt))
    raise OSError(f"{url}: no valid answer after {retries} tries") from last


def read_chunks(plan: DataFrame, load: Callable[[dict], np.ndarray]) -> DataFrame:
    """``tile, row, col, r, c, z`` of a chunk plan; ``load`` gives a chunk's float32 array. Each chunk is a task's work, none goes through the driver."""
    names = plan.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                a = np.asarray(load(x), np.float32)
                if a.shape != (x["height"], x["width"]):
                    raise ValueError(f"chunk {x['row']}, {x['col']}: {a.shape} cells")
                r, c = np.divmod(np.arange(a.size), x["width"])
                n = a.size
                yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * n), pa.array([x["row"]] * n, pa.int32()), pa.array([x["col"]] * n, pa.int32()), pa.array(r + x["yoff"], pa.int32()), pa.array(c + x["xoff"], pa.int32()), pa.array(a.ravel())], ["tile", "row", "col", "r", "c", "z"])

    n = max(1, plan.count())  # a task a chunk
    return plan.select(*names).repartition(n, "tile", "row", "col").mapInArrow(run, "tile string, row int, col int, r int, c int, z float")
