"""Raster files: square byte grids, EHdr/BIL elevation, plain GeoTIFF, and mosaics."""

from __future__ import annotations

import math
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from xml.sax.saxutils import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import dims
from ..functions import tiles as T


def read_byte_grids(spark: SparkSession, folder: str, pattern: str = "*.lcv", rows_a_part: int = 256) -> DataFrame:
    """``tile, r, c, cls, side`` of headerless square grids, first row in the north. Sides that aren't whole, or under 2, raise."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                data = np.frombuffer(x["content"], np.uint8)
                side = math.isqrt(len(data))
                if side * side != len(data) or side < 2:
                    raise ValueError(f"{x['path']}: {len(data)} bytes are no square grid")
                for r0 in range(0, side, rows_a_part):
                    part = data[r0 * side : (r0 + rows_a_part) * side]
                    r, c = np.divmod(np.arange(len(part)), side)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * n), pa.array(r + r0, pa.int32()), pa.array(c, pa.int32()), pa.array(part.astype(np.int32)), pa.array([side] * n, pa.int32())], ["tile", "r", "c", "cls", "side"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.upper(F.regexp_replace(name, r"\.[^.]*$", "")).alias("tile"), "content").mapInArrow(cells, "tile string, r int, c int, cls int, side int")


def grid_files(spark: SparkSession, folder: str, pattern: str = "*.lcv") -> DataFrame:
    """``path, length, tile, corner``: the listing alone, contents unread."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", "length", name.alias("name"), T.tile_of_file(name).alias("corner"))


def _commit(path: str, parts) -> int:
    """Writes a file under another name first, so that it is whole or not there."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    temp, size = f"{path}.{uuid.uuid4().hex}.part", 0
    with open(temp, "wb") as f:
        for x in parts:
            size += f.write(x)
    os.replace(temp, path)
    return size


def write_raster_files(rows: DataFrame, folder: str, n_rows: int, n_bytes: int, suffix: str = ".lcv", header: Callable[[str], str] | None = None) -> DataFrame:
    """One file a tile from ``rows (tile, r, data)``, streamed in order of r; returns ``tile, path, length``. ``folder`` is one that all executors share.

    A tile whose rows are missing, or of another length, raises: no file of a wrong size is left. ``header`` makes the text of a ``.hdr`` file from the tile's name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((t, r, d) for b in batches for t, r, d in zip(*[c.to_pylist() for c in b.columns]))
        tile, seen, out, temp = None, 0, None, ""

        def close():
            out.close()
            if seen != n_rows:
                os.remove(temp)
                raise ValueError(f"{tile}: {seen} rows of {n_rows}")
            path = f"{folder}/{tile}{suffix}"
            os.replace(temp, path)
            if header is not None:
                _commit(f"{folder}/{tile}.hdr", [header(tile).encode()])
            return pa.RecordBatch.from_pylist([{"tile": tile, "path": path, "length": os.path.getsize(path)}])

        for t, r, data in rows:
            if t != tile:
                if out:
                    yield close()
                os.makedirs(folder, exist_ok=True)
                tile, seen, temp = t, 0, f"{folder}/{t}{suffix}.{uuid.uuid4().hex}.part"
                out = open(temp, "wb")  # noqa: SIM115
            if r != seen or len(data) != n_bytes:
                raise ValueError(f"{t}: row {r} of {len(data)} bytes where row {seen} of {n_bytes} was due")
            out.write(data)
            seen += 1
        if out:
            yield close()

    dealt = rows.select("tile", "r", "data").repartition("tile").sortWithinPartitions("tile", "r")
    return dealt.mapInArrow(run, "tile string, path string, length long")


def write_geotiffs(rows: DataFrame, folder: str, n_rows: int, n_cols: int, place: Callable[[str], tuple[float, float, float]], nodata: float | None = None, suffix: str = ".tif") -> DataFrame:
    """One byte GeoTIFF a tile from ``rows (tile, r, data)``; ``place`` gives a tile's (west, north, cell). Returns ``tile, path, length``; missing rows raise. A task holds one tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def close() -> pa.RecordBatch:
            if len(held) != n_rows or any(len(x) != n_cols for x in held):
                raise ValueError(f"{tile}: {len(held)} rows of {n_rows}, or rows of another length")
            path = f"{folder}/{tile}{suffix}"
            size = _commit(path, [geotiff(np.frombuffer(b"".join(held), np.uint8).reshape(n_rows, n_cols), *place(tile), nodata)])
            return pa.RecordBatch.from_pylist([{"tile": tile, "path": path, "length": size}])

        for t, data in ((t, d) for b in batches for t, d in zip(b.column(0).to_pylist(), b.column(2).to_pylist())):
            if t != tile:
                if held:
                    yield close()
                tile, held = t, []
            held.append(data)
        if held:
            yield close()

    dealt = rows.select("tile", "r", "data").repartition("tile").sortWithinPartitions("tile", "r")
    return dealt.mapInArrow(run, "tile string, path string, length long")


def int16_rows(cells: DataFrame, n_cols: int, nodata: int = dims.ELEVATION_NODATA, band: int = 64) -> DataFrame:
    """``tile, r, data``: little-endian 16-bit rows of ``cells (tile, r, c, z)``; null and missing cells have ``nodata``. A task holds ``band`` rows."""

    def run(table: pa.Table) -> pa.Table:
        first = table.column("band")[0].as_py() * band
        r, c = table.column("r").to_numpy() - first, table.column("c").to_numpy()
        a = np.full((band, n_cols), nodata, "<i2")
        a[r, c] = table.column("z").fill_null(nodata).to_numpy()
        some = np.unique(r).tolist()
        return pa.table([pa.array([table.column("tile")[0].as_py()] * len(some)), pa.array([first + x for x in some], pa.int32()), pa.array([a[x].tobytes() for x in some], pa.binary())], names=["tile", "r", "data"])

    cut = cells.select("tile", "r", "c", F.col("z").cast("short").alias("z"), F.floor(F.col("r") / band).cast("int").alias("band"))
    return cut.groupBy("tile", "band").applyInArrow(run, "tile string, r int, data binary")


def bil_header(n_rows: int, n_cols: int, west: float, north: float, step: float, nodata: int = dims.ELEVATION_NODATA) -> str:
    rows = {"BYTEORDER": "I", "LAYOUT": "BIL", "NROWS": n_rows, "NCOLS": n_cols, "NBANDS": 1, "NBITS": 16, "BANDROWBYTES": n_cols * 2, "TOTALROWBYTES": n_cols * 2, "PIXELTYPE": "SIGNEDINT", "ULXMAP": repr(west + step / 2), "ULYMAP": repr(north - step / 2), "XDIM": repr(step), "YDIM": repr(step), "NODATA": nodata}
    return "".join(f"{k:<14}{v}\n" for k, v in rows.items())


def parse_bil_header(text: str) -> dict:
    """The header's keys in upper case; numbers as numbers."""
    out: dict = {}
    for line in text.splitlines():
        key, _, value = line.strip().partition(" ")
        value = value.strip()
        if key:
            try:
                out[key.upper()] = int(value)
            except ValueError:
                try:
                    out[key.upper()] = float(value)
                except ValueError:
                    out[key.upper()] = value
    return out


def read_bil(spark: SparkSession, paths: list[str], rows_a_part: int = 256) -> DataFrame:
    """``tile, r, c, z`` of 16-bit BIL files, null for no data: tasks read windows of rows, not whole files."""
    plan = []
    for path in paths:
        with open(path.removesuffix(".bil") + ".hdr") as f:
            h = parse_bil_header(f.read())
        if h.get("NBITS") != 16 or h.get("NBANDS", 1) != 1 or os.path.getsize(path) != h["NROWS"] * h["NCOLS"] * 2:
            raise ValueError(f"{path}: one 16-bit band is needed, of the header's size")
        plan.append((path, os.path.basename(path).removesuffix(".bil"), h["NROWS"], h["NCOLS"], int(h.get("NODATA", dims.ELEVATION_NODATA)), "<" if h.get("BYTEORDER", "I") == "I" else ">"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                n = min(rows_a_part, x["rows"] - x["r0"]) * x["cols"]
                with open(x["path"], "rb") as f:
                    f.seek(x["r0"] * x["cols"] * 2)
                    z = np.frombuffer(f.read(n * 2), x["order"] + "i2").astype(np.int16)
                r, c = np.divmod(np.arange(n), x["cols"])
                yield pa.RecordBatch.from_arrays([pa.array([x["tile"]] * n), pa.array(r + x["r0"], pa.int32()), pa.array(c, pa.int32()), pa.array(z, pa.int16(), mask=z == x["nodata"])], ["tile", "r", "c", "z"])

    files = spark.createDataFrame(plan, "path string, tile string, rows int, cols int, nodata int, order string")
    n = sum(-(-x[2] // rows_a_part) for x in plan)
    parts = files.select("*", F.explode(F.expr(f"sequence(0, rows - 1, {rows_a_part})")).alias("r0")).repartition(max(1, n))  # a task a window
    return parts.mapInArrow(run, "tile string, r int, c int, z short")


def header_bounds(path: str) -> dict:
    """``west, south, east, north`` of a BIL file, from its header."""
    with open(path.removesuffix(".bil") + ".hdr") as f:
        h = parse_bil_header(f.read())
    west, north = h["ULXMAP"] - h["XDIM"] / 2, h["ULYMAP"] + h["YDIM"] / 2
    return {"west": west, "south": north - h["NROWS"] * h["YDIM"], "east": west + h["NCOLS"] * h["XDIM"], "north": north}


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, highest bit first; 256 clears the table, 257 ends."""
    table: list[bytes] = []
    out, last, width, at, n = bytearray(), b"", 9, 0, len(data) * 8
    while at + width <= n:
        word = int.from_bytes(data[at // 8 : at // 8 + 4].ljust(4, b"\0"), "big")
        code = word >> (32 - width - at % 8) & (1 << width) - 1
        at += width
        if code == 257:
            break
        if code == 256:
            table, last, width = [], b"", 9
            continue
        if code < 256:
            now = bytes([code])
        elif code - 258 < len(table):
            now = table[code - 258]
        elif last:
            now = last + last[:1]
        else:
            raise ValueError("damaged LZW data")
        out += now
        if last:
            table.append(last + now[:1])
        last = now
        width = max(9, min(12, (len(table) + 258 + 1).bit_length()))
    return bytes(out)


def read_geotiff(data: bytes) -> dict:
    """``data`` (an array of the first band), ``gt`` (west, pixel width, 0, north, 0, minus pixel height), ``nodata``, ``srid`` and ``dtype`` of a TIFF file.

    Strips or tiles; stored plainly, deflated or by LZW; with the horizontal or the floating-point predictor. Anything else raises ValueError.
    """
    if data[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("no TIFF file")
    o = "<" if data[:1] == b"I" else ">"
    codes = {1: "B", 2: "s", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}
    at = struct.unpack_from(f"{o}I", data, 4)[0]
    tags: dict = {}
    for i in range(struct.unpack_from(f"{o}H", data, at)[0]):
        tag, kind, n = struct.unpack_from(f"{o}HHI", data, at + 2 + 12 * i)
        if kind not in codes:
            continue
        form = f"{o}{n}{codes[kind]}"
        place = at + 10 + 12 * i
        if struct.calcsize(form) > 4:
            place = struct.unpack_from(f"{o}I", data, place)[0]
        tags[tag] = struct.unpack_from(form, data, place)
    one = lambda tag, other=None: tags[tag][0] if tag in tags else other
    w, h, bands, bits = one(256), one(257), one(277, 1), one(258, 1)
    kind = {1: "u", 2: "i", 3: "f"}.get(one(339, 1))
    packing, predictor = one(259, 1), one(317, 1)
    if not w or not h or bits not in (8, 16, 32, 64) or kind is None or bands != 1 or packing not in (1, 5, 8, 32946) or predictor not in (1, 2, 3):
        raise ValueError("this kind of TIFF isn't read")
    dtype = np.dtype(f"{kind}{bits // 8}")
    tw, th = (one(322), one(323)) if 322 in tags else (w, one(278, h))
    offsets, sizes = (tags[324], tags[325]) if 324 in tags else (tags[273], tags[279])
    across = -(-w // tw)
    out = np.zeros((-(-h // th) * th, across * tw), dtype)
    for k, (a, n) in enumerate(zip(offsets, sizes)):
        raw = data[a : a + n]
        raw = raw if packing == 1 else _lzw(raw) if packing == 5 else zlib.decompress(raw)
        rows = th if 322 in tags else min(th, h - k * th)
        if len(raw) < rows * tw * dtype.itemsize:
            raise ValueError("a part of the TIFF is too short")
        if predictor == 3:  # bytes of a row by their rank, highest first, as differences
            planes = np.cumsum(np.frombuffer(raw, np.uint8, rows * tw * dtype.itemsize).reshape(rows, -1), axis=1, dtype=np.uint8)
            part = planes.reshape(rows, dtype.itemsize, tw).transpose(0, 2, 1).copy().view(dtype.newbyteorder(">"))[..., 0]
        else:
            part = np.frombuffer(raw, dtype.newbyteorder(o), rows * tw).reshape(rows, tw).astype(dtype)
            if predictor == 2:
                part = np.cumsum(part, axis=1, dtype=dtype)
        r, c = k // across * th, k % across * tw
        out[r : r + rows, c : c + tw] = part
    step, tie = tags.get(33550, (0.0, 0.0)), tags.get(33922, (0.0,) * 6)
    keys = tags.get(34735, ())
    srid = next((keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i] in (2048, 3072) and keys[i + 1] == 0), None)
    text = tags[42113][0].rstrip(b"\0").strip().decode() if 42113 in tags else None
    gt = [tie[3] - tie[0] * step[0], step[0], 0.0, tie[4] + tie[1] * step[1], 0.0, -step[1]]
    return {"data": out[:h, :w], "gt": gt, "nodata": float(text) if text else None, "srid": srid, "dtype": dtype.name}


def geotiff(data: np.ndarray, west: float, north: float, step: float, nodata: float | None = None, tile: int = 256) -> bytes:
    """A tiled, deflated GeoTIFF in EPSG:4326 of a uint8 or float32 array."""
    if data.dtype not in (np.uint8, np.float32):
        raise ValueError("uint8 or float32 is needed")
    h, w = data.shape
    across, down = -(-w // tile), -(-h // tile)
    blobs = []
    for i in range(down):
        for j in range(across):
            part = np.zeros((tile, tile), data.dtype)
            some = data[i * tile : (i + 1) * tile, j * tile : (j + 1) * tile]
            part[: some.shape[0], : some.shape[1]] = some
            blobs.append(zlib.compress(part.astype(data.dtype.newbyteorder("<")).tobytes()))
    tags: list[tuple[int, int, list]] = [
        (256, 4, [w]), (257, 4, [h]), (258, 3, [data.dtype.itemsize * 8]), (259, 3, [8]), (262, 3, [1]), (277, 3, [1]), (322, 4, [tile]), (323, 4, [tile]),
        (324, 4, [0] * len(blobs)), (325, 4, [len(b) for b in blobs]), (339, 3, [1 if data.dtype == np.uint8 else 3]),
        (33550, 12, [step, step, 0.0]), (33922, 12, [0.0, 0.0, 0.0, west, north, 0.0]), (34735, 3, [1, 1, 0, 3, 1024, 0, 1, 2, 1025, 0, 1, 1, 2048, 0, 1, 4326]),
    ]
    if nodata is not None:
        tags.append((42113, 2, list(f"{nodata:g}\0".encode())))
    codes = {2: "B", 3: "H", 4: "I", 12: "d"}
    at = 8 + 2 + 12 * len(tags) + 4
    places, extra = {}, b""
    for tag, kind, values in tags:
        size = struct.calcsize(f"<{len(values)}{codes[kind]}")
        if size > 4:
            places[tag] = at + len(extra)
            extra += b"\0" * (size + size % 2)
    start, offsets = at + len(extra), []
    for b in blobs:
        offsets.append(start)
        start += len(b)
    body, extra = b"", bytearray(extra)
    for tag, kind, values in sorted(tags):
        values = offsets if tag == 324 else values
        packed = struct.pack(f"<{len(values)}{codes[kind]}", *values)
        if tag in places:
            extra[places[tag] - at : places[tag] - at + len(packed)] = packed
            packed = struct.pack("<I", places[tag])
        body += struct.pack("<HHI", tag, kind, len(values)) + packed.ljust(4, b"\0")
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + body + struct.pack("<I", 0) + bytes(extra) + b"".join(blobs)


def mosaic_xml(files: list[dict], dtype: str = "Byte", nodata: float | None = None) -> str | None:
    """A virtual mosaic of files with ``path, west, north, step, width, height``, at the finest step; None without files."""
    if not files:
        return None
    step = min(f["step"] for f in files)
    west, north = min(f["west"] for f in files), max(f["north"] for f in files)
    east = max(f["west"] + f["width"] * f["step"] for f in files)
    south = min(f["north"] - f["height"] * f["step"] for f in files)
    cells = lambda x: round(x / step)
    nd = "" if nodata is None else f"    <NoDataValue>{nodata:g}</NoDataValue>\n"
    sources = "".join(
        f'    <SimpleSource>\n      <SourceFilename relativeToVRT="0">{escape(f["path"])}</SourceFilename>\n      <SourceBand>1</SourceBand>\n      <SrcRect xOff="0" yOff="0" xSize="{f["width"]}" ySize="{f["height"]}"/>\n'
        f'      <DstRect xOff="{cells(f["west"] - west)}" yOff="{cells(north - f["north"])}" xSize="{cells(f["width"] * f["step"])}" ySize="{cells(f["height"] * f["step"])}"/>\n    </SimpleSource>\n'
        for f in files
    )
    return f'<VRTDataset rasterXSize="{cells(east - west)}" rasterYSize="{cells(north - south)}">\n  <SRS>EPSG:4326</SRS>\n  <GeoTransform>{west!r}, {step!r}, 0, {north!r}, 0, {-step!r}</GeoTransform>\n  <VRTRasterBand dataType="{dtype}" band="1">\n{nd}{sources}  </VRTRasterBand>\n</VRTDataset>\n'


def write_mosaic(path: str, bounds: dict[str, dict], dtype: str = "Int16", nodata: float | None = dims.ELEVATION_NODATA, required: bool = False) -> str | None:
    """Writes the virtual mosaic of BIL files (path: ``header_bounds`` and ``step``); None without any, or an error if one is ``required``."""
    if not bounds and required:
        raise ValueError("a mosaic of pieces needs a piece")
    files = [{"path": p, "west": b["west"], "north": b["north"], "step": b["step"], "width": round((b["east"] - b["west"]) / b["step"]), "height": round((b["north"] - b["south"]) / b["step"])} for p, b in sorted(bounds.items())]
    text = mosaic_xml(files, dtype, nodata)
    if text is not None:
        _commit(path, [text.encode()])
    return text and path


def remove_sidecars(path: str) -> list[str]:
    """Removes a BIL file with its header and what other tools leave beside it; returns what was there."""
    stem, gone = path.removesuffix(".bil"), []
    for x in (path, *[f"{stem}.{e}" for e in ("hdr", "prj", "stx", "clr", "blw")], f"{path}.aux.xml", f"{stem}.aux.xml"):
        if os.path.exists(x):
            os.remove(x)
            gone.append(x)
    return gone


def mosaic(tiles: list[DataFrame]) -> DataFrame | None:
    """The native mosaic: a view over the tiles' tables."""
    out = None
    for x in tiles:
        out = x if out is None else out.unionByName(x)
    return out
