"""Vector layers: discovery, GeoJSON and GeoPackage, and the feature-service client's plan."""

from __future__ import annotations

import json
import os
import sqlite3
import struct
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..operators.geometry import RINGS

# The kinds of files that hold layers.
EXTENSIONS = (".shp", ".gpkg", ".sqlite", ".db", ".fgb", ".geojson")


def pick_layer(catalog: DataFrame, wanted: list[str]) -> DataFrame:
    """The best of ``catalog (path, layer, fields, n, size)``: it has all wanted fields, in any case, then most features, largest file, first path."""
    lower = F.transform("fields", lambda x: F.lower(x))
    has = F.size(F.array_intersect(lower, F.array(*[F.lit(w.lower()) for w in wanted]))) == len({w.lower() for w in wanted})
    ranked = catalog.where(has).orderBy(F.col("n").desc(), F.col("size").desc(), "path", "layer")
    return ranked.limit(1)


def discover(folder: str) -> list[tuple[str, str, list[str], int, int]]:
    """Catalog rows of the GeoPackage, SQLite and GeoJSON files below a folder; those that can't be read are left out."""
    out = []
    for top, _, names in sorted(os.walk(folder)):
        for name in sorted(names):
            path = os.path.join(top, name)
            if not name.lower().endswith(EXTENSIONS):
                continue
            try:
                out += _layers(path)
            except (sqlite3.Error, ValueError, OSError, KeyError):
                continue
    return out


def _layers(path: str) -> list[tuple[str, str, list[str], int, int]]:
    size = os.path.getsize(path)
    if path.lower().endswith(".geojson"):
        with open(path) as f:
            features = json.load(f)["features"]
        fields = list(dict.fromkeys(k for x in features for k in x.get("properties") or {}))
        return [(path, os.path.basename(path).rpartition(".")[0], fields, len(features), size)]
    if not path.lower().endswith((".gpkg", ".sqlite", ".db")):
        return []
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        tables = [r[0] for r in db.execute("select table_name from gpkg_contents where data_type = 'features' order by 1")]
        return [(path, t, [r[1] for r in db.execute(f'pragma table_info("{t}")')], db.execute(f'select count(*) from "{t}"').fetchone()[0], size) for t in tables]


def read_geojson(spark: SparkSession, path: str, fields: dict[str, str]) -> DataFrame:
    """``fid, <fields>, rings`` of a GeoJSON file's polygons; ``fields`` are names and SQL types."""
    props = ", ".join(f"`{k}`: string" for k in fields)
    schema = f"features array<struct<properties: struct<{props}>, geometry: struct<type: string, coordinates: string>>>"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path).select(F.posexplode("features").alias("fid", "f"))
    poly = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    flat = F.when(F.col("f.geometry.type") == "Polygon", poly).when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(multi))
    rings = F.transform(flat, lambda g, i: F.struct(i.cast("int").alias("ring"), F.transform(g, lambda q: F.struct(q[0].alias("x"), q[1].alias("y"))).alias("pts")))
    return rows.select(F.col("fid").cast("long").alias("fid"), *[F.col(f"f.properties.`{k}`").try_cast(t).alias(k) for k, t in fields.items()], rings.alias("rings"))


def _rings(blob: bytes | None) -> list | None:
    """Rings of a GeoPackage polygon or multipolygon; curves raise."""
    if not blob:
        return None
    at = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
    out: list = []

    def shape(at: int) -> int:
        order = "<" if blob[at] else ">"
        kind = struct.unpack_from(order + "I", blob, at + 1)[0]
        extra = {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000]
        n = struct.unpack_from(order + "I", blob, at + 5)[0]
        at += 9
        if kind % 1000 == 6:
            for _ in range(n):
                at = shape(at)
            return at
        if kind % 1000 != 3:
            raise ValueError(f"geometry type {kind} is not a polygon")
        for _ in range(n):
            m = struct.unpack_from(order + "I", blob, at)[0]
            step = 2 + extra
            flat = struct.unpack_from(f"{order}{m * step}d", blob, at + 4)
            out.append((len(out), list(zip(flat[::step], flat[1::step]))))
            at += 4 + 8 * m * step
        return at

    shape(at)
    return out


class GpkgReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.layer = options["path"], options["layer"]
        self.fields = [f.name for f in schema.fields if f.name not in ("fid", "rings")]
        self.names = [f.name for f in schema.fields]
        self.n = int(options.get("partitions", 8))
        self.where: list[tuple[str, list]] = json.loads(options.get("where", "[]"))
        self.geometry = options.get("geometry", "geom")

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            low, high = db.execute(f'select min(rowid), max(rowid) from "{self.layer}"').fetchone()
        if low is None:
            return [InputPartition((0, 0))]
        step = -(-(high - low + 1) // self.n)
        return [InputPartition((a, min(a + step, high + 1))) for a in range(low, high + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        low, high = partition.value
        sql = "".join(f' and "{k}" in ({",".join("?" * len(v))})' for k, v in self.where)
        columns = "".join(f', "{k}"' for k in self.fields)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            for fid, geom, *values in db.execute(f'select rowid, "{self.geometry}"{columns} from "{self.layer}" where rowid >= ? and rowid < ?{sql} order by rowid', [low, high, *[x for _, v in self.where for x in v]]):
                row = dict(zip(self.fields, values)) | {"fid": fid, "rings": _rings(geom) if "rings" in self.names else None}
                yield tuple(row[k] for k in self.names)


class GpkgSource(DataSource):
    """``spark.read.format("gpkg").schema(...).option("path", ...).option("layer", ...)``: partitions are ranges of row ids."""

    @classmethod
    def name(cls) -> str:
        return "gpkg"

    def schema(self) -> str:
        raise ValueError("give the schema: fid, fields and rings")

    def reader(self, schema: StructType) -> GpkgReader:
        return GpkgReader(dict(self.options), schema)


def read_gpkg(spark: SparkSession, path: str, layer: str, fields: dict[str, str], partitions: int = 8, where: dict[str, list] | None = None) -> DataFrame:
    """``fid, <fields>, rings``; ``where`` names the values that a field may have, for SQLite to look up.

    They are an option of the source, not filters that Spark pushes: Spark keeps a pushed-down reader for other queries of the same table.
    """
    spark.dataSource.register(GpkgSource)
    schema = ", ".join(["fid long", *[f"`{k}` {t}" for k, t in fields.items()], f"rings {RINGS}"])
    return spark.read.format("gpkg").schema(schema).option("path", path).option("layer", layer).option("partitions", partitions).option("where", json.dumps(list((where or {}).items()))).load()


def service_pages(region: str, total: int, page: int = 5000) -> list[dict]:
    """Query parameters of a feature service's pages for one region code."""
    return [{"where": f"ggo='{region}'", "resultOffset": at, "resultRecordCount": min(page, total - at), "outFields": "*", "f": "geojson"} for at in range(0, total, page)]


# The regions that the public service knows.
REGIONS = tuple(f"{i:02d}" for i in range(1, 15))


def read_service(spark: SparkSession, ask: Callable[[dict], bytes], fields: dict[str, str], regions: tuple[str, ...] = REGIONS, page: int = 5000, retries: int = 5, wait: Callable[[float], None] = time.sleep) -> tuple[DataFrame, DataFrame]:
    """(features ``region, fid, <fields>, geometry``, parts ``part, n``) of a feature service: a partition a region, its pages one after the other until one isn't full.

    ``ask`` sends the parameters of ``service_pages`` and returns GeoJSON; a failing page is asked for again ``retries`` times in all. ``geometry`` is GeoJSON text. ``fid`` counts
    within a region. The features are lazy: write them before ``gate_parts`` compares them with the parts.
    """
    names = ["region", "fid", *fields, "geometry"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for region in (x for batch in batches for x in batch.column(0).to_pylist()):
            at = 0
            while True:
                query = service_pages(region, page, page)[0] | {"resultOffset": at}
                for attempt in range(retries):
                    try:
                        found = json.loads(ask(query))["features"]
                        break
                    except (OSError, ValueError, KeyError) as error:
                        if attempt + 1 == retries:
                            raise OSError(f"region {region}, offset {at}: no valid answer") from error
                        wait(min(60.0, 2.0**attempt))
                text = lambda x: None if x is None else str(x)
                columns = [[region] * len(found), range(at, at + len(found)), *[[text(x["properties"].get(k)) for x in found] for k in fields], [json.dumps(x["geometry"]) for x in found]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "fid" else pa.string()) for k, c in zip(names, columns)], names)
                at += len(found)
                if len(found) < page:
                    break

    plan = spark.createDataFrame([(x,) for x in regions], "region string").repartition(len(regions), "region")
    schema = ", ".join(f"`{k}` {'long' if k == 'fid' else 'string'}" for k in names)
    rows = plan.mapInArrow(run, schema)
    rows = rows.select("region", "fid", *[F.col(f"`{k}`").try_cast(t).alias(k) for k, t in fields.items()], "geometry")
    known = spark.createDataFrame([(x,) for x in regions], "part string")
    parts = known.join(rows.groupBy(F.col("region").alias("part")).agg(F.count(F.lit(1)).alias("n")), "part", "left").fillna({"n": 0})
    return rows, parts
