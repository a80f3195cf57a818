"""Files in and out, resumable builds, and the two pipelines on small grids."""

import dataclasses
import json
import sqlite3
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.config import ElevationConfig, LandCoverConfig
from tessella.operators import blocks, geometry, qa
from tessella.plans import elevation, landcover
from tessella.sources import imagery, rasters, tables, vectors
from tessella.streaming import ingest


def test_byte_grids(spark, tmp_path):
    a = np.random.default_rng(1).integers(0, 15, (7, 7)).astype(np.uint8)
    cells = spark.createDataFrame([("N45E014", r, c, int(a[r, c])) for r, c in np.ndindex(a.shape)], "tile string, r int, c int, cls int")
    out = rasters.write_raster_files(blocks.raster_rows(blocks.to_blocks(cells, 7, 7, 3)), str(tmp_path), 7, 7).collect()
    assert out[0].length == 49 and (tmp_path / "N45E014.lcv").read_bytes() == a.tobytes()
    back = rasters.read_byte_grids(spark, str(tmp_path), rows_a_part=2)
    assert {(x.r, x.c): x.cls for x in back.collect()} == {k: int(a[k]) for k in np.ndindex(a.shape)}
    assert rasters.grid_files(spark, str(tmp_path)).first().corner.lat == 45
    with pytest.raises(Exception, match="rows of"):
        rasters.write_raster_files(blocks.raster_rows(blocks.to_blocks(cells.where("r < 5"), 5, 7, 3)), str(tmp_path), 7, 7).collect()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/N45E015.lcv").write_bytes(b"12345")
    with pytest.raises(Exception, match="square"):
        rasters.read_byte_grids(spark, str(tmp_path / "bad")).collect()


def test_bil(spark, tmp_path):
    z = np.random.default_rng(2).integers(-100, 3000, (6, 5)).astype("<i2")
    z[2, 2] = -32768
    (tmp_path / "N45E014.bil").write_bytes(z.tobytes())
    (tmp_path / "N45E014.hdr").write_text(rasters.bil_header(6, 5, 14.0, 46.0, 0.2))
    got = rasters.read_bil(spark, [str(tmp_path / "N45E014.bil")], 4).collect()
    assert {(x.r, x.c): x.z for x in got} == {k: None if k == (2, 2) else int(z[k]) for k in np.ndindex(z.shape)}
    (tmp_path / "N45E014.bil").write_bytes(b"x")
    with pytest.raises(ValueError):
        rasters.read_bil(spark, [str(tmp_path / "N45E014.bil")])


def test_geotiff_and_mosaic():
    a = np.arange(300 * 20, dtype=np.float32).reshape(300, 20)
    data = rasters.geotiff(a, 14.0, 46.0, 0.01, -1.0)
    n = struct.unpack_from("<H", data, 8)[0]
    tags = {t[0]: t for t in (struct.unpack_from("<HHII", data, 10 + 12 * i) for i in range(n))}
    assert list(tags) == sorted(tags) and tags[256][3] == 20 and tags[257][3] == 300
    at, size = (struct.unpack_from("<2I", data, tags[k][3]) for k in (324, 325))
    first = np.frombuffer(zlib.decompress(data[at[0] : at[0] + size[0]]), np.float32).reshape(256, 256)
    assert (first[:, :20] == a[:256]).all()
    assert rasters.mosaic_xml([]) is None
    xml = rasters.mosaic_xml([{"path": "a&b", "west": 14.0, "north": 46.0, "step": 0.5, "width": 2, "height": 2}, {"path": "c", "west": 15.0, "north": 46.0, "step": 0.25, "width": 4, "height": 4}], nodata=255)
    assert 'rasterXSize="8" rasterYSize="4"' in xml and "a&amp;b" in xml and "<NoDataValue>255" in xml


def gpkg(path):
    def blob(rings):
        body = struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + b"".join(struct.pack("<2d", *p) for p in r) for r in rings)
        return b"GP\x00\x01" + struct.pack("<i", 4326) + body

    db = sqlite3.connect(path)
    db.execute("create table gpkg_contents (table_name text, data_type text)")
    db.execute("insert into gpkg_contents values ('l', 'features')")
    db.execute('create table l (fid integer primary key, geom blob, "RABA_ID" integer, name text)')
    for i in range(10):
        db.execute("insert into l values (?, ?, ?, ?)", (i + 1, blob([[(i, 0), (i + 1, 0), (i, 1), (i, 0)]]), 1100 + 100 * (i % 3), f"n{i}"))
    db.commit()
    db.close()


def test_vectors(spark, tmp_path):
    gpkg(str(tmp_path / "a.gpkg"))
    feature = {"type": "Feature", "properties": {"raba_id": 7000}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [0, 1]]], [[[5, 5], [6, 5], [5, 6]]]]}}
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature]}))
    (tmp_path / "c.gpkg").write_bytes(b"not a database")
    catalog = spark.createDataFrame(vectors.discover(str(tmp_path)), "path string, layer string, fields array<string>, n long, size long")
    best = vectors.pick_layer(catalog, ["raba_id"]).collect()
    assert len(best) == 1 and best[0].path.endswith("a.gpkg") and best[0].n == 10
    df = vectors.read_gpkg(spark, best[0].path, best[0].layer, {"RABA_ID": "int", "name": "string"}, 3)
    assert df.count() == 10 and sorted(x.fid for x in df.where("RABA_ID = 1200").collect()) == [2, 5, 8]
    some = vectors.read_gpkg(spark, best[0].path, best[0].layer, {"RABA_ID": "int"}, 3, {"RABA_ID": [1200, 1300]})
    assert sorted(x.fid for x in some.collect()) == [2, 3, 5, 6, 8, 9]
    assert df.orderBy("fid").first().rings[0].pts[1].x == 1.0
    js = vectors.read_geojson(spark, str(tmp_path / "b.geojson"), {"raba_id": "int"}).first()
    assert js.raba_id == 7000 and len(js.rings) == 2 and js.rings[1].pts[1].x == 6.0
    assert [x["resultOffset"] for x in vectors.service_pages("03", 12_000)] == [0, 5000, 10_000] and len(vectors.REGIONS) == 14


def test_reports(spark, tmp_path):
    path = tmp_path / "q.csv"
    assert not tables.write_report([], str(path)) and not path.exists()
    tables.write_report([{"a": 1}, {"b": None, "a": 2}], str(path))
    assert path.read_bytes() == b"\xef\xbb\xbfa;b\n1;\n2;\n"
    tables.write_rf_profile(spark, str(tmp_path / "rf.dat"))
    lines = (tmp_path / "rf.dat").read_text().splitlines()
    assert len(lines) == 15 and lines[5] == "30,140"
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc/RF_CALIBRATION_PENDING_1.txt").write_text("old")
    tables.write_documentation(spark, str(tmp_path / "doc"), {"x": 1})
    assert len(list((tmp_path / "doc").iterdir())) == 3
    rows = (tmp_path / "doc/class_definitions.csv").read_text("utf-8-sig").splitlines()
    assert rows[0] == "class;name;height_m;density_pct;min_area_fraction;min_area_pct" and rows[1] == "00;Water;0;0;0.75;75.0" and rows[15] == "14;Urban and Built-up HI;20;175;;"
    assert (tmp_path / "doc/forest_prior.csv").read_text("utf-8-sig").splitlines()[4] == "4;;433463.13;36.8142717266;"


class Answer:
    def __init__(self, data, said=None):
        self.data, self.headers = data, {} if said is None else {"Content-Length": str(said)}

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass

    def read(self):
        return self.data


def test_fetch(tmp_path):
    answers = [Answer(b"short"), Answer(b"x" * 2000, 3000), Answer(b"y" * 2000, 2000)]
    waits = []
    path = imagery.fetch("http://x", str(tmp_path / "c.tif"), wait=waits.append, opener=lambda *_, **__: answers.pop(0))
    assert open(path, "rb").read() == b"y" * 2000 and waits == [1.0, 2.0]
    assert imagery.fetch("http://x", path, opener=None) == path
    with pytest.raises(OSError):
        imagery.fetch("http://x", str(tmp_path / "d.tif"), retries=2, wait=lambda _: None, opener=lambda *_, **__: Answer(b""))
    assert sorted(x.name for x in tmp_path.iterdir()) == ["c.tif"]
    url = imagery.export_url("http://s/", {"west": 14.0, "south": 45.0, "east": 14.5, "north": 45.5, "width": 10, "height": 20}, "nearest")
    assert "size=10%2C20" in url and "RSP_NearestNeighbor" in url and "adjustAspectRatio=false" in url and "noDataInterpretation" not in url
    assert url == imagery.export_url("http://s/exportImage", {"west": 14.0, "south": 45.0, "east": 14.5, "north": 45.5, "width": 10, "height": 20}, "nearest")


def test_fetch_checks_what_it_fetched(tmp_path):
    waits, good = [], b"g" * 2000
    answers = [Answer(b"b" * 2000), Answer(good)]
    valid = lambda p: open(p, "rb").read() == good  # noqa: E731, SIM115
    path = imagery.fetch("http://x", str(tmp_path / "c.tif"), wait=waits.append, opener=lambda *_, **__: answers.pop(0), valid=valid)
    assert valid(path) and waits == [1.0]
    bad = Answer(good)
    bad.status = 503
    with pytest.raises(OSError):
        imagery.fetch("http://x", str(tmp_path / "d.tif"), retries=1, wait=waits.append, opener=lambda *_, **__: bad)
    assert waits == [1.0]


def tiff(part, packing, predictor, order="<"):
    """A one-strip float32 TIFF, written by hand."""
    h, w = part.shape
    if predictor == 3:
        planes = part.astype(">f4").view(np.uint8).reshape(h, w, 4).transpose(0, 2, 1).reshape(h, -1)
        raw = np.diff(planes, axis=1, prepend=np.uint8(0)).astype(np.uint8).tobytes()
    else:
        raw = part.astype(f"{order}f4").tobytes()
    raw = zlib.compress(raw) if packing == 8 else lzw(raw) if packing == 5 else raw
    tags = [(256, 4, w), (257, 4, h), (258, 3, 32), (259, 3, packing), (273, 4, 8), (277, 3, 1), (278, 4, h), (279, 4, len(raw)), (317, 3, predictor), (339, 3, 3)]
    body = struct.pack(f"{order}H", len(tags))
    for tag, kind, value in tags:
        body += struct.pack(f"{order}HHI", tag, kind, 1) + struct.pack(f"{order}I" if kind == 4 else f"{order}Hxx", value)
    return (b"II*\0" if order == "<" else b"MM\0*") + struct.pack(f"{order}I", 8 + len(raw)) + raw + body + b"\0" * 4


def lzw(raw):
    """TIFF's LZW, with the width of a code that its decoder expects."""
    table, now, bits, width = {bytes([i]): i for i in range(256)}, b"", "1" + "0" * 8, 9
    for i in range(len(raw)):
        c = raw[i : i + 1]
        if now + c in table:
            now += c
            continue
        bits += format(table[now], f"0{width}b")
        table[now + c] = len(table) + 2
        now = c
        width = max(9, (len(table) + 2).bit_length())
        if len(table) + 2 >= 4094:
            bits += format(table[now], f"0{width}b") + format(256, f"0{width}b")
            table, now, width = {bytes([i]): i for i in range(256)}, b"", 9
    if now:
        bits += format(table[now], f"0{width}b")
        width = max(9, min(12, (len(table) + 3).bit_length()))
    bits += format(257, f"0{width}b")
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


@pytest.mark.parametrize("packing, predictor, order", [(1, 1, "<"), (1, 1, ">"), (8, 1, "<"), (8, 3, "<"), (5, 1, "<"), (5, 3, ">")])
def test_tiff_is_read_as_written(packing, predictor, order):
    part = (np.arange(60 * 33).reshape(60, 33) % 97 * 1.25 - 7).astype(np.float32)
    assert np.array_equal(rasters.read_geotiff(tiff(part, packing, predictor, order))["data"], part)


def test_geotiff_round_trip():
    part = np.random.default_rng(1).normal(size=(300, 270)).astype(np.float32)
    x = rasters.read_geotiff(rasters.geotiff(part, 14.0, 46.0, 1 / 300, -32768.0))
    assert np.array_equal(x["data"], part) and x["srid"] == 4326 and x["nodata"] == -32768 and x["dtype"] == "float32"
    assert np.allclose(x["gt"], [14.0, 1 / 300, 0, 46.0, 0, -1 / 300], atol=1e-15)
    with pytest.raises(ValueError):
        rasters.read_geotiff(b"no")


def test_service_loader(spark, tmp_path):
    """Chunks over the wire: the request, decoding, checks, and the kept file."""
    step = 1 / 80
    config = ElevationConfig(tiles=("N45E014",), arcsec=45.0, chunk_cols=2, chunk_rows=2, split_grid=4)
    chunk = {"tile": "N45E014", "row": 0, "col": 1, "west": 14.5, "south": 45.5, "east": 15.0, "north": 46.0, "width": 40, "height": 40}
    z = np.random.default_rng(3).integers(0, 1 << 20, (40, 40)).astype(np.float32)
    z[3, 3] = -32768
    asked = []

    def opener(url, timeout):
        asked.append(url)
        return Answer(rasters.geotiff(z, 14.5, 46.0, step, -32768.0))

    load = imagery.service_loader("http://s/ImageServer/exportImage", str(tmp_path), config.interpolation, opener=opener)
    got = load(chunk)
    assert np.isnan(got[3, 3]) and np.array_equal(np.nan_to_num(got, nan=-32768), z) and len(asked) == 1
    assert np.array_equal(load(chunk), got, equal_nan=True) and len(asked) == 1
    with pytest.raises(ValueError):
        imagery.decode_chunk(rasters.geotiff(z, 14.4, 46.0, step, -32768.0), chunk)
    with pytest.raises(ValueError):
        imagery.decode_chunk(rasters.geotiff(z.astype(np.uint8), 14.5, 46.0, step), chunk)


def test_elevation_build(spark, tmp_path):
    config = ElevationConfig(tiles=("N45E014",), arcsec=180.0, chunk_cols=3, chunk_rows=3, split_grid=4, compare_samples=64)
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def load(chunk):
        open(f"{folder}/{chunk['row']}-{chunk['col']}", "a").write("x")
        r, c = np.mgrid[chunk["yoff"] : chunk["yoff"] + chunk["height"], chunk["xoff"] : chunk["xoff"] + chunk["width"]]
        return (r * 10 + c + 0.4).astype(np.float32)

    base = spark.createDataFrame([(r, c, float(r * 10 + c)) for r in range(20) for c in range(20)], "r int, c int, z double")
    out = elevation.run(spark, config, str(tmp_path / "out"), load, base)
    assert out["cells"].count() == 400
    assert {(x.r, x.c): x.z for x in out["cells"].collect()} == {(r, c): r * 10 + c for r in range(20) for c in range(20)}
    assert out["comparison"].first().status == "OK" and out["comparison"].first().max_abs_m < 1e-9
    elevation.run(spark, config, str(tmp_path / "out"), load, base)
    assert all(len(x.read_text()) == 1 for x in calls.iterdir()) and len(list(calls.iterdir())) == 9
    with pytest.raises(Exception, match="other_options"):
        elevation.build(spark, ElevationConfig(tiles=("N45E014",), arcsec=180.0, interpolation="cubic"), str(tmp_path / "out"), load)
    assert elevation.piece_folder(config) == "180arcsec_SPLIT_4x4"
    reports = {x.name: len(x.read_text().splitlines()) for x in (tmp_path / "out").glob("*.csv")}
    assert reports == {"comparison.csv": 2, "split_mismatches.csv": 17, "seams.csv": 25, "split_totals.csv": 2}
    assert out["split_totals"].first()[:] == ("N45E014", 16, 400, 0, 0) and out["pieces"].count() == 16 and out["seams"].count() == 24
    # a damaged piece is found, and so is a missing one
    piece = tmp_path / "out" / elevation.piece_folder(config) / "N45E014_q0102.bil"
    data = bytearray(piece.read_bytes())
    data[7] ^= 1
    piece.write_bytes(data)
    again = ElevationConfig(tiles=("N45E014",), arcsec=180.0, chunk_cols=3, chunk_rows=3, split_grid=4, stage="split-qa")
    with pytest.raises(qa.GateError, match="mismatches: 1"):
        elevation.run(spark, again, str(tmp_path / "out"))
    piece.unlink()
    with pytest.raises(OSError):
        elevation.run(spark, again, str(tmp_path / "out"))


def test_compare_of_two_tiles(spark):
    """Each tile meets its own reference, or its own place of one for all."""
    config = ElevationConfig(tiles=("N45E014", "N45E015"), arcsec=180.0, compare_samples=64)
    z = spark.createDataFrame([(t, r, c, float(k * 100 + r * 10 + c)) for k, t in enumerate(config.tiles) for r in range(20) for c in range(20)], "tile string, r int, c int, z double")
    own = elevation.compare(spark, z, z.withColumn("z", F.col("z") + F.when(F.col("tile") == "N45E015", 2.0).otherwise(0.0)), config).collect()
    assert {x.tile: round(x.bias_m, 9) for x in own} == {"N45E014": 0.0, "N45E015": -2.0}
    one = spark.createDataFrame([(r, c, float(c // 20 * 100 + r * 10 + c % 20)) for r in range(20) for c in range(40)], "r int, c int, z double")
    both = elevation.compare(spark, z, one, config, gt=(14.0, 0.05, 46.0, 0.05)).collect()
    assert {x.tile: round(x.max_abs_m, 6) for x in both} == {"N45E014": 0.0, "N45E015": 0.0} and all(x.samples > 100 for x in both)
    with pytest.raises(ValueError):
        elevation.compare(spark, z, one, config)


def square(x, y, w, h):
    return [(0, [(x, y), (x + w, y), (x + w, y + h), (x, y + h)])]


def test_landcover_build(spark, tmp_path):
    config = LandCoverConfig(tiles=("N45E014", "N46E014"), arcsec=360.0, supersample=4, block_size=32, urban_arcsec=180.0, urban_supersample=2, urban_radius_m=6000.0)
    schema = f"fid long, code string, rings {geometry.RINGS}"
    land = spark.createDataFrame([(1, "1500", square(13.9, 44.9, 1.2, 0.7)), (2, "7000.0", square(14.2, 45.2, 0.3, 0.2)), (3, "1", square(14.0, 45.0, 1.0, 1.0))], schema).withColumnRenamed("code", "raba_id")
    stands = spark.createDataFrame([(1, "7", "1", "2", "10", square(14.5, 45.0, 0.3, 0.4))], f"fid long, rfaza string, sklep string, povrsina string, lzsku string, rings {geometry.RINGS}")
    hydro = spark.createDataFrame([(1, "11,02", square(14.6, 45.1, 0.1, 0.1)), (2, "99", square(14.0, 45.0, 1.0, 1.0))], f"fid long, simbol string, rings {geometry.RINGS}")
    houses = spark.createDataFrame([(1, "2", "20", square(14.0, 45.0, 0.2, 0.2)), (2, "1", "20", square(14.0, 45.0, 1.0, 1.0))], f"fid long, stan_konst string, visina string, rings {geometry.RINGS}")
    layers = landcover.prepare_layers({"land_use": land, "stands": stands, "hydro": hydro}, config)
    legacy = spark.createDataFrame([(t, r, c, 13 if (r, c) == (0, 5) else 2, 11) for t in config.tiles for r in range(11) for c in range(11)], "tile string, r int, c int, cls int, side int")
    mask = spark.createDataFrame([("N45E014", r, c) for r in range(11) for c in range(10)], "tile string, r int, c int")
    got = landcover.build(spark, layers, landcover.prepare_buildings(houses), legacy, mask, config)
    got.cells = got.cells.cache()
    landcover.check(got)
    cls = {(x.tile, x.r, x.c): x.cls for x in got.cells.collect()}
    assert len(cls) == 242 and cls["N45E014", 9, 9] == 6 and cls["N45E014", 3, 10] == 2 and cls["N46E014", 0, 5] == 13
    assert cls["N45E014", 0, 5] == 3 and cls["N45E014", 7, 3] == 0 and cls["N45E014", 9, 6] == 5 and cls["N45E014", 9, 1] == 14
    row = {x.tile: x for x in got.counters.collect()}
    assert row["N45E014"].mask_cells == 110 and row["N46E014"].mask_cells == 0 and row["N46E014"].mean_dominant_pct == 0.0
    # blocks, of any size, and rows of sub-samples tell the same
    tiles = legacy.select("tile").distinct()
    sparse = sorted(landcover.natural_classes(layers, tiles, config, dense=False).collect())
    assert sorted(landcover.natural_classes(layers, tiles, config).collect()) == sparse and len(sparse) > 50
    homes = landcover.prepare_buildings(houses).unionByName(spark.createDataFrame([(9, 5.0, square(14.15, 45.13, 0.21, 0.31)), (10, 0.0, square(14.9, 45.9, 0.05, 0.05))], f"fid long, height double, rings {geometry.RINGS}"))
    rows = {(x.tile, x.r, x.c): (x.density, x.height) for x in landcover.urban_measures(homes, tiles, config, dense=False).collect()}
    for side in (32, 40):
        got_blocks = {(x.tile, x.r, x.c): (x.density, x.height) for x in landcover.urban_measures(homes, tiles, dataclasses.replace(config, block_size=side)).collect()}
        assert all(np.allclose(rows.get(k, (0, 0)), got_blocks.get(k, (0, 0)), atol=1e-9) for k in {*rows, *got_blocks}) and len(got_blocks) > 8
    wrong = dataclasses.replace(got, cells=got.cells.withColumn("legacy", F.when(F.col("inside"), 13).otherwise(F.col("legacy"))))
    with pytest.raises(qa.GateError, match="legacy_urban"):
        landcover.check(wrong)
    files = rasters.write_raster_files(landcover.outputs(got, 11, 4), str(tmp_path / "lcv"), 11, 11).collect()
    assert {x.length for x in files} == {121}
    out = landcover.write(spark, got, config, str(tmp_path / "out"))
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["doc", "lcv", "preview", "preview.vrt", "qa_by_tile.csv", "status", "status.vrt"]
    assert sorted(x.name for x in (tmp_path / "out/lcv").iterdir()) == ["N45E014.lcv", "N46E014.lcv", "landheight.dat"]
    x = rasters.read_geotiff((tmp_path / "out/preview/N45E014.tif").read_bytes())
    assert {(r, c): int(x["data"][r, c]) for r, c in np.ndindex(11, 11)} == {(r, c): v for (t, r, c), v in cls.items() if t == "N45E014"} and abs(x["gt"][0] - 13.95) < 1e-12
    assert (tmp_path / "out/lcv/N45E014.lcv").read_bytes() == x["data"].tobytes()
    codes = rasters.read_geotiff((tmp_path / "out/status/N46E014.tif").read_bytes())["data"]
    assert set(codes.ravel().tolist()) == {255} and out["report"].endswith("qa_by_tile.csv") and len((tmp_path / "out/qa_by_tile.csv").read_text().splitlines()) == 3


def test_masks(spark):
    """A boundary, its fallback, and a raster on another grid, cell by cell."""
    tiles = spark.createDataFrame([("N45E014",), ("N45E015",)], "tile string")
    shape = lambda *b: spark.createDataFrame([(i, x) for i, x in enumerate(b)], f"fid long, rings {geometry.RINGS}")
    one, two = square(14.25, 45.25, 1.0, 0.5), square(14.02, 45.03, 0.3, 0.3)
    n = 10  # arcsec 360

    def nodes(x0, y0, w, h):
        out = set()
        for tile, lon in (("N45E014", 14), ("N45E015", 15)):
            for r, c in np.ndindex(n + 1, n + 1):
                x, y = lon + c / n, 46 - r / n
                if x0 <= x < x0 + w and y0 < y <= y0 + h:
                    out.add((tile, r, c))
        return out

    got = lambda df: {(x.tile, x.r, x.c) for x in df.collect()}
    assert got(landcover.boundary_mask(spark, shape(one), shape(two), tiles, 360.0)) == nodes(14.25, 45.25, 1.0, 0.5)
    assert got(landcover.boundary_mask(spark, None, shape(two), tiles, 360.0)) == got(landcover.boundary_mask(spark, shape(one).limit(0), shape(two), tiles, 360.0)) == nodes(14.02, 45.03, 0.3, 0.3)
    with pytest.raises(ValueError):
        landcover.boundary_mask(spark, shape(one, two), shape(two), tiles, 360.0)
    values = {(0, 0): 1.0, (0, 3): 2.0, (1, 1): 0.0, (1, 2): 5.0, (2, 4): None}
    raster = spark.createDataFrame([(r, c, v) for (r, c), v in values.items()], "r int, c int, value double")
    want = set()
    for (r, c), v in values.items():
        if v:
            want |= nodes(13.83 + c * 0.37, 45.95 - (r + 1) * 0.21, 0.37, 0.21)
    assert got(landcover.warped_mask(raster, (13.83, 0.37, 45.95, 0.21), tiles, 360.0)) == want and len(want) > 10


def test_prepared_layers_are_kept(spark, tmp_path):
    config = LandCoverConfig(tiles=("N45E014",))
    land = spark.createDataFrame([(1, 1500, square(14.0, 45.0, 0.5, 0.5)), (2, 1, square(14.0, 45.0, 0.5, 0.5))], f"fid long, raba_id int, rings {geometry.RINGS}")
    first = landcover.prepared(spark, {"land_use": land}, config, str(tmp_path))
    assert [x.fid for x in first["land_use"].collect()] == [1]
    again = landcover.prepared(spark, {"land_use": land.where("fid = 2")}, config, str(tmp_path))
    assert again["land_use"].count() == 1
    assert landcover.prepared(spark, {"land_use": land.where("fid = 2")}, config, str(tmp_path), rebuild=True)["land_use"].count() == 0
    assert landcover.prepared(spark, {"land_use": land.where("fid = 2")}, dataclasses.replace(config, p70=300.0), str(tmp_path))["land_use"].count() == 0
    with pytest.raises(qa.GateError, match="no rows"):
        landcover.prepared(spark, {"land_use": land.limit(0)}, config, str(tmp_path))
    metres = geometry.reprojected(F.lit(14.5), F.lit(45.5), 15.0)
    far = spark.range(1).select(F.lit(1).cast("long").alias("fid"), F.lit(1500).alias("raba_id"), F.array(F.struct(F.lit(0).alias("ring"), F.array(metres).alias("pts"))).alias("rings"))
    point = landcover.prepared(spark, {"land_use": far}, config, str(tmp_path), lon0=15.0)["land_use"].first().rings[0].pts[0]
    assert abs(point.x - 14.5) < 1e-7 and abs(point.y - 45.5) < 1e-7


def test_feature_service(spark):
    """Pages of all regions, a page that fails once, an empty region that the gate finds."""

    def ask(query):
        region, at, n = query["where"][5:7], query["resultOffset"], query["resultRecordCount"]
        total = {"01": 7, "02": 6, "03": 0}[region]
        if region == "02" and at == 3 and not flag:
            flag.append(1)
            raise OSError("try again")
        rows = [{"properties": {"sklep": i % 3, "x": None}, "geometry": {"type": "Point", "coordinates": [i, 0]}} for i in range(at, min(at + n, total))]
        return json.dumps({"features": rows}).encode()

    flag = []
    rows, parts = vectors.read_service(spark, ask, {"sklep": "int", "x": "string"}, ("01", "02"), page=3, wait=lambda _: None)
    got = rows.cache().collect()
    assert sorted((x.region, x.fid, x.sklep, x.x) for x in got) == sorted([("01", i, i % 3, None) for i in range(7)] + [("02", i, i % 3, None) for i in range(6)])
    qa.gate_parts(parts, rows)
    _, parts = vectors.read_service(spark, ask, {"sklep": "int"}, ("01", "03"), page=3, wait=lambda _: None)
    with pytest.raises(qa.GateError, match="1 empty"):
        qa.gate_parts(parts, rows)


def test_mosaics_and_sidecars(tmp_path):
    assert rasters.write_mosaic(str(tmp_path / "m.vrt"), {}) is None
    with pytest.raises(ValueError):
        rasters.write_mosaic(str(tmp_path / "m.vrt"), {}, required=True)
    for x in ("a.bil", "a.hdr", "a.bil.aux.xml", "b.bil"):
        (tmp_path / x).write_text("x")
    assert len(rasters.remove_sidecars(str(tmp_path / "a.bil"))) == 3 and [x.name for x in tmp_path.iterdir()] == ["b.bil"]


def test_stream(spark, tmp_path):
    plan = spark.createDataFrame([("A", 0, 0), ("A", 0, 1)], "tile string, row int, col int")
    plan.write.parquet(str(tmp_path / "plans/1"))
    seen = []
    for _ in range(2):
        query = ingest.stream_chunks(spark, str(tmp_path / "plans/*"), "tile string, row int, col int", str(tmp_path / "check"), lambda df, i: seen.append(df.count()))
        query.awaitTermination(60)
    assert sum(seen) == 2
    n = ingest.ingest(plan, str(tmp_path / "m"), str(tmp_path / "o"), "f", lambda left: left.withColumn("z", F.lit(1)))
    assert n == 2 and ingest.ingest(plan, str(tmp_path / "m"), str(tmp_path / "o"), "f", lambda left: left) == 0
    assert ingest.ingested(spark, str(tmp_path / "m"), str(tmp_path / "o"), "f", ["tile", "row", "col"]).count() == 2
