"""Geometry, focal sums, fills, resampling, plans and gates against brute force."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessella import dims
from tessella.operators import blocks, fill, focal, geometry, planning, qa, resample

QUIET = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def grid_rows(a):
    return [("T", int(r), int(c), a[r, c].item()) for r, c in np.ndindex(a.shape)]


def shapes(spark, polygons):
    rows = [(i, [(k, [(float(x), float(y)) for x, y in ring]) for k, ring in enumerate(rings)]) for i, rings in enumerate(polygons)]
    return spark.createDataFrame(rows, f"fid long, rings {geometry.RINGS}")


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
            if (y1 <= y) != (y2 <= y) and x1 + (y - y1) * (x2 - x1) / (y2 - y1) <= x:
                odd = not odd
    return odd


def test_scan_conversion(spark):
    rng = np.random.default_rng(5)
    polygons = [[rng.uniform(-2, 14, (6, 2)).tolist()] for _ in range(6)] + [[[(1, 1), (9, 1), (9, 9), (1, 9)], [(3, 3), (6, 3), (6, 6), (3, 6)]]]
    got = {(x.fid, x.r, x.c) for x in geometry.scan_cells(shapes(spark, polygons), ["fid"], 11, 12).collect()}
    want = {(i, r, c) for i, rings in enumerate(polygons) for r in range(11) for c in range(12) if inside(rings, c + 0.5, r + 0.5)}
    assert got == want


def test_box_join(spark):
    rng = np.random.default_rng(6)
    polygons = [[[(x, y), (x + w, y), (x, y + w)]] for x, y, w in rng.uniform(0, 5, (40, 3))]
    boxes = [(i, a, b, a + w, b + w) for i, (a, b, w) in enumerate(rng.uniform(0, 4, (12, 3)))]
    got = geometry.box_join(spark.createDataFrame([tuple(map(float, b)) for b in boxes], "box double, west double, south double, east double, north double"), geometry.with_envelope(shapes(spark, polygons)), 0.7)
    pairs = sorted((int(x.box), x.fid) for x in got.collect())
    want = sorted((i, j) for i, w, s, e, n in boxes for j, [[(x, y), (x2, _), (_, y2)]] in enumerate(polygons) if x2 >= w and x <= e and y2 >= s and y <= n)
    assert pairs == want


def test_projection_round_trip(spark):
    df = spark.createDataFrame([(13.5, 45.2), (15.0, 46.05), (16.4, 46.8)], "lon double, lat double")
    there = df.select("lon", "lat", geometry.reprojected(F.col("lon"), F.col("lat"), 15.0).alias("p"))
    back = there.select("lon", "lat", "p", geometry.geographic(F.col("p.x"), F.col("p.y"), 15.0).alias("q")).collect()
    assert all(abs(x.q.x - x.lon) < 1e-8 and abs(x.q.y - x.lat) < 1e-8 for x in back)
    assert abs(back[1].p.x - 500_000) < 1e-6 and 99_000 < back[1].p.y < 102_000


def brute_focal(a, rows):
    out = np.zeros(a.shape)
    for r, c in np.ndindex(a.shape):
        for dr, dc, w in rows:
            if 0 <= r + dr < a.shape[0] and 0 <= c + dc < a.shape[1]:
                out[r, c] += w * a[r + dr, c + dc]
    return out


@pytest.mark.parametrize("mode", ["binary", "weighted"])
def test_focal_forms_agree(spark, mode):
    a = np.random.default_rng(1).integers(0, 4, (23, 19)).astype(float)
    rows = focal.kernel(3.3, 1.0, 0.7, mode)
    cells = spark.createDataFrame([x for x in grid_rows(a) if x[3]], "tile string, r int, c int, v double")
    want = brute_focal(a, rows)
    for got in (focal.focal_sum(cells, rows, ["v"], 23, 19), focal.focal_blocks(cells, rows, "v", 23, 19, 8)):
        out = np.zeros(a.shape)
        for x in got.collect():
            out[x.r, x.c] = x.v
        assert np.allclose(out, want)


def test_kernel():
    assert len(focal.kernel(45.0, 0.25 * 30.87 * np.cos(np.radians(45.5)), 0.25 * 30.87)) == 185
    rows = focal.kernel(45.0, 0.25 * 30.87 * np.cos(np.radians(45.5)), 0.25 * 30.87, order=400)
    assert len(rows) == 185 and sum(w == 1 for *_, w in rows) == 129 and abs(sum(w for *_, w in rows) - 152.3914) < 1e-3
    assert focal.halo(45.0, 0.25 * 30.87 * np.cos(np.radians(45.5)), 0.25 * 30.87) == (11, 8)
    area = sum(w for *_, w in focal.kernel(10.0, 1.0, 1.0))
    assert abs(area - np.pi * 100) < 0.05
    with pytest.raises(ValueError):
        focal.kernel(0, 1, 1)


def brute_fill(a, mask):
    a, todo = a.copy(), np.isin(a, (13, 14)) & mask
    while todo.any():
        new = {}
        for r, c in zip(*np.nonzero(todo)):
            near = [a[i, j] for i in range(max(0, r - 1), r + 2) for j in range(max(0, c - 1), c + 2) if (i, j) != (r, c) and i < a.shape[0] and j < a.shape[1] and 1 <= a[i, j] <= 12]
            if near:
                new[r, c] = min(set(near), key=lambda x: (-near.count(x), x))
        if not new:
            a[todo] = 10
            break
        for k, v in new.items():
            a[k], todo[k] = v, False
    return a


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fill(spark, seed):
    rng = np.random.default_rng(seed)
    a = rng.choice([0, 3, 5, 13, 14], (12, 12), p=[0.3, 0.1, 0.1, 0.25, 0.25])
    if seed == 3:
        a = np.where(rng.random(a.shape) < 0.3, 13, 0)
    mask = rng.random(a.shape) < 0.9
    df = spark.createDataFrame([("T", int(r), int(c), int(a[r, c]), bool(mask[r, c])) for r, c in np.ndindex(a.shape)], "tile string, r int, c int, cls int, inside boolean")
    got = np.zeros_like(a)
    for x in fill.fill_legacy_urban(df).collect():
        got[x.r, x.c] = x.cls
    assert (got == brute_fill(a, mask)).all()
    qa.gate_no_legacy_urban(fill.fill_legacy_urban(df))


def test_resampling(spark):
    a = np.random.default_rng(2).integers(0, 99, (9, 9))
    df = spark.createDataFrame(grid_rows(a), "tile string, r int, c int, cls int")
    at = np.rint(np.linspace(0, 8, 31)).astype(int)
    got = {(x.r, x.c): x.cls for x in resample.nearest_upsample(df, 9, 31).collect()}
    assert got == {(r, c): a[at[r], at[c]] for r in range(31) for c in range(31)}
    mean = {(x.r, x.c): x.cls for x in resample.area_mean(df, 3, "cls").collect()}
    assert mean == {(r, c): a[3 * r : 3 * r + 3, 3 * c : 3 * c + 3].sum() / 9 for r in range(3) for c in range(3)}
    assert {(x.r, x.c): x.cls for x in resample.strided(df, 4).collect()} == {(r, c): a[4 * r, 4 * c] for r in range(3) for c in range(3)}
    back = resample.merge_keys(resample.split_keys(df, 3).drop("r", "c"), 3).select(*df.columns)
    assert sorted(back.collect()) == sorted(df.collect())


def test_bilinear(spark):
    df = spark.createDataFrame([("T", r, c, None if (r, c) == (2, 2) else float(10 * r + c)) for r in range(4) for c in range(4)], "tile string, r int, c int, z double")
    points = spark.createDataFrame([(0, 1.0, 1.0), (1, 0.5, 0.5), (2, 2.4, 2.4), (3, 0.2, 1.0), (4, 3.5, 3.5)], "id int, x double, y double")
    got = {x.id: x.z for x in resample.bilinear(points, df, "id").collect()}
    assert abs(got[0] - 5.5) < 1e-12 and got[1] == 0.0 and got[2] is None and got[3] is None and got[4] is None


def test_blocks_are_cells(spark):
    a = np.random.default_rng(3).integers(0, 200, (10, 13))
    df = spark.createDataFrame(grid_rows(a), "tile string, r int, c int, cls int")
    b = blocks.to_blocks(df, 10, 13, 4)
    assert sorted(blocks.to_cells(b).collect()) == sorted(df.collect())
    rows = blocks.raster_rows(b).orderBy("r").collect()
    assert [bytes(x.data) for x in rows] == [bytes(a[i].astype(np.uint8)) for i in range(10)]


@QUIET
@given(st.integers(1, 400), st.integers(1, 13))
def test_chunks_cover(spark, pixels, n):
    got = planning.chunk_plan(spark.createDataFrame([("N45E014",)], "tile string"), pixels, n, n).where("row = 0").orderBy("col").collect()
    assert got[0].xoff == 0 and all(a.xoff + a.width == b.xoff for a, b in zip(got, got[1:])) and got[-1].xoff + got[-1].width == pixels
    assert [x.xoff for x in got] == [round(i * pixels / n) for i in range(n)]


def test_plans(spark):
    tiles = spark.createDataFrame([("N45E014",), ("N46E014",)], "tile string")
    qa.gate_seams(planning.split_plan(tiles, 32400, 4))
    with pytest.raises(ValueError):
        planning.split_plan(tiles, 10, 3)
    broken = planning.split_plan(tiles, 32400, 4).withColumn("west", F.when((F.col("row") == 1) & (F.col("col") == 2), F.col("west") + 1e-6).otherwise(F.col("west")))
    with pytest.raises(qa.GateError):
        qa.gate_seams(broken)
    side = planning.sample_side(300)
    got = sorted({x.r for x in planning.sample_places(spark, 1200, 900, side).collect()})
    assert got == sorted(set(np.linspace(0, 1199, side + 2, dtype=np.int64)[1:-1].tolist()))
    assert planning.first_seen([" n45e014", "N46E014", "N45E014"]) == ["N45E014", "N46E014"]


def test_statistics(spark):
    d = np.random.default_rng(4).normal(0, 4, 501)
    got = qa.difference_statistics(spark.createDataFrame([(float(x),) for x in d], "d double"), "d").first()
    a = abs(d)
    assert np.allclose([got.bias_m, got.mae_m, got.rmse_m, got.median_abs_m, got.p95_abs_m, got.max_abs_m, got.within_1m_pct, got.over_10m_pct], [d.mean(), a.mean(), np.sqrt((d * d).mean()), np.median(a), np.percentile(a, 95), a.max(), (a <= 1).mean() * 100, (a > 10).mean() * 100])
    assert qa.difference_statistics(spark.createDataFrame([], "d double"), "d").first().status == "NO_VALID_OVERLAP"


def test_gates(spark):
    def df(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    good = df("inside boolean, cls int, original int, status int, natural int", (True, 5, 3, 80, 5), (False, 7, 7, 255, 7))
    for gate in (qa.gate_outside_unchanged, qa.gate_class_range, qa.gate_status_partition, qa.gate_water_kept, qa.gate_no_legacy_urban):
        gate(good)
    bad = df("inside boolean, cls int, original int, status int, natural int", (True, 14, 3, 255, 0), (False, 7, 8, 9, 7), (True, 255, 1, 1, 1))
    for gate in (qa.gate_outside_unchanged, qa.gate_class_range, qa.gate_status_partition, qa.gate_water_kept, qa.gate_no_legacy_urban):
        with pytest.raises(qa.GateError):
            gate(bad)
    files = df("path string, length long", ("a", 9), ("b", 16))
    qa.gate_square(files)
    with pytest.raises(qa.GateError):
        qa.gate_file_size(files, 9)
    with pytest.raises(qa.GateError):
        qa.gate_square(df("path string, length long", ("a", 1)))
    raster = df("gt array<double>, want array<double>, srid int, width int, height int, dtype string, nodata double", ([1.0, 2.0], [1.0, 2.0 + 1e-11], 4326, 5, 5, "int16", -32768.0))
    qa.gate_geotransform(raster, 2e-11, 5, "int16", -32768.0)
    for args in ((1e-12,), (2e-11, 6), (2e-11, 5, "float32"), (2e-11, 5, "int16", 0.0)):
        with pytest.raises(qa.GateError):
            qa.gate_geotransform(raster, *args)
    manifest = df("tile string, row int, col int, fingerprint string", ("A", 0, 0, "x"))
    qa.gate_checkpoint(manifest, "x")
    with pytest.raises(qa.GateError):
        qa.gate_checkpoint(manifest, "y")
    with pytest.raises(qa.GateError):
        qa.gate_storage(manifest, df("tile string", ("B",)))
    qa.gate_parts(df("part string, n long", ("a", 1), ("b", 1)), files)
    with pytest.raises(qa.GateError):
        qa.gate_parts(df("part string, n long", ("a", 2), ("b", 0)), files)
    with pytest.raises(qa.GateError):
        qa.gate_fields(files, ["PATH", "x"])
    with pytest.raises(qa.GateError):
        qa.gate_fields(files.limit(0), ["path"])
    histogram = df(", ".join(f"n{c:02d} long" for c in range(15)), tuple(200_000 if c == 3 else 0 for c in range(15)))
    with pytest.raises(qa.GateError):
        qa.gate_forest_structure(histogram)
    assert dims.TIE_RANK[0] == 12
