"""DuckDB SQL of the queries, written from the rules, not from the Spark plans."""

from __future__ import annotations

import numpy as np

from .. import dims


def _case(key: str, mapping: dict, other: str = "NULL") -> str:
    return f"CASE {key} " + " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items()) + f" ELSE {other} END"


def _values(rows, names: str) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(repr(x) for x in r) + ")" for r in rows) + f") AS {names}"


TILES = _values([(t,) for t in dims.TILES], "t(tile)")
CORNER = "CAST(substr(tile, 2, 2) AS BIGINT) AS lat, CAST(substr(tile, 5, 3) AS BIGINT) AS lon"
RULES = _values([(c, t, dims.TIE_RANK[c]) for c, t in dims.CLASS_THRESHOLDS.items()], "rules(cls, thr, rnk)")
LEGACY = "legacy AS (SELECT 'T' || (o_orderkey // 1024) AS tile, o_orderkey % 1024 // 32 AS r, o_orderkey % 32 AS c, o_custkey % 15 AS cls, o_orderstatus <> 'P' AS inside FROM orders)"
REMAP = _case("cls", dims.LEGACY_REMAP, "cls")
SUB = """sub0 AS (SELECT 'T' || (l_orderkey // 1024) AS tile, (l_orderkey * 7 + l_linenumber * 3) % 64 AS sr, (l_partkey * 5 + l_suppkey) % 64 AS sc, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS prio, l_orderkey, l_linenumber, l_partkey FROM lineitem),
sub AS (SELECT *, CASE WHEN l_partkey % 4 = 0 THEN l_partkey % 13 ELSE ((sr // 8) * 8 + (sc // 8)) % 13 END AS cls FROM sub0),
painted AS (SELECT tile, sr, sc, max_by(cls, row(prio, l_orderkey, l_linenumber, l_partkey)) AS cls FROM sub GROUP BY 1, 2, 3)"""
NATURAL = f"""{SUB}, k AS (SELECT tile, sr // 2 AS r, sc // 2 AS c, cls, count(*) AS k FROM painted GROUP BY 1, 2, 3, 4),
m AS (SELECT tile, r, c, max_by(k.cls, row(k, rnk)) FILTER (k >= thr * 4) AS best, max(k) FILTER (k >= thr * 4) AS top, sum(k) AS n, sum(CASE WHEN k.cls = 0 THEN k ELSE 0 END) AS w, sum(CASE WHEN k.cls = 12 THEN k ELSE 0 END) AS b FROM k JOIN {RULES} ON k.cls = rules.cls GROUP BY 1, 2, 3),
{LEGACY},
g AS (SELECT tile, a.range AS r, b.range AS c FROM (SELECT DISTINCT tile FROM legacy), range(32) a, range(32) b),
nat AS (SELECT tile, r, c, coalesce(best, 255) AS cls, coalesce(top, 0) / 4.0::DOUBLE AS dominant, coalesce(n, 0) / 4.0::DOUBLE AS source, coalesce(w, 0) / 4.0::DOUBLE AS water, coalesce(b, 0) / 4.0::DOUBLE AS bare FROM g LEFT JOIN m USING (tile, r, c)),
x AS (SELECT nat.*, l.cls AS legacy, coalesce(inside, false) AS inside FROM nat LEFT JOIN legacy l USING (tile, r, c))"""
SHAPES = """tri AS (SELECT p_partkey AS fid, p_size AS height, p_partkey * 37 % 112 + 0.25::DOUBLE AS x0, p_partkey * 53 % 112 + 0.25::DOUBLE AS y0, (2 + p_size % 9)::DOUBLE AS w, (2 + p_partkey % 7)::DOUBLE AS t FROM part)"""
BURNED = f"""{SHAPES}, lines AS (SELECT *, unnest(range(greatest(0, CAST(floor(y0) AS BIGINT) - 1), least(128, CAST(ceil(y0 + t) AS BIGINT) + 1))) AS r FROM tri),
runs AS (SELECT fid, height, r, x0 AS a, x0 + (y0 + t - (r + 0.5::DOUBLE)) * w / t AS b FROM lines WHERE r + 0.5 >= y0 AND r + 0.5 < y0 + t),
cells AS (SELECT fid, height, r, unnest(range(greatest(0, CAST(ceil(a - 0.5) AS BIGINT)), least(128, CAST(ceil(b - 0.5) AS BIGINT)))) AS c FROM runs)"""
TOP = f"{BURNED}, top AS (SELECT r, c, max_by(height, fid) AS height FROM cells GROUP BY 1, 2)"
URBAN = f"{TOP}, u AS (SELECT r // 4 AS r, c // 4 AS c, count(*) / 16.0::DOUBLE AS footprint, sum(height) / 16.0::DOUBLE AS height_area, sum(CASE WHEN height > 0 THEN 1 ELSE 0 END) / 16.0::DOUBLE AS valid FROM top GROUP BY 1, 2)"
SPARSE = "sparse AS (SELECT l_orderkey % 200 AS r, l_partkey % 200 AS c, count(*)::DOUBLE AS v FROM lineitem GROUP BY 1, 2)"
ELEV = "elev AS (SELECT 'T' || (event_id // 1000) AS tile, event_id % 1000 // 25 AS r, event_id % 25 AS c, value AS z FROM events)"
BUILT = "built AS (SELECT 'T' || (l_orderkey // 1024) AS tile, l_orderkey % 1024 // 32 AS r, l_orderkey % 32 AS c, count(*)::DOUBLE AS v FROM lineitem GROUP BY 1, 2, 3)"
ARCS = _values([(x,) for x in (1.0, 0.5, 0.25, 1 / 9, 0.1, 0.7)], "a(arcsec0)")
ARC = f"arcs AS (SELECT arcsec0::DOUBLE AS arcsec FROM {ARCS})"
STANDS = "stands AS (SELECT o_orderkey AS fid, nullif(o_orderkey % 13, 12) AS phase, o_custkey % 5 AS closure, (1 + o_orderkey % 97)::DOUBLE AS area, o_totalprice * 0.01::DOUBLE * (1 + o_orderkey % 97) AS stock FROM orders)"
OFFSETS = "o AS (SELECT a.range - 1 AS dr, b.range - 1 AS dc FROM range(3) a, range(3) b WHERE a.range <> 1 OR b.range <> 1)"


def _kernel_sql(radius: float, px: float, py: float, hx: int, hy: int, order: int = 64) -> str:
    """kern (dr, dc, w): the share of each cell that a circle covers, by Gauss-Legendre quadrature along its rows."""
    nodes = _values([(float(x), float(w)) for x, w in zip(*np.polynomial.legendre.leggauss(order))], "nodes(x0, w0)")
    return f"""kc AS (SELECT a.range - {hy} AS dr, b.range - {hx} AS dc, (abs(b.range - {hx}) - 0.5::DOUBLE) * {px}::DOUBLE AS lft, (abs(b.range - {hx}) + 0.5::DOUBLE) * {px}::DOUBLE AS rgt, abs(a.range - {hy}) * {py}::DOUBLE AS mid FROM range({2 * hy + 1}) a, range({2 * hx + 1}) b),
kn AS (SELECT kc.*, w0::DOUBLE AS gw, sqrt(greatest({radius}::DOUBLE ** 2 - (mid + x0::DOUBLE * {py}::DOUBLE / 2) ** 2, 0)) AS reach FROM kc, {nodes}),
ks AS (SELECT dr, dc, lft, rgt, mid, least(greatest(sum(gw * greatest(least(rgt, reach) - greatest(lft, -reach), 0)) / 2 / {px}::DOUBLE, 0), 1) AS share FROM kn GROUP BY ALL),
kw AS (SELECT dr, dc, CASE WHEN sqrt(rgt ** 2 + (mid + {py}::DOUBLE / 2) ** 2) <= {radius} THEN 1.0::DOUBLE WHEN sqrt(greatest(lft, 0) ** 2 + greatest(mid - {py}::DOUBLE / 2, 0) ** 2) >= {radius} THEN 0.0::DOUBLE ELSE share END AS w FROM ks),
kern AS (SELECT * FROM kw WHERE w > 1e-12)"""


_CODES = [*dims.LAND_USE, 9999, 1]
_BINARY = "kern AS (SELECT r.range - 6 AS dr, c.range - 5 AS dc FROM range(13) r, range(11) c WHERE abs(r.range - 6) <= 6 AND abs(c.range - 5) <= floor(sqrt(25.0 - ((r.range - 6) * 0.8) ** 2)))"
_FOCAL = f"WITH {SPARSE}, {_BINARY} SELECT s.r - dr AS r, s.c - dc AS c, sum(v) AS v FROM sparse s, kern WHERE s.r - dr BETWEEN 0 AND 199 AND s.c - dc BETWEEN 0 AND 199 GROUP BY 1, 2"
_FOREST = "CASE " + " ".join(f"WHEN phase = {p} THEN " + (f"{a}" if a == b else f"CASE WHEN closure IN (1, 2) THEN {a} ELSE {b} END") for p, (a, b) in dims.FOREST_PHASES.items())
_STAT = lambda q: f"round(quantile_cont(abs(d), {q}), 6)"
_CHUNKS = "WITH n AS (SELECT unnest([1, 5, 7, 12]) AS n), c AS (SELECT *, {corner} FROM {tiles}), p AS (SELECT tile, lat, lon, n, a.range AS row, b.range AS col FROM c, n, range(12) a, range(12) b WHERE a.range < n AND b.range < n)"
_CHUNKS = _CHUNKS.format(corner=CORNER, tiles=TILES)
_EDGE = "CAST(round_even({} * 5143.0::DOUBLE / n::DOUBLE, 0) AS BIGINT)"
_NAMES = ["N45E014.lcv", "n46e013.LCV", "S01W002.lcv", "N45E14.lcv", "N45E014.bil", "XN45E014.lcv"]
_GOOD = r"regexp_full_match(upper(name), '[NS]\d{2}[EW]\d{3}\.LCV')"
_TILE_LIST = "[" + ", ".join(f"'{t}'" for t in dims.TILES) + "]"

def _fill_sql(rounds: int = 8) -> str:
    """The fill with its rounds written out; the grid has targets with a donor within so many."""
    out = f"WITH {LEGACY}, {OFFSETS}, s0 AS (SELECT *, inside AND cls IN (13, 14) AS todo FROM legacy)"
    for k in range(rounds):
        out += f""", n{k} AS (SELECT t.tile, t.r, t.c, l.cls, count(*) AS k FROM s{k} t, o, s{k} l WHERE t.todo AND l.tile = t.tile AND l.r = t.r + dr AND l.c = t.c + dc AND l.cls BETWEEN 1 AND 12 GROUP BY 1, 2, 3, 4),
b{k} AS (SELECT tile, r, c, max_by(cls, row(k, -cls)) AS best FROM n{k} GROUP BY 1, 2, 3), s{k + 1} AS (SELECT s.tile, s.r, s.c, coalesce(best, cls) AS cls, inside, todo AND best IS NULL AS todo FROM s{k} s LEFT JOIN b{k} b USING (tile, r, c))"""
    return out + f" SELECT tile, r, c, (CASE WHEN todo THEN 10 ELSE cls END)::BIGINT AS cls, inside FROM s{rounds}"


SQL = {
    "legacy_fill": _fill_sql(),
    "landcover_majority": f"WITH {NATURAL} SELECT tile, r, c, cls::BIGINT AS cls, dominant, source, CASE WHEN cls <> 255 THEN cls ELSE coalesce({_case('legacy', dims.LEGACY_REMAP, 'legacy')}, 255) END::BIGINT AS final FROM x",
    "landcover_blocks": f"WITH {NATURAL}, b AS (SELECT DISTINCT tile AS bt, r // 8 AS br, c // 8 AS bc FROM m) SELECT tile, r, c, cls::BIGINT AS cls FROM nat JOIN b ON tile = bt AND r // 8 = br AND c // 8 = bc",
    "class_histogram": f"WITH {NATURAL} SELECT tile, " + ", ".join(f"count(*) FILTER (inside AND cls = {c}) AS n{c:02d}" for c in range(15)) + " FROM x GROUP BY tile",
    "qa_counters": f"""WITH {NATURAL} SELECT tile, count(*) FILTER (inside) AS mask_cells, count(*) FILTER (inside AND cls <> 255) AS classified, count(*) FILTER (inside AND cls = 255 AND source > 0) AS low_support,
count(*) FILTER (inside AND cls = 255) AS fallback, count(*) FILTER (inside AND water > 0 AND water >= 0.75) AS water_eligible, count(*) FILTER (inside AND water > 0 AND water < 0.75) AS water_rejected,
count(*) FILTER (inside AND bare > 0 AND bare >= 0.75) AS bare_eligible, count(*) FILTER (inside AND bare > 0 AND bare < 0.75) AS bare_rejected,
round(coalesce(avg(dominant) FILTER (inside) * 100, 0), 6) AS mean_dominant_pct, round(coalesce(avg(source) FILTER (inside) * 100, 0), 6) AS mean_source_pct FROM x GROUP BY tile""",
    "qa_status_partition": f"""WITH {NATURAL}, s AS (SELECT CASE WHEN NOT inside THEN 255 WHEN legacy IN (13, 14) THEN 254 WHEN cls = 255 THEN 253 ELSE CAST(round_even(dominant * 100, 0) AS BIGINT) END AS code FROM x)
SELECT code::BIGINT AS code, count(*) AS n, CASE code WHEN 255 THEN 'outside' WHEN 254 THEN 'urban' WHEN 253 THEN 'fallback' ELSE 'natural' END AS status FROM s GROUP BY code""",
    "layer_precedence": f"WITH {SUB} SELECT cls, count(*) AS n, sum(sr * 64 + sc)::BIGINT AS places FROM painted GROUP BY cls",
    "recode_codes": f"SELECT * FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 AND o_custkey % 17 = 1 THEN NULL ELSE {_case(str([int(x) for x in _CODES]) + '[o_orderkey % ' + str(len(_CODES)) + ' + 1]', dims.LAND_USE)} END::BIGINT AS cls FROM orders) WHERE cls IS NOT NULL",
    "hydro_filter": "SELECT event_id, CASE event_type WHEN 'click' THEN '11,02' WHEN 'view' THEN '31,01' ELSE '34' END AS symbol, 0::BIGINT AS cls FROM events WHERE event_type IN ('click', 'view', 'purchase')",
    "building_clean": "SELECT p_partkey, (p_size % 5)::BIGINT AS stan, CASE WHEN p_retailprice - 1100 > 0 AND p_retailprice - 1100 < 300 THEN p_retailprice - 1100 ELSE 0.0 END AS height FROM part WHERE p_size % 5 IN (2, 3)",
    "forest_structure": f"WITH {STANDS}, q AS (SELECT *, CASE WHEN area > 0 THEN stock / area END AS ratio FROM stands) SELECT fid, ({_FOREST} WHEN phase = 7 THEN CASE WHEN closure IN (1, 2) OR ratio >= 900 THEN 5 ELSE 4 END ELSE CASE WHEN ratio >= 900 THEN 5 WHEN ratio >= 200 THEN 4 ELSE 2 END END)::BIGINT AS cls FROM q",
    "weighted_quantile": f"""WITH {STANDS}, v AS (SELECT stock / area AS v, sum(area) AS w FROM stands WHERE area > 0 AND stock >= 0 GROUP BY 1), r AS (SELECT v, sum(w) OVER (ORDER BY v ROWS UNBOUNDED PRECEDING) AS run, sum(w) OVER () AS total FROM v),
q AS (SELECT unnest([0.1, 0.5, 0.7, 0.95, 1.0])::DOUBLE AS q) SELECT q, round(min(v), 6) AS value FROM q JOIN r ON run >= q * total GROUP BY q""",
    "tile_parse": f"SELECT name, CASE WHEN {_GOOD} THEN CAST(substr(name, 2, 2) AS BIGINT) * CASE WHEN upper(name[1]) = 'S' THEN -1 ELSE 1 END END AS lat, CASE WHEN {_GOOD} THEN CAST(substr(name, 5, 3) AS BIGINT) * CASE WHEN upper(name[4]) = 'W' THEN -1 ELSE 1 END END AS lon FROM {_values([(x,) for x in _NAMES], 'v(name)')}",
    "tile_bounds": f"WITH c AS (SELECT tile, {CORNER} FROM {TILES}) SELECT tile, lon AS west, lat AS south, lon + 1 AS east, lat + 1 AS north FROM c",
    "grid_params": f"""WITH {ARC}, c AS (SELECT tile, {CORNER} FROM {TILES}), p AS (SELECT *, CAST(round_even(3600.0::DOUBLE / arcsec, 0) AS BIGINT) AS n FROM c, arcs)
SELECT tile, round(arcsec, 6) AS arcsec, n, n + 1 AS nodes, round(lon - 1.0::DOUBLE / n / 2, 9) AS x0, round(lat + 1 + 1.0::DOUBLE / n / 2, 9) AS y0, round(arcsec * 30.87::DOUBLE, 6) AS ns, round(arcsec * 30.87::DOUBLE * cos(radians(lat + 0.5::DOUBLE)), 6) AS ew FROM p""",
    "block_plan": "SELECT a.range // 512 AS br, b.range // 512 AS bc, a.range AS r0, b.range AS c0, least(512, 3601 - a.range) AS h, least(512, 3601 - b.range) AS w FROM range(0, 3601, 512) a, range(0, 3601, 512) b",
    "chunk_plan": f"""{_CHUNKS}, e AS (SELECT *, {_EDGE.format('row')} AS y0, {_EDGE.format('(row + 1)')} AS y1, {_EDGE.format('col')} AS x0, {_EDGE.format('(col + 1)')} AS x1 FROM p)
SELECT tile, row, col, x0 AS xoff, y0 AS yoff, x1 - x0 AS width, y1 - y0 AS height, round(lon + x0 / 5143.0::DOUBLE, 9) AS west, round(lat + 1 - y1 / 5143.0::DOUBLE, 9) AS south, round(lon + x1 / 5143.0::DOUBLE, 9) AS east, round(lat + 1 - y0 / 5143.0::DOUBLE, 9) AS north, n::BIGINT AS n FROM e""",
    "split_plan": f"""WITH n AS (SELECT unnest([1, 4, 8]) AS n), c AS (SELECT *, {CORNER} FROM {TILES}), p AS (SELECT tile, lat, lon, n, a.range AS row, b.range AS col FROM c, n, range(8) a, range(8) b WHERE a.range < n AND b.range < n)
SELECT tile, row, col, tile || '_q' || lpad(row::VARCHAR, 2, '0') || lpad(col::VARCHAR, 2, '0') AS name, col * (32400 // n) AS xoff, row * (32400 // n) AS yoff, (32400 // n)::BIGINT AS size,
lon + col / n::DOUBLE AS west, lat + 1 - (row + 1) / n::DOUBLE AS south, lon + (col + 1) / n::DOUBLE AS east, lat + 1 - row / n::DOUBLE AS north, n::BIGINT AS n FROM p""",
    "resolution_label": f"WITH {ARC} SELECT round(arcsec, 6) AS arcsec, CASE WHEN abs(1 / arcsec - round_even(1 / arcsec, 0)) < 1e-10 THEN '1over' || CAST(round_even(1 / arcsec, 0) AS BIGINT) ELSE replace(arcsec::VARCHAR || 'arcsec', '.', 'p') END AS label FROM arcs",
    "bbox_filter": f"WITH {SHAPES}, b AS (SELECT a.range * 4 + b.range AS box, b.range * 32 AS west, (b.range + 1) * 32 AS east, a.range * 32 AS south, (a.range + 1) * 32 AS north FROM range(4) a, range(4) b) SELECT box, fid FROM b JOIN tri ON x0 + w >= west AND x0 <= east AND y0 + t >= south AND y0 <= north",
    "scanline_raster": f"WITH {BURNED} SELECT r, c, count(*) AS n FROM cells GROUP BY 1, 2",
    "height_burn": f"WITH {TOP} SELECT r, c, height::BIGINT AS height FROM top",
    "area_mean_downsample": f"WITH {TOP} SELECT r // 4 AS r, c // 4 AS c, count(*) / 16.0::DOUBLE AS share FROM top GROUP BY 1, 2",
    "footprint_stats": f"WITH {URBAN} SELECT count(*) FILTER (footprint > 0) AS touched, round(sum(footprint), 6) AS equivalent, round(sum(footprint) * 100 / count(*) FILTER (footprint > 0), 6) AS coverage_pct FROM u",
    "strided_sample": f"WITH {TOP} SELECT r // 4 AS r, c // 4 AS c, height::BIGINT AS height FROM top WHERE r % 4 = 0 AND c % 4 = 0",
    "nearest_upsample": f"WITH {LEGACY} SELECT tile, a.range AS r, b.range AS c, cls FROM range(101) a, range(101) b JOIN legacy ON true WHERE CAST(round_even(a.range * (31 / 100.0::DOUBLE), 0) AS BIGINT) = legacy.r AND CAST(round_even(b.range * (31 / 100.0::DOUBLE), 0) AS BIGINT) = legacy.c",
    "bilinear_sample": f"""WITH {ELEV}, p AS (SELECT o_orderkey AS id, 'T' || (o_orderkey // 1500) AS tile, o_custkey % 231 * 0.1::DOUBLE + 0.5::DOUBLE - 0.5 AS fx, o_orderkey % 389 * 0.1::DOUBLE + 0.5::DOUBLE - 0.5 AS fy FROM orders),
f AS (SELECT id, tile, floor(fx)::BIGINT AS c0, floor(fy)::BIGINT AS r0, fx - floor(fx) AS u, fy - floor(fy) AS v FROM p)
SELECT id, round(a.z * (1 - u) * (1 - v) + b.z * u * (1 - v) + c.z * (1 - u) * v + d.z * u * v, 6) AS z FROM f LEFT JOIN elev a ON a.tile = f.tile AND a.r = r0 AND a.c = c0 LEFT JOIN elev b ON b.tile = f.tile AND b.r = r0 AND b.c = c0 + 1 LEFT JOIN elev c ON c.tile = f.tile AND c.r = r0 + 1 AND c.c = c0 LEFT JOIN elev d ON d.tile = f.tile AND d.r = r0 + 1 AND d.c = c0 + 1""",
    "quantise_elevation": "SELECT event_id, CASE WHEN event_id % 7 = 0 OR (value - 245) * 200 <= -32767.5 THEN NULL ELSE CAST(least(greatest(round_even((value - 245) * 200, 0), -32767), 32767) AS BIGINT) END AS z FROM events",
    "elevation_compare": f"""WITH {ELEV}, s AS (SELECT DISTINCT CAST(floor((a.range + 1) * (39 / 17.0::DOUBLE)) AS BIGINT) AS r, CAST(floor((b.range + 1) * (24 / 17.0::DOUBLE)) AS BIGINT) AS c FROM range(16) a, range(16) b),
x AS (SELECT n.tile, n.z - o.z AS d FROM elev n JOIN s USING (r, c) JOIN elev o ON o.tile = n.tile AND o.r = n.r AND o.c = n.c + 1)
SELECT tile, count(d) AS samples, CASE WHEN count(d) > 0 THEN 'OK' ELSE 'NO_VALID_OVERLAP' END AS status, round(avg(d), 6) AS bias_m, round(avg(abs(d)), 6) AS mae_m, round(sqrt(avg(d * d)), 6) AS rmse_m, {_STAT(0.5)} AS median_abs_m, {_STAT(0.9)} AS p90_abs_m, {_STAT(0.95)} AS p95_abs_m, {_STAT(0.99)} AS p99_abs_m, round(max(abs(d)), 6) AS max_abs_m,
round(100.0 * count(*) FILTER (abs(d) <= 1) / count(*), 6) AS within_1m_pct, round(100.0 * count(*) FILTER (abs(d) <= 2) / count(*), 6) AS within_2m_pct, round(100.0 * count(*) FILTER (abs(d) <= 5) / count(*), 6) AS within_5m_pct, round(100.0 * count(*) FILTER (abs(d) > 10) / count(*), 6) AS over_10m_pct FROM x GROUP BY tile""",
    "focal_binary": _FOCAL,
    "focal_block": _FOCAL,
    "focal_box": f"WITH {SPARSE} SELECT a.r, a.c, sum(b.v) AS box FROM sparse a JOIN sparse b ON a.r = b.r AND b.c BETWEEN a.c - 3 AND a.c + 3 GROUP BY 1, 2",
    "focal_weighted": f"""WITH {URBAN}, {_kernel_sql(2.5, 1.0, 0.8, 5, 6)}, s AS (SELECT u.r - dr AS r, u.c - dc AS c, sum(footprint * w) AS f, sum(height_area * w) AS h, sum(valid * w) AS v FROM u, kern WHERE u.r - dr BETWEEN 0 AND 31 AND u.c - dc BETWEEN 0 AND 31 GROUP BY 1, 2)
SELECT r, c, round(least(greatest(f / (SELECT sum(w) FROM kern), 0), 1), 6) AS density, round(CASE WHEN v > 1e-6 THEN h / v ELSE 0 END, 6) AS height FROM s""",
    "urban_classify": f"""WITH {LEGACY}, {BUILT}, j AS (SELECT l.tile, l.r, l.c, cls, inside, coalesce(v % 8 / 16, 0) AS d, coalesce(v * 3 % 25, 0) AS h FROM legacy l LEFT JOIN built s USING (tile, r, c)),
t AS (SELECT *, d >= 0.1375 AND h >= 17 AS hi_tall, d >= 0.27 AND h >= 11 AS hi_dense FROM j) SELECT tile, r, c, CASE WHEN inside AND cls <> 0 AND (hi_tall OR hi_dense) THEN 14 WHEN inside AND cls <> 0 AND d >= 0.0725 THEN 13 ELSE cls END::BIGINT AS cls, hi_tall, hi_dense FROM t""",
    "neighbour_count": f"WITH {LEGACY}, {OFFSETS} SELECT tile, r + dr AS r, c + dc AS c, count(*) AS n FROM legacy, o WHERE cls = 5 GROUP BY 1, 2, 3",
    "legacy_fill_round": f"""WITH {LEGACY}, {OFFSETS}, t AS (SELECT tile, r, c FROM legacy WHERE inside AND cls IN (13, 14)), n AS (SELECT t.tile, t.r, t.c, l.cls, count(*) AS k FROM t, o, legacy l WHERE l.tile = t.tile AND l.r = t.r + dr AND l.c = t.c + dc AND l.cls BETWEEN 1 AND 12 GROUP BY 1, 2, 3, 4)
SELECT tile, r, c, max_by(cls, row(k, -cls))::BIGINT AS cls FROM n GROUP BY 1, 2, 3""",
    "legacy_remap": f"WITH {LEGACY} SELECT tile, r, c, ({REMAP})::BIGINT AS cls FROM legacy",
    "rf_profile": f"SELECT cls::BIGINT AS cls, h || ',' || d AS line FROM {_values([(c, h, d) for c, (h, d) in dims.RF_PROFILE.items()], 'v(cls, h, d)')}",
    "rf_heights": f"WITH {LEGACY} SELECT legacy.cls, count(*) AS n, sum(h)::BIGINT AS height, sum(d)::BIGINT AS density FROM legacy JOIN {_values([(c, h, d) for c, (h, d) in dims.RF_PROFILE.items()], 'v(cls, h, d)')} ON v.cls = legacy.cls GROUP BY 1",
    "split_lossless": "SELECT 'T' || (event_id // 1000) AS tile, event_id % 1000 // 25 // 10 AS piece_row, event_id % 25 // 10 AS piece_col, count(*) AS compared, count(*) FILTER (event_id % 1000 // 25 % 10 = 3 AND event_id % 25 % 10 = 3 AND (value - 245) * 200 > -32767.5) AS mismatches, coalesce(max(CASE WHEN (value - 245) * 200 > -32767.5 THEN CASE WHEN event_id % 1000 // 25 % 10 = 3 AND event_id % 25 % 10 = 3 THEN 1 ELSE 0 END END), 0)::BIGINT AS max_abs FROM events GROUP BY 1, 2, 3",
    "seam_check": f"""WITH c AS (SELECT tile, {CORNER} FROM {TILES}), p AS (SELECT tile, a.range AS row, b.range AS col, lon + b.range * 8100 / 32400.0::DOUBLE AS west, lon + (b.range + 1) * 8100 / 32400.0::DOUBLE AS east, lat + 1 - (a.range + 1) * 8100 / 32400.0::DOUBLE AS south, lat + 1 - a.range * 8100 / 32400.0::DOUBLE AS north FROM c, range(4) a, range(4) b)
SELECT a.tile, a.row, a.col, 'right' AS side, abs(b.west - a.east) < 1e-12 AS closed FROM p a JOIN p b ON b.tile = a.tile AND b.row = a.row AND b.col = a.col + 1 UNION ALL SELECT a.tile, a.row, a.col, 'below', abs(b.north - a.south) < 1e-12 FROM p a JOIN p b ON b.tile = a.tile AND b.col = a.col AND b.row = a.row + 1""",
    "resume_anti_join": f"""WITH d AS (SELECT DISTINCT {_TILE_LIST}[event_id % 8 + 1] AS tile, event_id // 8 % 12 AS row, event_id // 96 % 12 AS col FROM events WHERE event_id % 1152 % 5 <> 0)
SELECT tile, a.range AS row, b.range AS col FROM {TILES}, range(12) a, range(12) b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.tile = t.tile AND d.row = a.range AND d.col = b.range)""",
    "layer_catalog_pick": "SELECT '/d/' || n_name AS path, 'layer' AS layer, (n_regionkey * 10)::BIGINT AS n, length(n_name)::BIGINT AS size FROM nation WHERE n_nationkey % 3 = 0 ORDER BY n_regionkey DESC, length(n_name) DESC, n_name LIMIT 1",
    "selected_tiles": f"SELECT DISTINCT tile FROM {TILES} WHERE tile IN (SELECT {_TILE_LIST[:-1]}, 'N47E014'][n_nationkey % 9 + 1] FROM nation) ORDER BY tile",
    "sample_places": "SELECT CAST(floor((a.range + 1) * (1199 / 65.0::DOUBLE)) AS BIGINT) AS r, CAST(floor((b.range + 1) * (899 / 65.0::DOUBLE)) AS BIGINT) AS c FROM range(64) a, range(64) b",
    "mask_nearest": f"WITH {LEGACY} SELECT tile, a.range AS r, sum(inside::INT)::BIGINT AS inside, count(*) AS n FROM range(63) a, range(63) b, legacy WHERE CAST(round_even(a.range * (31 / 62.0::DOUBLE), 0) AS BIGINT) = legacy.r AND CAST(round_even(b.range * (31 / 62.0::DOUBLE), 0) AS BIGINT) = legacy.c GROUP BY 1, 2",
    "pixels": f"WITH {ARC} SELECT round(arcsec, 6) AS arcsec, CAST(round_even(3600.0::DOUBLE / arcsec, 0) AS BIGINT) AS pixels FROM arcs",
}
