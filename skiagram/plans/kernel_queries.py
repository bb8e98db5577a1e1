"""Named queries that run the frame kernel's steps on small images and rings made from arrays, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiagram.config import Threshold
from skiagram.operators import polygons, schema
from skiagram.plans import adapters as A
from skiagram.plans.catalog import query, rounded

LONG, REAL = schema.LONG, schema.REAL
POINT = schema.of(k=LONG, v=REAL)

#: px: pixels with row and column; st: the staircase mask; off: its other pixels.
PX = A.TILES_SQL + ", px AS (SELECT vec_id, k, k // 8 AS r, k % 8 AS c, v FROM pixels)"
ST = PX + """, high AS (SELECT vec_id, c, greatest(least(floor(v * 4) - 1, 8), 1) AS h FROM px WHERE r = 0),
st AS (SELECT px.* FROM px JOIN high USING (vec_id, c) WHERE r < h), off AS (SELECT px.* FROM px JOIN high USING (vec_id, c) WHERE r >= h)"""
DARK = A.TILES_SQL + ", dark AS (SELECT vec_id, k, k // 8 AS r, k % 8 AS c FROM tiles WHERE p < 1), light AS (SELECT vec_id, k, k // 8 AS r, k % 8 AS c FROM tiles WHERE p >= 1)"
GRADIENT = """slopes AS (SELECT a.vec_id, a.k, a.r, a.c, sqrt(pow(sum(dr * (2 - abs(dc)) * b.v) / 8, 2) + pow(sum(dc * (2 - abs(dr)) * b.v) / 8, 2)) / sqrt(2) AS g
  FROM px a CROSS JOIN (SELECT i AS dr FROM range(-1, 2) t(i)) CROSS JOIN (SELECT i AS dc FROM range(-1, 2) t(i))
  JOIN px b ON b.vec_id = a.vec_id AND b.r = greatest(least(a.r + dr, 7), 0) AND b.c = greatest(least(a.c + dc, 7), 0) GROUP BY ALL)"""
DEPTH = """depth AS (SELECT s.vec_id, s.k, least(min(s.r) + 1, min(s.c) + 1, 8 - min(s.r), 8 - min(s.c), coalesce(min(abs(s.r - o.r) + abs(s.c - o.c)), 99)) AS d
  FROM st s LEFT JOIN off o ON s.vec_id = o.vec_id GROUP BY ALL UNION ALL
  SELECT o.vec_id, o.k, -min(abs(s.r - o.r) + abs(s.c - o.c)) FROM off o JOIN st s ON s.vec_id = o.vec_id GROUP BY ALL)"""


def _tiles(spark: SparkSession, sf_dir: str, measure, shape) -> DataFrame:
    return polygons.per_tile(A.tiles(spark, sf_dir), "vec_id", 8, measure, shape)


@query(f"WITH {PX} SELECT vec_id, k, round(CAST(CAST(v / median(v) OVER (PARTITION BY vec_id) AS FLOAT) AS DOUBLE), 6) AS p FROM px")
def tile_flatfield(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.flat, schema.of(k=LONG, p=REAL)), 6)


@query(f"WITH {PX}, wide AS (SELECT a.vec_id, a.k, a.r, a.c, max(b.v) AS v FROM px a JOIN px b ON a.vec_id = b.vec_id AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY ALL) SELECT a.vec_id, a.k, round(min(b.v), 6) AS v FROM wide a JOIN wide b ON a.vec_id = b.vec_id AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.vec_id, a.k")
def tile_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.closing(3), POINT), 6)


@query(f"WITH {A.TILES_SQL}, o AS (SELECT vec_id, count(*) FILTER (WHERE p < 0.85) AS n, quantile_cont(p, 0.05) FILTER (WHERE p < 0.85) AS core, min(p) AS low FROM tiles GROUP BY vec_id), l AS (SELECT vec_id, CASE WHEN n < 3 THEN low - 1 ELSE core + 0.5 * (1 - core) END AS level FROM o) SELECT vec_id, round(level, 6) AS level, count(*) FILTER (WHERE p < level) AS n_foreground, count(*) FILTER (WHERE p < level AND (k % 8 IN (0, 7) OR k // 8 IN (0, 7))) AS n_border FROM tiles JOIN l USING (vec_id) GROUP BY ALL")
def tile_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = polygons.threshold(Threshold(min_object_depth=0.15), 3)
    return rounded(_tiles(spark, sf_dir, level, schema.of(level=REAL, n_foreground=LONG, n_border=LONG)), 6)


@query(f"WITH RECURSIVE {DARK}, reach AS (SELECT vec_id, k AS a, k AS b FROM dark UNION SELECT x.vec_id, x.a, n.k FROM reach x JOIN dark m ON m.vec_id = x.vec_id AND m.k = x.b JOIN dark n ON n.vec_id = x.vec_id AND abs(n.r - m.r) <= 1 AND abs(n.c - m.c) <= 1), parts AS (SELECT vec_id, root, count(*) AS n FROM (SELECT vec_id, a, min(b) AS root FROM reach GROUP BY ALL) GROUP BY ALL HAVING count(*) >= 3) SELECT e.vec_id, count(root) AS n_parts, CAST(coalesce(max(n), 0) AS BIGINT) AS largest, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_pixels FROM embeddings e LEFT JOIN parts USING (vec_id) GROUP BY ALL")
def tile_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark, sf_dir, polygons.parts(3), schema.of(n_parts=LONG, largest=LONG, n_pixels=LONG))


@query(f"WITH RECURSIVE {DARK}, open AS (SELECT vec_id, k, r, c FROM light WHERE r IN (0, 7) OR c IN (0, 7) UNION SELECT n.vec_id, n.k, n.r, n.c FROM open x JOIN light n ON n.vec_id = x.vec_id AND abs(n.r - x.r) + abs(n.c - x.c) = 1) SELECT e.vec_id, (SELECT count(*) FROM dark d WHERE d.vec_id = e.vec_id) AS n_dark, 64 - (SELECT count(*) FROM open o WHERE o.vec_id = e.vec_id) AS n_filled FROM embeddings e")
def tile_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark, sf_dir, polygons.filled, schema.of(n_dark=LONG, n_filled=LONG))


@query(f"WITH {PX}, {GRADIENT} SELECT vec_id, k, round(g, 6) AS v FROM slopes")
def tile_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.gradient, POINT), 6)


@query(f"WITH {PX}, n AS (SELECT vec_id, k, v, lead(v, 1) OVER w AS right_v, lead(v, 8) OVER w AS below, lead(v, 9) OVER w AS diagonal FROM px WINDOW w AS (PARTITION BY vec_id ORDER BY k)) SELECT vec_id, k, round(0.5 * (0.75 * v + 0.25 * right_v) + 0.5 * (0.75 * below + 0.25 * diagonal), 6) AS v FROM n WHERE k % 8 < 7 AND k < 56")
def tile_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.between, POINT).filter("k % 8 < 7 and k < 56"), 6)


@query(f"WITH {ST}, {DEPTH} SELECT vec_id, k, CAST(d AS BIGINT) AS depth FROM depth")
def mask_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark, sf_dir, polygons.depth, schema.of(k=LONG, depth=LONG))


@query(f"WITH {ST}, m AS (SELECT vec_id, var_pop(c) AS a, -covar_pop(r, c) AS b, var_pop(r) AS d, count(*) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1)) AS extent FROM st GROUP BY vec_id), e AS (SELECT *, greatest((a + d + sqrt(pow(a - d, 2) + 4 * b * b)) / 2, 0) AS big, greatest((a + d - sqrt(pow(a - d, 2) + 4 * b * b)) / 2, 0) AS small FROM m) SELECT vec_id, round(4 * sqrt(big), 4) AS major, round(4 * sqrt(small), 4) AS minor, round(sqrt(1 - small / big), 4) AS eccentricity, round(CASE WHEN abs(a - d) < 1e-12 THEN 0 ELSE (d - a) / sqrt(pow(d - a, 2) + 4 * b * b) END, 4) + 0.0 AS cos_2t, round(CASE WHEN abs(a - d) < 1e-12 THEN CASE WHEN b < 0 THEN -1 ELSE 1 END ELSE -2 * b / sqrt(pow(d - a, 2) + 4 * b * b) END, 4) + 0.0 AS sin_2t, round(extent, 4) AS extent FROM e")
def mask_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tiles(spark, sf_dir, polygons.moments, schema.of(major=REAL, minor=REAL, eccentricity=REAL, orientation=REAL, extent=REAL))
    rows = rounded(rows.withColumns({"cos_2t": F.cos(2 * F.col("orientation")), "sin_2t": F.sin(2 * F.col("orientation"))}).drop("orientation"))
    return rows.withColumns({"cos_2t": F.col("cos_2t") + 0.0, "sin_2t": F.col("sin_2t") + 0.0})  # no minus zero


NEAR = "(SELECT count(*) FROM {t} n WHERE n.vec_id = s.vec_id AND {on})"


@query(
    f"WITH {ST}, turns AS (SELECT vec_id, {', '.join('1 - ' + NEAR.format(t='st', on=f'n.r = s.r + {dr} AND n.c = s.c + {dc}') + f' AS {n}' for n, dr, dc in (('w', 0, -1), ('n', -1, 0), ('nw', -1, -1), ('ne', -1, 1)))} FROM st s), "
    f"rim AS (SELECT * FROM st s WHERE {NEAR.format(t='st', on='abs(n.r - s.r) + abs(n.c - s.c) = 1')} < 4), "
    f"codes AS (SELECT vec_id, 1 + 2 * {NEAR.format(t='rim', on='abs(n.r - s.r) + abs(n.c - s.c) = 1')} + 10 * {NEAR.format(t='rim', on='abs(n.r - s.r) = 1 AND abs(n.c - s.c) = 1')} AS code FROM rim s), "
    "a AS (SELECT vec_id, round(pi() / 4 * (sum(w) + sum(n) + (sum(nw) + sum(ne)) / sqrt(2)), 4) AS crofton FROM turns GROUP BY vec_id), "
    "b AS (SELECT vec_id, round(count(*) FILTER (WHERE code IN (5, 7, 15, 17, 25, 27)) + sqrt(2) * count(*) FILTER (WHERE code IN (21, 33)) + (1 + sqrt(2)) / 2 * count(*) FILTER (WHERE code IN (13, 23)), 4) AS chain FROM codes GROUP BY vec_id) "
    "SELECT vec_id, crofton, chain FROM a JOIN b USING (vec_id)"
)
def mask_perimeters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.perimeters, schema.of(crofton=REAL, chain=REAL)))


@query(
    f"WITH {ST}, {DEPTH}, {GRADIENT}, z AS (SELECT vec_id, k, v, d, g FROM px JOIN depth USING (vec_id, k) JOIN slopes USING (vec_id, k)), "
    "g AS (SELECT vec_id, avg(v) FILTER (WHERE d > 0) AS core, coalesce(avg(v) FILTER (WHERE d < 0 AND d >= -5), avg(v) FILTER (WHERE d < 0), avg(v)) AS bg, avg(g) FILTER (WHERE abs(d) <= 3) AS slope, count(*) FILTER (WHERE d > 0) AS n FROM z GROUP BY vec_id) "
    "SELECT vec_id, round((bg - core) / bg, 6) AS contrast, round(slope, 6) AS edge_gradient, round(slope / bg, 6) AS edge_gradient_norm, round(2 * sqrt(n / pi()), 6) AS ecd_px FROM g"
)
def edge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.edge_metrics, schema.of(contrast=REAL, edge_gradient=REAL, edge_gradient_norm=REAL, ecd_px=REAL)), 6)


@query(f"WITH {PX}, run AS (SELECT vec_id, r, c, sum(v) OVER (PARTITION BY vec_id, r ORDER BY c) AS s FROM px), p AS (SELECT *, lag(s) OVER (PARTITION BY vec_id, r ORDER BY c) AS was FROM run) SELECT vec_id, r, round(CASE WHEN max(s) <= 4.2 THEN 7 WHEN min(s) > 4.2 THEN 0 ELSE max(c - 1 + (4.2 - was) / (s - was)) FILTER (WHERE s > 4.2 AND was <= 4.2) END, 6) AS reached FROM p GROUP BY ALL")
def profile_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_tiles(spark, sf_dir, polygons.reaches(4.2), schema.of(r=LONG, reached=REAL)), 6)


def _rings(spark: SparkSession, sf_dir: str, measure, shape, rings: DataFrame | None = None) -> DataFrame:
    return polygons.per_ring(A.rings(spark, sf_dir) if rings is None else rings, "vec_id", measure, shape)


RG = A.RINGS_SQL
SIDE = "sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y))"


@query(f"WITH {RG} SELECT vec_id, k, round(sum({SIDE}) OVER (PARTITION BY vec_id ORDER BY k), 4) AS arc_px FROM edges")
def boundary_arc_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rings(spark, sf_dir, polygons.arc, schema.of(k=LONG, arc_px=REAL)))


@query(f"WITH {RG} SELECT vec_id, round(sum(x * ny - nx * y) / 2, 4) AS area, round(sum({SIDE}), 4) AS length, round(sum((x + nx) * (x * ny - nx * y)) / (3 * sum(x * ny - nx * y)), 4) AS x, round(sum((y + ny) * (x * ny - nx * y)) / (3 * sum(x * ny - nx * y)), 4) AS y FROM edges GROUP BY vec_id")
def ring_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rings(spark, sf_dir, polygons.geometry, schema.of(area=REAL, length=REAL, x=REAL, y=REAL)))


MEASURES = ("area_um2", "ecd_um", "perimeter_um", "circularity", "solidity", "convexity", "feret_max_um", "feret_min_um")


@query(
    f"WITH {RG}, own AS (SELECT vec_id, abs(sum(x * ny - nx * y)) / 2 AS a, sum({SIDE}) AS l FROM edges GROUP BY vec_id), "
    "pairs AS (SELECT a.vec_id, a.k AS i, b.k AS j, a.x AS ax, a.y AS ay, b.x AS bx, b.y AS byy, sqrt(pow(b.x - a.x, 2) + pow(b.y - a.y, 2)) AS far FROM points a JOIN points b ON a.vec_id = b.vec_id AND a.k <> b.k), "
    "o AS (SELECT p.vec_id, i, j, ax, ay, bx, byy, far, min(((bx - ax) * (c.y - ay) - (byy - ay) * (c.x - ax)) / far) AS low, max(((bx - ax) * (c.y - ay) - (byy - ay) * (c.x - ax)) / far) AS high FROM pairs p JOIN points c ON p.vec_id = c.vec_id GROUP BY ALL), "
    "h AS (SELECT vec_id, sum(ax * byy - bx * ay) / 2 AS ha, sum(far) AS hl, min(high) AS narrow FROM o WHERE low >= -1e-9 GROUP BY vec_id), w AS (SELECT vec_id, max(far) AS wide FROM pairs GROUP BY vec_id) "
    "SELECT vec_id, round(4 * a, 3) AS area_um2, round(4 * sqrt(a / pi()), 3) AS ecd_um, round(2 * l, 3) AS perimeter_um, round(4 * pi() * a / (l * l), 3) AS circularity, round(a / ha, 3) AS solidity, round(hl / l, 3) AS convexity, round(2 * wide, 3) AS feret_max_um, round(2 * narrow, 3) AS feret_min_um FROM own JOIN h USING (vec_id) JOIN w USING (vec_id)"
)
def polygon_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rings(spark, sf_dir, polygons.measures(2.0, MEASURES), schema.of(**dict.fromkeys(MEASURES, REAL))), 3)


@query(f"WITH {RG}, cuts AS (SELECT vec_id, r, ceil(x + (r - y) / (ny - y) * (nx - x)) AS cut FROM edges, range(128) t(r) WHERE y <> ny AND r >= least(y, ny) AND r < greatest(y, ny)), o AS (SELECT *, row_number() OVER (PARTITION BY vec_id, r ORDER BY cut) AS n FROM cuts) SELECT vec_id, CAST(sum(CASE WHEN n % 2 = 0 THEN cut ELSE -cut END) AS BIGINT) AS n_pixels FROM o GROUP BY vec_id")
def polygon_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rings(spark, sf_dir, polygons.raster_area(128), schema.of(n_pixels=LONG))


@query(f"WITH {RG} SELECT vec_id, count(*) AS n_points, round(abs(sum(x * ny - nx * y)) / 2, 4) AS area FROM edges GROUP BY vec_id")
def outline_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_rings(spark, sf_dir, polygons.written, schema.of(n_points=LONG, area=REAL)))


@query(f"WITH {RG}, f AS (SELECT vec_id, x AS w FROM points WHERE k = 0), g AS (SELECT vec_id, y AS h FROM points WHERE k = 16) SELECT vec_id, CAST(3 AS BIGINT) AS n_points, round(w * h / 4, 2) AS area FROM f JOIN g USING (vec_id)")
def outline_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings like a bow tie: what is left is one of the two loops."""
    w, h, zero = F.get("xs", F.lit(0)), F.get("ys", F.lit(16)), F.lit(0.0)
    ties = A.rings(spark, sf_dir).select("vec_id", F.array(zero, w, w, zero).alias("xs"), F.array(zero, h, zero, h).alias("ys"))
    return rounded(_rings(spark, sf_dir, polygons.mended, schema.of(n_points=LONG, area=REAL), ties), 2)
