"""Curve queries: an order is a curve, its line items are the points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curves
from .registry import query

CURVES = """(SELECT l_orderkey AS curve, CAST(l_linenumber AS BIGINT) * 100000000000 + l_partkey * 10000 + l_suppkey AS seq,
  l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem)"""


def points(t):
    return t("lineitem").select(
        F.col("l_orderkey").alias("curve"),
        (F.col("l_linenumber").cast("long") * 100000000000 + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"),
        F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))


_LENGTH = f"""(SELECT curve, coalesce(sum(sqrt(pow(x - px, 2) + pow(y - py, 2))), 0) AS length FROM
  (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM {CURVES} WINDOW w AS (PARTITION BY curve ORDER BY seq)) GROUP BY curve)"""


@query("i01_length", f"SELECT curve, round(length, 6) AS length FROM {_LENGTH}")
def _(t):
    return curves.length(points(t), "curve")


_SHAPE = f"(SELECT curve, x, max(y) - min(y) AS thickness, (max(y) + min(y)) / 2 AS camber FROM {CURVES} GROUP BY curve, x)"


@query("i02_thickness_camber", f"SELECT curve, x, round(thickness, 6) AS thickness, round(camber, 6) AS camber FROM {_SHAPE}")
def _(t):
    return curves.thickness_camber(points(t), "curve")


_PROP = f"""(SELECT curve, chord, max_thickness, max_camber, length, max_thickness / nullif(chord, 0) AS thickness_to_chord, length / nullif(chord, 0) AS aspect_ratio
  FROM (SELECT curve, max(x) - min(x) AS chord, max(thickness) AS max_thickness, max(camber) AS max_camber FROM {_SHAPE} GROUP BY curve) JOIN {_LENGTH} USING (curve))"""
_PROP_COLS = "curve, chord, round(max_thickness, 6) AS max_thickness, round(max_camber, 6) AS max_camber, round(length, 6) AS length, round(thickness_to_chord, 4) AS thickness_to_chord, round(aspect_ratio, 4) AS aspect_ratio"


def ratios_rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("thickness_to_chord", "aspect_ratio")})


@query("i03_proportions", f"SELECT {_PROP_COLS} FROM {_PROP}")
def _(t):
    return ratios_rounded(curves.proportions(points(t), "curve"))


@query("i04_leading_radius")
def _(t):
    return curves.leading_radius(points(t), "curve")


_ANGLE = f"""(SELECT curve, CASE WHEN regr_count(y, x) > 1 AND regr_sxx(y, x) > 0 THEN degrees(atan(regr_slope(y, x))) END AS trailing_angle FROM (
  SELECT *, row_number() OVER (PARTITION BY curve ORDER BY x DESC, seq DESC) AS r FROM {CURVES}) WHERE r <= 5 GROUP BY curve)"""


@query("i05_trailing_angle", f"SELECT curve, round(trailing_angle, 6) AS trailing_angle FROM {_ANGLE}")
def _(t):
    return curves.trailing_angle(points(t), "curve")


@query("i06_geometry", f"SELECT {_PROP_COLS}, round(trailing_angle, 6) AS trailing_angle FROM {_PROP} JOIN {_ANGLE} USING (curve)")
def _(t):
    return ratios_rounded(curves.geometry(points(t), "curve").drop("leading_radius"))


@query("i06_distributions", f"""
SELECT curve, row_number() OVER w AS place, x, round(thickness, 6) AS thickness, round(camber, 6) AS camber,
  round(coalesce((row_number() OVER w - 1) * 1.0 / nullif(count(*) OVER (PARTITION BY curve) - 1, 0), 0), 6) AS normalised_chord
FROM {_SHAPE} WINDOW w AS (PARTITION BY curve ORDER BY x)""")
def _(t):
    return curves.distributions(points(t), "curve")


@query("i07_point_outliers", f"""
SELECT curve, seq, x, y, round(zx, 6) AS zx, round(zy, 6) AS zy FROM (SELECT curve, seq, x, round(y, 6) AS y,
  abs(x - avg(x) OVER w) / nullif(stddev_pop(x) OVER w, 0) AS zx, abs(y - avg(y) OVER w) / nullif(stddev_pop(y) OVER w, 0) AS zy
  FROM {CURVES} WINDOW w AS (PARTITION BY curve)) WHERE zx > 2.2 OR zy > 2.2""")
def _(t):
    return curves.point_outliers(points(t), "curve", 2.2)


@query("i08_scale_x", f"""
SELECT curve, seq, round((x - min(x) OVER w) / nullif(max(x) OVER w - min(x) OVER w, 0), 6) AS x, round(y, 6) AS y FROM {CURVES} WINDOW w AS (PARTITION BY curve)""")
def _(t):
    return curves.scale_x(points(t), "curve")


_NORM = f"""(SELECT curve, seq, (x - lx) / d AS x, (y - ly) / d AS y FROM (SELECT *, sqrt(pow(rx - lx, 2) + pow(ry - ly, 2)) AS d FROM (
  SELECT *, first_value(x) OVER l AS lx, first_value(y) OVER l AS ly, first_value(x) OVER r AS rx, first_value(y) OVER r AS ry, count(*) OVER (PARTITION BY curve) AS n
  FROM {CURVES} WINDOW l AS (PARTITION BY curve ORDER BY x, seq), r AS (PARTITION BY curve ORDER BY x DESC, seq))) WHERE n >= 2 AND d > 0)"""


@query("i08_normalise", f"SELECT curve, seq, round(x, 6) AS x, round(y, 6) AS y FROM {_NORM}")
def _(t):
    return curves.normalise(points(t), "curve")


_SCALED = f"(SELECT curve, seq, (x - min(x) OVER w) / nullif(max(x) OVER w - min(x) OVER w, 0) AS x, y FROM {CURVES} WINDOW w AS (PARTITION BY curve))"


@query("i09_curve_format", f"""
SELECT curve, format, CAST(CASE WHEN format NOT IN ('closed', 'unordered') THEN 0.00001 END AS DOUBLE) AS tolerance, direction FROM (
  SELECT curve, CASE WHEN closed THEN 'closed' WHEN r >= 2 AND l >= 2 THEN 'split' WHEN r >= 2 OR l >= 2 THEN 'partial_split' ELSE 'unordered' END AS format,
    CASE WHEN ri < li THEN 'LE_to_TE' ELSE 'TE_to_LE' END AS direction FROM (
    SELECT curve, abs(min_by(x, seq) - max_by(x, seq)) <= 1e-4 + 1e-5 * abs(max_by(x, seq)) AND abs(min_by(y, seq) - max_by(y, seq)) <= 1e-4 + 1e-5 * abs(max_by(y, seq)) AS closed,
      count(*) FILTER (abs(x - 1) < 1e-5) AS r, count(*) FILTER (abs(x) < 1e-5) AS l,
      min(seq) FILTER (x = mx) AS ri, min(seq) FILTER (x = mn) AS li FROM (SELECT *, max(x) OVER (PARTITION BY curve) AS mx, min(x) OVER (PARTITION BY curve) AS mn FROM {_SCALED}) GROUP BY curve))""", digits=None)
def _(t):
    return curves.curve_format(curves.scale_x(points(t), "curve"), "curve")


@query("i10_close", f"""
SELECT curve, seq, x, round(y, 6) AS y FROM {CURVES} UNION ALL
SELECT curve, max(seq) + 1, min_by(x, seq), round(min_by(y, seq), 6) FROM {CURVES} GROUP BY curve
HAVING NOT (abs(min_by(x, seq) - max_by(x, seq)) <= 1e-6 + 1e-5 * abs(max_by(x, seq)) AND abs(min_by(y, seq) - max_by(y, seq)) <= 1e-6 + 1e-5 * abs(max_by(y, seq)))""")
def _(t):
    return curves.close(points(t), "curve")


@query("i11_simplify", f"""
SELECT curve, seq, x, round(y, 6) AS y FROM (SELECT *, ((x - px) * (nx - x) + (y - py) * (ny - y)) / nullif(sqrt(pow(x - px, 2) + pow(y - py, 2)) * sqrt(pow(nx - x, 2) + pow(ny - y, 2)), 0) AS c
  FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM {CURVES} WINDOW w AS (PARTITION BY curve ORDER BY seq)))
WHERE px IS NULL OR nx IS NULL OR acos(greatest(-1, least(1, c))) > 1.5""")
def _(t):
    return curves.simplify(points(t), "curve", 1.5)


_IDX = f"(SELECT curve, seq, x, y, row_number() OVER (PARTITION BY curve ORDER BY seq) AS i FROM {CURVES})"


@query("i12_reorder_unordered", f"""
WITH e AS (SELECT *, first_value(i) OVER (PARTITION BY curve ORDER BY x DESC, i) AS r, first_value(i) OVER (PARTITION BY curve ORDER BY x, i) AS l FROM {_IDX}),
m AS (SELECT *, avg(CASE WHEN i <> r AND i <> l THEN y END) OVER (PARTITION BY curve) AS mid FROM e),
p AS (SELECT curve, x, y, 0 AS a, 0 AS b, 0 AS c FROM m WHERE i = r UNION ALL SELECT curve, x, y, 4, 0, 0 FROM m WHERE i = r
  UNION ALL SELECT curve, x, y, 2, 0, 0 FROM m WHERE i = l
  UNION ALL SELECT curve, x, y, a, CASE WHEN a = 1 THEN -x ELSE x END, CASE WHEN r < l THEN i ELSE -i END FROM (
    SELECT *, CASE WHEN (y >= mid) = (r < l) THEN 1 ELSE 3 END AS a FROM m WHERE i <> r AND i <> l))
SELECT curve, row_number() OVER (PARTITION BY curve ORDER BY a, b, c) AS seq, x, round(y, 6) AS y FROM p""")
def _(t):
    return curves.reorder_unordered(points(t), "curve")


@query("i12_reorder")
def _(t):
    return curves.reorder(curves.scale_x(points(t), "curve").dropna(), "curve")


@query("i13_self_intersections", f"""
WITH p AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY curve) AS n FROM {CURVES} WINDOW w AS (PARTITION BY curve ORDER BY seq)),
s AS (SELECT * FROM (SELECT curve, i, n, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_, lead(x, 2) OVER w AS cx, lead(y, 2) OVER w AS cy
  FROM p WHERE i < n WINDOW w AS (PARTITION BY curve ORDER BY i)) WHERE bx IS NOT NULL),
h AS (SELECT DISTINCT a.curve FROM s a JOIN s b ON a.curve = b.curve AND b.i > a.i + 1
  WHERE greatest(a.ax, a.bx) >= least(b.ax, b.bx) AND greatest(b.ax, b.bx) >= least(a.ax, a.bx) AND greatest(a.ay, a.by_) >= least(b.ay, b.by_) AND greatest(b.ay, b.by_) >= least(a.ay, a.by_)
  AND sign((a.bx - a.ax) * (b.ay - a.ay) - (a.by_ - a.ay) * (b.ax - a.ax)) * sign((a.bx - a.ax) * (b.by_ - a.ay) - (a.by_ - a.ay) * (b.bx - a.ax)) <= 0
  AND sign((b.bx - b.ax) * (a.ay - b.ay) - (b.by_ - b.ay) * (a.ax - b.ax)) * sign((b.bx - b.ax) * (a.by_ - b.ay) - (b.by_ - b.ay) * (a.bx - b.ax)) <= 0
  UNION SELECT curve FROM s WHERE (bx - ax) * (cy - by_) - (by_ - ay) * (cx - bx) = 0 AND (bx - ax) * (cx - bx) + (by_ - ay) * (cy - by_) < 0)
SELECT DISTINCT curve, curve IN (SELECT curve FROM h) AS crosses FROM p""")
def _(t):
    return curves.self_intersections(points(t), "curve")


@query("i14_resample", digits=None)
def _(t):
    return curves.resample(points(t), "curve", digits=6)


_VEC = "(SELECT vec_id AS curve, unnest(embedding) AS y, unnest(range(len(embedding))) AS seq FROM embeddings)"


def vectors(t, shift=0):
    e = t("embeddings").select((F.col("vec_id") + shift).alias("curve"), F.posexplode("embedding").alias("seq", "y"))
    return e.select("curve", "seq", (F.col("seq") / 64.0).alias("x"), F.col("y").cast("double").alias("y"))


@query("i15_mean_distance", f"""
SELECT a.curve, round(avg(abs(CAST(a.y AS DOUBLE) - CAST(b.y AS DOUBLE))), 6) AS mean_distance FROM {_VEC} a JOIN {_VEC} b ON a.curve = b.curve + 1 AND a.seq = b.seq GROUP BY a.curve
UNION ALL SELECT 0, CAST('inf' AS DOUBLE) UNION ALL SELECT count(*), CAST('inf' AS DOUBLE) FROM embeddings""")
def _(t):
    return curves.mean_distance(vectors(t), vectors(t, 1), "curve")


@query("i16_nearest_sum", f"""
SELECT curve, round(sum(d), 6) AS distance_sum FROM (SELECT a.curve, a.seq, min(sqrt(pow((a.seq - b.seq) / 64.0, 2) + pow(CAST(a.y AS DOUBLE) - CAST(b.y AS DOUBLE), 2))) AS d
  FROM {_VEC} a JOIN {_VEC} b ON a.curve = b.curve + 1 GROUP BY ALL) GROUP BY curve
UNION ALL SELECT 0, CAST('inf' AS DOUBLE)""")
def _(t):
    return curves.nearest_sum(vectors(t), vectors(t, 1), "curve")


@query("i17_best_matches", f"""
WITH q AS (SELECT seq, x, y FROM {_NORM} WHERE curve = (SELECT min(curve) FROM {_NORM}))
SELECT curve, round(sum(d), 6) AS distance_sum FROM (SELECT n.curve, q.seq, min(sqrt(pow(n.x - q.x, 2) + pow(n.y - q.y, 2))) AS d FROM {_NORM} n, q GROUP BY ALL)
GROUP BY curve ORDER BY sum(d), curve LIMIT 3""")
def _(t):
    p = points(t)
    norm = curves.normalise(p, "curve")
    first = norm.agg(F.min("curve")).first()[0]
    return curves.best_matches(p.filter(F.col("curve") == first), p, "curve", 3, samples=None)


@query("i17_best_matches_resampled")
def _(t):
    v = vectors(t)
    return curves.best_matches(v.filter("curve = 0"), v, "curve", 3)


_COARSE = "(SELECT l_orderkey AS curve, CAST(l_linenumber AS BIGINT) * 100000000000 + l_partkey * 10000 + l_suppkey AS seq, floor(l_quantity / 10) AS x, CAST(l_linenumber % 2 AS DOUBLE) AS y FROM lineitem)"


def coarse(t):
    """Points on a coarse grid, so that many of them repeat."""
    return points(t).select("curve", "seq", F.floor(F.col("x") / 10).cast("double").alias("x"),
                            (F.floor(F.col("seq") / 100000000000) % 2).cast("double").alias("y"))


@query("i18_drop_repeats", f"""
SELECT curve, seq, CAST(x AS DOUBLE) AS x, y FROM (SELECT *, max(seq) OVER (PARTITION BY curve) AS last FROM {_COARSE}) WHERE seq = last
UNION ALL SELECT curve, min(seq), CAST(x AS DOUBLE), y FROM (SELECT *, max(seq) OVER (PARTITION BY curve) AS last FROM {_COARSE}) WHERE seq < last GROUP BY curve, x, y""")
def _(t):
    return curves.drop_repeats(coarse(t), "curve")


@query("i18_drop_near_repeats", f"""
WITH RECURSIVE every AS (SELECT *, max(seq) OVER (PARTITION BY curve) AS last FROM {CURVES}),
once AS (SELECT curve, min(seq) AS seq, x, y FROM every WHERE seq < last GROUP BY curve, x, y),
p AS (SELECT *, row_number() OVER (PARTITION BY curve ORDER BY seq) AS i, count(*) OVER (PARTITION BY curve) AS n FROM once),
walk AS (SELECT DISTINCT curve, 0::BIGINT AS i, n, []::STRUCT(seq BIGINT, x DOUBLE, y DOUBLE)[] AS kept FROM p
  UNION ALL SELECT w.curve, p.i, w.n, CASE WHEN len(list_filter(w.kept, lambda k: sqrt((k.x - p.x) * (k.x - p.x) + (k.y - p.y) * (k.y - p.y)) < 0.8)) = 0
    THEN list_append(w.kept, {{'seq': p.seq, 'x': p.x::DOUBLE, 'y': p.y::DOUBLE}}) ELSE w.kept END FROM walk w JOIN p ON p.curve = w.curve AND p.i = w.i + 1)
SELECT curve, k.seq AS seq, round(k.x, 6) AS x, round(k.y, 6) AS y FROM (SELECT curve, unnest(kept) AS k FROM walk WHERE i = n)
UNION ALL SELECT curve, seq, round(x, 6), round(y, 6) FROM every WHERE seq = last""")
def _(t):
    return curves.drop_near_repeats(points(t), "curve", 0.8)


@query("i19_clean_up")
def _(t):
    return curves.clean_up(curves.scale_x(points(t), "curve").dropna(), "curve")[1]
