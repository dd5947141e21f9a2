"""Geometry of many curves stored as one long table of points.

Columns: a curve key, ``seq`` (order along the curve), ``x`` and ``y``.  All
curves are handled in one job, and a curve may be longer than a task: orders
and neighbours come from ``functions.ordered``, sizes are pre-aggregated.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import BLOCK_ROWS, framed, positions, running_sum, settled
from ..functions.storage import materialise
from .nearest import nearest_distances
from .splines import CHUNK_KNOTS, spline_points
from .whole_curves import SHORT_POINTS, nearest_sums, parted, resampled


def _own_stats(points: DataFrame, key: str, aggs: list[Column]) -> DataFrame:
    """Points with statistics of their curve."""
    return points.join(points.groupBy(key).agg(*aggs), key)


def _hypot(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


# ---- measures ---------------------------------------------------------------

def length(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Sum of the distances of consecutive points; 0 for a single point."""
    fr = framed(points.select(key, "seq", "x", "y"), [key], ["seq"], 1, 0, block_rows)
    back = lambda c: F.col(c) - F.lag(c).over(fr.window)
    steps = fr.own(fr.df.withColumn("step", _hypot(back("x"), back("y"))))
    return steps.groupBy(key).agg(F.coalesce(F.sum("step"), F.lit(0.0)).alias("length"))


def thickness_camber(points: DataFrame, key: str) -> DataFrame:
    """curve, x, thickness, camber: one row per x of a curve."""
    top, low = F.max("y"), F.min("y")
    return points.groupBy(key, "x").agg((top - low).alias("thickness"), ((top + low) / 2).alias("camber"))


def proportions(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """chord, max thickness and camber, thickness to chord, aspect ratio; the
    ratios are NULL when the chord is zero."""
    shape = thickness_camber(points, key).groupBy(key).agg(
        (F.max("x") - F.min("x")).alias("chord"), F.max("thickness").alias("max_thickness"),
        F.max("camber").alias("max_camber"))
    both = shape.join(length(points, key, block_rows), key)
    return both.withColumns({"thickness_to_chord": F.try_divide("max_thickness", "chord"),
                             "aspect_ratio": F.try_divide("length", "chord")})


def _few(points: DataFrame, key: str, n: int, *order: Column) -> DataFrame:
    """The first n points of every curve; the limit is applied before the shuffle."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return points.withColumn("_place", place).filter(F.col("_place") <= n)


def leading_radius(points: DataFrame, key: str, n: int = 6) -> DataFrame:
    """Radius of the circle through the n points nearest to the smallest x:
    repeated points once, far ones (by y) left out, infinite when all pairwise
    distances agree, NULL above 10000 or when the points define no circle."""
    curve = Window.partitionBy(key)  # at most n rows of a curve from here on
    few = _few(points.select(key, "seq", "x", "y"), key, n, F.col("x"), F.col("seq"))
    few = few.withColumn("n", F.count(F.lit(1)).over(curve)).dropDuplicates([key, "x", "y"])
    few = few.withColumn("_m", F.percentile("y", F.lit(0.5)).over(curve)).withColumn("_away", F.abs(F.col("y") - F.col("_m")))
    few = few.withColumn("_mad", F.percentile("_away", F.lit(0.5)).over(curve))
    few = few.withColumn("_near", F.coalesce(F.try_divide("_away", "_mad") < 1.5, F.lit(False)))
    few = few.withColumn("_enough", F.count_if("_near").over(curve) >= 3)
    few = few.filter(F.col("_near") | ~F.col("_enough") | (F.col("_mad") == 0))
    # least squares around the mean point: a 2 x 2 system for the centre
    few = few.withColumns({"u": F.col("x") - F.avg("x").over(curve), "v": F.col("y") - F.avg("y").over(curve)})
    u, v = F.col("u"), F.col("v")
    s = few.groupBy(key, "n").agg(
        F.count(u).alias("m"), F.sum(u * u).alias("uu"), F.sum(u * v).alias("uv"), F.sum(v * v).alias("vv"),
        F.sum(u * (u * u + v * v)).alias("ur"), F.sum(v * (u * u + v * v)).alias("vr"),
        F.collect_list(F.struct("x", "y")).alias("p"))
    gaps = F.flatten(F.transform("p", lambda a, i: F.transform(
        F.slice("p", i + 2, F.size("p")), lambda b: _hypot(a.x - b.x, a.y - b.y))))
    s = s.withColumn("_gaps", F.array_sort(gaps))
    det = F.col("uu") * F.col("vv") - F.col("uv") * F.col("uv")
    det = F.when(F.abs(det) > 1e-14 * F.col("uu") * F.col("vv"), det)
    a = F.try_divide(F.col("ur") * F.col("vv") - F.col("vr") * F.col("uv"), 2 * det)
    b = F.try_divide(F.col("vr") * F.col("uu") - F.col("ur") * F.col("uv"), 2 * det)
    radius = F.sqrt(a * a + b * b + (F.col("uu") + F.col("vv")) / F.col("m"))
    flat = F.try_element_at("_gaps", F.lit(-1)) - F.get("_gaps", F.lit(0)) < 1e-3
    return s.select(key, F.when(F.col("n") < 3, F.lit(None).cast("double")).when(flat, F.lit(float("inf")))
                    .when(radius <= 10_000, radius).alias("leading_radius"))


def trailing_angle(points: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Angle in degrees of the least-squares line through the n largest x."""
    few = _few(points, key, n, F.col("x").desc(), F.col("seq").desc())
    return few.groupBy(key).agg(F.degrees(F.atan(F.regr_slope("y", "x"))).alias("trailing_angle"))


def geometry(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """All measures of a curve in one row."""
    return (proportions(points, key, block_rows).join(leading_radius(points, key), key)
            .join(trailing_angle(points, key), key))


def distributions(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Thickness and camber in x order with their place between 0 and 1.  Long
    form: a curve may be too long for one array cell."""
    shape = thickness_camber(points, key)
    placed = positions(shape, [key], ["x"], "place", block_rows)
    sized = _own_stats(placed, key, [F.max("place").alias("_n")])
    share = F.coalesce(F.try_divide((F.col("place") - 1).cast("double"), F.col("_n") - 1), F.lit(0.0))
    return sized.select(key, "place", "x", "thickness", "camber", share.alias("normalised_chord"))


def point_outliers(points: DataFrame, key: str, threshold: float = 3.0) -> DataFrame:
    """Points whose x or y is beyond the threshold (population deviation)."""
    known = _own_stats(points, key, [f(c).alias(f"_{n}{c}") for c in "xy" for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    z = {c: F.abs(F.try_divide(F.col(c) - F.col(f"_m{c}"), F.col(f"_s{c}"))) for c in "xy"}
    out = known.withColumns({"zx": z["x"], "zy": z["y"]})
    return out.filter((F.col("zx") > threshold) | (F.col("zy") > threshold)).select(key, "seq", "x", "y", "zx", "zy")


# ---- normal forms -----------------------------------------------------------

def scale_x(points: DataFrame, key: str) -> DataFrame:
    """x to 0..1; NULL for a curve without extent."""
    known = _own_stats(points, key, [F.min("x").alias("_lo"), F.max("x").alias("_hi")])
    return known.select(key, "seq", F.try_divide(F.col("x") - F.col("_lo"), F.col("_hi") - F.col("_lo")).alias("x"), "y")


def _leftmost() -> Column:
    return F.min_by(F.struct("x", "y"), F.struct("x", "seq"))


def _rightmost() -> Column:
    return F.max_by(F.struct("x", "y"), F.struct(F.col("x"), -F.col("seq")))


def normalise(points: DataFrame, key: str) -> DataFrame:
    """Leftmost point to the origin, distance to the rightmost to 1; curves of
    one point or without extent are left out."""
    known = _own_stats(points, key, [_leftmost().alias("_a"), _rightmost().alias("_b"), F.count(F.lit(1)).alias("_n")])
    span = _hypot(F.col("_b.x") - F.col("_a.x"), F.col("_b.y") - F.col("_a.y"))
    return known.withColumn("_d", span).filter((F.col("_n") >= 2) & (F.col("_d") > 0)).select(
        key, "seq", ((F.col("x") - F.col("_a.x")) / F.col("_d")).alias("x"), ((F.col("y") - F.col("_a.y")) / F.col("_d")).alias("y"))


def _close(a: Column, b: Column, tolerance: float) -> Column:
    """Equality within the absolute tolerance plus 1e-5 of the second value."""
    return F.abs(a - b) <= F.lit(tolerance) + 1e-5 * F.abs(b)


def _closed(tolerance: float) -> Column:
    a, b = F.min_by(F.struct("x", "y"), "seq"), F.max_by(F.struct("x", "y"), "seq")
    return _close(a.x, b.x, tolerance) & _close(a.y, b.y, tolerance)


TOLERANCES = (1e-5, 1e-4, 1e-3)


def curve_format(points: DataFrame, key: str) -> DataFrame:
    """format (closed, split, partial_split, unordered), the tolerance at which
    it was found, and the direction between the extreme x."""
    at = lambda place, tol: F.count_if(F.abs(F.col("x") - place) < tol)
    aggs = [at(place, tol).alias(f"_{name}{i}") for name, place in (("r", 1), ("l", 0)) for i, tol in enumerate(TOLERANCES)]
    right = F.max_by("seq", F.struct(F.col("x"), -F.col("seq")))
    left = F.min_by("seq", F.struct("x", "seq"))
    s = points.groupBy(key).agg(_closed(1e-4).alias("_closed"), right.alias("_right"), left.alias("_left"), *aggs)
    kind, found = F.when(F.col("_closed"), "closed"), F.when(F.col("_closed"), F.lit(None).cast("double"))
    for i, tol in enumerate(TOLERANCES):
        r, l = F.col(f"_r{i}") >= 2, F.col(f"_l{i}") >= 2  # noqa: E741
        kind = kind.when(r & l, "split").when(r | l, "partial_split")
        found = found.when(r | l, tol)
    return s.select(key, kind.otherwise("unordered").alias("format"), found.alias("tolerance"),
                    F.when(F.col("_right") < F.col("_left"), "LE_to_TE").otherwise("TE_to_LE").alias("direction"))


def close(points: DataFrame, key: str, tolerance: float = 1e-6) -> DataFrame:
    """Open curves get their first point once more at the end."""
    ends = points.groupBy(key).agg(_closed(tolerance).alias("_closed"), F.max("seq").alias("_last"),
                                   F.min_by(F.struct("x", "y"), "seq").alias("_first"))
    extra = ends.filter("NOT _closed").select(key, (F.col("_last") + 1).alias("seq"), F.col("_first.x").alias("x"), F.col("_first.y").alias("y"))
    return points.select(key, "seq", "x", "y").unionByName(extra)


def simplify(points: DataFrame, key: str, tolerance: float = 1e-5, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Keeps the ends and every point where the turn exceeds the tolerance."""
    fr = framed(points.select(key, "seq", "x", "y"), [key], ["seq"], 1, 1, block_rows)
    at = lambda c, k: F.lag(c, -k).over(fr.window)
    ax, ay, bx, by = F.col("x") - at("x", -1), F.col("y") - at("y", -1), at("x", 1) - F.col("x"), at("y", 1) - F.col("y")
    cosine = F.try_divide(ax * bx + ay * by, _hypot(ax, ay) * _hypot(bx, by))
    turn = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    rows = fr.df.withColumns({"_end": at("x", -1).isNull() | at("x", 1).isNull(),
                              "_turn": F.when(cosine.isNotNull(), turn)})
    return fr.own(rows.filter(F.col("_end") | (F.col("_turn") > tolerance))).select(key, "seq", "x", "y")


# ---- reordering -------------------------------------------------------------

def _indexed(points: DataFrame, key: str, block_rows: int | None) -> DataFrame:
    return positions(points.select(key, "seq", "x", "y"), [key], ["seq"], "i", block_rows).withColumn("i", F.col("i") - 1).drop("seq")


def _renumber(rows: DataFrame, key: str, block_rows: int | None) -> DataFrame:
    """New seq from the sort columns a, b, c."""
    return positions(rows, [key], ["a", "b", "c"], "seq", block_rows).select(key, "seq", "x", "y")


def reorder_unordered(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Rightmost point, one side to the leftmost, the other side back, and the
    rightmost once more.  The sides part at the mean y of the other points."""
    rows = _indexed(points, key, block_rows)
    right = F.max_by("i", F.struct(F.col("x"), -F.col("i"))).alias("_r")
    left = F.min_by("i", F.struct("x", "i")).alias("_l")
    rows = _own_stats(rows, key, [right, left])
    end_r, end_l = F.col("i") == F.col("_r"), F.col("i") == F.col("_l")
    rows = _own_stats(rows, key, [F.avg(F.when(~(end_r | end_l), F.col("y"))).alias("_mid")])
    upper = F.col("y") >= F.col("_mid")
    forward = F.col("_r") < F.col("_l")
    sign = F.when(forward, 1).otherwise(-1)  # ties keep or reverse their order
    # first side runs from right to left: upper when forward, else lower
    goes_first = upper == forward
    spots = F.concat(
        F.when(end_r, F.array(F.lit(0), F.lit(4))).otherwise(F.array().cast("array<int>")),
        F.when(end_l, F.array(F.lit(2))).otherwise(F.array().cast("array<int>")),
        F.when(end_r | end_l, F.array().cast("array<int>")).otherwise(F.array(F.when(goes_first, 1).otherwise(3))))
    rows = rows.withColumn("a", F.explode(spots))
    b = F.when(F.col("a") == 1, -F.col("x")).when(F.col("a") == 3, F.col("x")).otherwise(F.lit(0.0))
    return _renumber(rows.select(key, "x", "y", "a", b.alias("b"), (sign * F.col("i")).alias("c")), key, block_rows)


def _first_two(rows: DataFrame, key: str, place: float, name: str) -> DataFrame:
    """Per curve the first two indices whose x is within the curve's tolerance
    of ``place``."""
    hit = rows.filter(F.abs(F.col("x") - place) < F.col("tolerance"))
    first = hit.groupBy(key).agg(F.min("i").alias(f"{name}1"))
    second = hit.join(first, key).filter(F.col("i") > F.col(f"{name}1")).groupBy(key).agg(F.min("i").alias(f"{name}2"))
    return first.join(second, key)


def reorder_split(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Two runs between the first and second pairs of extreme points: the run
    with the higher mean y from right to left, the other one back.  ``points``
    carries the tolerance of its curve."""
    rows = positions(points.select(key, "seq", "x", "y", "tolerance"), [key], ["seq"], "i", block_rows).withColumn("i", F.col("i") - 1)
    info = _first_two(rows, key, 1, "r").join(_first_two(rows, key, 0, "l"), key)
    rows = rows.join(info, key)
    member = lambda n: F.col("i").between(F.least(f"r{n}", f"l{n}"), F.greatest(f"r{n}", f"l{n}"))
    rows = rows.withColumn("side", F.explode(F.array_compact(F.array(F.when(member(1), 1), F.when(member(2), 2)))))
    means = rows.groupBy(key).agg(F.avg(F.when(F.col("side") == 1, F.col("y"))).alias("_m1"),
                                  F.avg(F.when(F.col("side") == 2, F.col("y"))).alias("_m2"))
    rows = rows.join(means, key)
    ahead = F.when(F.col("side") == 1, F.col("r1") < F.col("l1")).otherwise(F.col("r2") < F.col("l2"))
    upper = F.when(F.col("_m1") < F.col("_m2"), 2).otherwise(1)
    along = F.when(ahead, F.col("i")).otherwise(-F.col("i"))
    on_top = F.col("side") == upper
    return _renumber(rows.select(key, "x", "y", F.when(on_top, 0).otherwise(1).alias("a"),
                                 F.when(on_top, along).otherwise(-along).alias("b"), F.lit(0).alias("c")), key, block_rows)


def reorder_partial_split(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """The run between the two extreme points of one end, then the rest of the
    curve from there around; each flipped according to its own direction."""
    rows = positions(points.select(key, "seq", "x", "y", "tolerance"), [key], ["seq"], "i", block_rows).withColumn("i", F.col("i") - 1)
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    info = size.join(_first_two(rows, key, 1, "r"), key, "left").join(_first_two(rows, key, 0, "l"), key, "left")
    is_right = F.col("r2").isNotNull()
    info = info.select(key, "n", is_right.alias("right"), F.when(is_right, F.col("r1") + 1).otherwise(F.col("l1")).alias("i1"),
                       F.when(is_right, F.col("r2") + 1).otherwise(F.col("l2")).alias("i2"))
    rows = rows.join(info, key)
    first = (F.col("i") >= F.col("i1")) & (F.col("i") < F.col("i2"))
    # place of a row of the second run, which starts at i2 and wraps around
    around = F.pmod(F.col("i") - F.col("i2"), F.col("n"))
    rows = rows.withColumns({"a": F.when(first, 0).otherwise(1), "p": F.when(first, F.col("i") - F.col("i1")).otherwise(around)})
    ends = rows.groupBy(key, "a").agg(F.min_by("x", "p").alias("_from"), F.max_by("x", "p").alias("_to"))
    rows = rows.join(ends, [key, "a"])
    falls = F.col("_from") > F.col("_to")
    right_to_left = falls == F.col("right")
    flip = F.when(F.col("a") == 0, ~right_to_left).otherwise(right_to_left)
    drop = (F.col("a") == 1) & flip & (F.col("p") == 0)
    return _renumber(rows.filter(~drop).select(key, "x", "y", "a", F.when(flip, -F.col("p")).otherwise(F.col("p")).alias("b"), F.lit(0).alias("c")), key, block_rows)


def reorder(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Every curve by the rule of its format; closed curves stay as they are.
    Only the formats that occur are planned."""
    block_rows = settled(points, [key], block_rows)
    kinds = curve_format(points, key).select(F.col(key).alias("_key"), "format", "tolerance")
    rows = materialise(points.select(key, "seq", "x", "y").join(kinds, F.col(key) == F.col("_key")).drop("_key"))
    present = {r.format for r in rows.select("format").distinct().collect()}
    rules = {"closed": lambda df: df.select(key, "seq", "x", "y"),
             "unordered": lambda df: reorder_unordered(df, key, block_rows),
             "split": lambda df: reorder_split(df, key, block_rows),
             "partial_split": lambda df: reorder_partial_split(df, key, block_rows)}
    parts = [rule(rows.filter(F.col("format") == kind)) for kind, rule in rules.items() if kind in present]
    return reduce(DataFrame.unionByName, parts) if parts else rows.select(key, "seq", "x", "y")


# ---- self-intersection ------------------------------------------------------

CELL_SEGMENTS = 48


#: Quartering ends here, or when the segments' pieces are so many times the segments.
MAX_DEPTH = 24
MAX_PIECES = 64


def self_intersections(points: DataFrame, key: str, cell_segments: int = CELL_SEGMENTS, max_depth: int = MAX_DEPTH,
                       block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """curve, crosses: does the line through all points but the last touch or
    cross itself (a closing end point apart)?

    Meeting vertices and turning straight back are found by counting.  The
    segments of the other curves are sorted into cells of a grid; cells with
    more than ``cell_segments`` are quartered, and only segments of one cell are
    compared, inside one array.  A curve that crosses is done and leaves.  Cells
    that quartering does not empty, as around a spot that many lines pass
    closely, are compared in blocks: every answer rests on a comparison.
    """
    block_rows = settled(points, [key], block_rows)
    fr = framed(points.select(key, "seq", "x", "y"), [key], ["seq"], 1, 1, block_rows)
    at = lambda c, k: F.lag(c, -k).over(fr.window)
    line = fr.own(fr.df.withColumns({"_last": at("seq", 1).isNull(), "_again": F.coalesce(
        (at("x", -1) == F.col("x")) & (at("y", -1) == F.col("y")), F.lit(False))})).filter("NOT _last AND NOT _again").drop("_last", "_again")
    line = positions(line, [key], ["seq"], "i", block_rows)
    n = line.groupBy(F.col(key).alias("_key")).agg(
        F.max("i").alias("n"), F.min_by(F.struct("x", "y"), "i").alias("_a"), F.max_by(F.struct("x", "y"), "i").alias("_b"),
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    line = line.join(n, F.col(key) == F.col("_key")).drop("_key")
    ring = (F.col("n") > 3) & (F.col("_a") == F.col("_b"))
    line = line.withColumn("ring", ring).drop("_a", "_b")
    met = (line.filter(~(F.col("ring") & (F.col("i") == F.col("n")))).groupBy(key, "x", "y").agg(F.count(F.lit(1)).alias("_met"))
           .filter("_met > 1").select(key))
    fr = framed(line, [key], ["i"], 0, 2, block_rows)
    at = lambda c, k: F.lag(c, -k).over(fr.window)
    seg = fr.own(fr.df.withColumns({"bx": at("x", 1), "by": at("y", 1), "cx": at("x", 2), "cy": at("y", 2)})).filter("bx IS NOT NULL")
    ux, uy = F.col("bx") - F.col("x"), F.col("by") - F.col("y")
    vx, vy = F.col("cx") - F.col("bx"), F.col("cy") - F.col("by")
    back = seg.filter((ux * vy - uy * vx == 0) & (ux * vx + uy * vy < 0)).select(key)
    seg = seg.select(key, "i", "n", "ring", F.col("x").alias("ax"), F.col("y").alias("ay"), "bx", "by", "x0", "x1", "y0", "y1")
    seg = seg.withColumns({"gx": F.lit(0).cast("long"), "gy": F.lit(0).cast("long")})
    cells, depth = [key, "gx", "gy"], 0
    hits = [materialise(met.unionByName(back).distinct())]
    seg = materialise(seg.join(hits[0], key, "left_anti"))
    most = MAX_PIECES * seg.count()
    while True:
        big = materialise(seg.groupBy(*cells).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > cell_segments).drop("_c"))
        hits.append(materialise(_cell_crossings(seg.join(big, cells, "left_anti"), key, cells).distinct()))
        seg = materialise(seg.join(big, cells, "left_semi").join(hits[-1], key, "left_anti"))
        left = seg.count()
        if not left:
            break
        if depth >= max_depth or left > most:
            hits.append(_block_crossings(seg, key, cells, cell_segments, block_rows))
            break
        depth += 1
        side = float(2 ** depth)
        kids = F.explode(F.array(*[F.struct((F.col("gx") * 2 + dx).alias("gx"), (F.col("gy") * 2 + dy).alias("gy")) for dx in (0, 1) for dy in (0, 1)]))
        seg = seg.withColumn("_k", kids).withColumns({"gx": F.col("_k.gx"), "gy": F.col("_k.gy")}).drop("_k")
        lx, ly = (F.col("x1") - F.col("x0")) / side, (F.col("y1") - F.col("y0")) / side
        slack = 1e-9
        lo_x, lo_y = F.col("x0") + lx * (F.col("gx") - slack), F.col("y0") + ly * (F.col("gy") - slack)
        hi_x, hi_y = F.col("x0") + lx * (F.col("gx") + 1 + slack), F.col("y0") + ly * (F.col("gy") + 1 + slack)
        dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
        turn = lambda px, py: dx * (py - F.col("ay")) - dy * (px - F.col("ax"))
        corners = [turn(px, py) for px in (lo_x, hi_x) for py in (lo_y, hi_y)]
        seg = seg.filter((F.greatest("ax", "bx") >= lo_x) & (F.least("ax", "bx") <= hi_x) & (F.greatest("ay", "by") >= lo_y)
                         & (F.least("ay", "by") <= hi_y) & (F.greatest(*corners) >= 0) & (F.least(*corners) <= 0))
        seg = materialise(seg)
    hits = reduce(DataFrame.unionByName, hits).distinct().withColumn("_hit", F.lit(True))
    return points.select(key).distinct().join(hits, key, "left").select(key, F.coalesce("_hit", F.lit(False)).alias("crosses"))


def _block_crossings(seg: DataFrame, key: str, cells: list[str], size: int, block_rows: int | None) -> DataFrame:
    """Curves with crossings in full cells: the segments of a cell in blocks, every block with every other, two at a time."""
    block = F.floor((F.col("_place") - 1) / size).cast("long")
    placed = positions(seg, cells, ["i"], "_place", block_rows).withColumn("_b", block).drop("_place")
    last = placed.groupBy(*cells).agg(F.max("_b").alias("_last"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last")))
    pairs = placed.join(last, cells).withColumn("_o", other).withColumns({"_b1": F.least("_b", "_o"), "_b2": F.greatest("_b", "_o")})
    return _cell_crossings(pairs, key, [*cells, "_b1", "_b2"]).distinct()


def _cell_crossings(seg: DataFrame, key: str, cells: list[str]) -> DataFrame:
    sets = seg.groupBy(*cells, "n", "ring").agg(F.collect_list(F.struct("i", "ax", "ay", "bx", "by")).alias("s"))

    def turn(a, px, py):
        return (a.bx - a.ax) * (py - a.ay) - (a.by - a.ay) * (px - a.ax)

    def meets(a, b):
        boxes = ((F.greatest(a.ax, a.bx) >= F.least(b.ax, b.bx)) & (F.greatest(b.ax, b.bx) >= F.least(a.ax, a.bx))
                 & (F.greatest(a.ay, a.by) >= F.least(b.ay, b.by)) & (F.greatest(b.ay, b.by) >= F.least(a.ay, a.by)))
        apart = (b.i > a.i + 1) & ~(F.col("ring") & (a.i == 1) & (b.i == F.col("n") - 1))
        return (apart & boxes & (F.signum(turn(a, b.ax, b.ay)) * F.signum(turn(a, b.bx, b.by)) <= 0)
                & (F.signum(turn(b, a.ax, a.ay)) * F.signum(turn(b, a.bx, a.by)) <= 0))
    return sets.filter(F.exists("s", lambda a: F.exists("s", lambda b: meets(a, b)))).select(key)


# ---- resampling -------------------------------------------------------------

def merged_by_x(points: DataFrame, key: str, tolerance: float = 1e-8, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Points in x order with those of (nearly) equal x averaged: a run of
    points whose steps stay below the tolerance is cut every tolerance."""
    same = points.groupBy(key, "x").agg(F.sum("y").alias("sy"), F.count("y").alias("c"))
    fr = framed(same, [key], ["x"], 1, 0, block_rows)
    step = F.col("x") - F.lag("x").over(fr.window)
    rows = fr.own(fr.df.withColumn("_new", (step.isNull() | (step >= tolerance)).cast("long")))
    rows = running_sum(rows, [key], ["x"], {"run": "_new"}, block_rows).drop("_new")
    first = rows.groupBy(F.col(key).alias("_key"), F.col("run").alias("_run")).agg(F.min("x").alias("_x0"), F.max("x").alias("_x9"))
    wide = first.filter(F.col("_x9") - F.col("_x0") >= tolerance)
    rows = rows.join(wide, (F.col(key) == F.col("_key")) & (F.col("run") == F.col("_run")), "left")
    part = F.coalesce(F.floor((F.col("x") - F.col("_x0")) / tolerance), F.lit(0))
    return (rows.groupBy(key, "run", part.alias("part"))
            .agg(F.min("x").alias("x"), (F.sum("sy") / F.sum("c")).alias("y")).select(key, "x", "y"))


def resample(points: DataFrame, key: str, n: int = 200, tolerance: float = 1e-8, block_rows: int | None = BLOCK_ROWS,
             chunk_knots: int = CHUNK_KNOTS, digits: int | None = None) -> DataFrame:
    """n points at equal steps of the chord length along the interpolating cubic
    through the merged points: short curves many at a time (``whole_curves``),
    long ones chunk by chunk (``splines``).  Curves of fewer than three points
    stay as they are, two merged points too.  ``digits``: x and y rounded.
    """
    short, long = parted(points, key, _short_points(block_rows, chunk_knots))
    done = resampled(short, key, n, tolerance, digits)
    if long is None:
        return done
    rest = _resample_long(long, key, n, tolerance, block_rows, chunk_knots)
    return done.unionByName(rest if digits is None else rest.withColumns({c: F.round(c, digits) for c in "xy"}))


def _short_points(block_rows: int | None, chunk_knots: int) -> int:
    return max(2, min(SHORT_POINTS, chunk_knots, block_rows or SHORT_POINTS))


def _resample_long(points: DataFrame, key: str, n: int, tolerance: float, block_rows: int | None, chunk_knots: int) -> DataFrame:
    """``resample`` of curves of three points or more."""
    block_rows = settled(points, [key], block_rows)
    knots = merged_by_x(points, key, tolerance, block_rows)
    fr = framed(knots, [key], ["x"], 1, 0, block_rows)
    back = lambda c: F.col(c) - F.lag(c).over(fr.window)
    rows = fr.own(fr.df.withColumn("_step", F.coalesce(_hypot(back("x"), back("y")), F.lit(0.0))))
    rows = running_sum(rows, [key], ["x"], {"u": "_step"}, block_rows).drop("_step")
    rows = _own_stats(rows, key, [F.max("u").alias("total"), F.count(F.lit(1)).alias("m")])
    short = positions(rows.filter("m <= 2").select(key, "x", "y"), [key], ["x"], "seq", block_rows)
    long = rows.filter("m > 2").withColumn("u", F.col("u") / F.col("total")).select(key, "u", "x", "y")
    return short.select(key, "seq", "x", "y").unionByName(spline_points(long, key, n, chunk_knots, block_rows))


# ---- distances and matching -------------------------------------------------

def mean_distance(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Mean distance of points of equal seq; infinite when the counts differ."""
    left = a.select(key, "seq", F.col("x").alias("_x"), F.col("y").alias("_y"))
    both = left.join(b.select(key, "seq", "x", "y"), [key, "seq"], "full")
    unmatched = F.count_if(F.col("_x").isNull() | F.col("x").isNull())
    away = F.avg(_hypot(F.col("x") - F.col("_x"), F.col("y") - F.col("_y")))
    return both.groupBy(key).agg(F.when(unmatched > 0, F.lit(float("inf"))).otherwise(away).alias("mean_distance"))


def nearest_sum(a: DataFrame, b: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Sum over the points of a of the distance to the nearest point of b;
    infinite where b has no points."""
    near = nearest_distances(a, b, [key], "seq", block_rows=block_rows)
    sums = near.groupBy(key).agg(F.sum("distance").alias("_sum"))
    return a.select(key).distinct().join(sums, key, "left").select(
        key, F.coalesce("_sum", F.lit(float("inf"))).alias("distance_sum"))


#: Points of the query curve that travel together.
QUERY_BLOCK = 1024
#: Samples up to which a task compares a curve with the whole query.
QUERY_SAMPLES = 1024


def best_matches(query: DataFrame, points: DataFrame, key: str, k: int = 3, samples: int | None = 200,
                 block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """The k curves nearest to the query curve: both normalised and resampled
    (``samples`` None: not), summed over the query's points.  Every curve is
    asked about every point of the query, which meets the curves in blocks;
    short curves are resampled and compared in one go (``whole_curves``)."""
    probe = normalise(query.select(F.lit(0).alias("_q"), "seq", "x", "y"), "_q")
    if samples is None:
        sums = _asked_sums(probe, normalise(points, key), key, block_rows)
    else:
        probe = materialise(resample(probe, "_q", samples, block_rows=block_rows))
        size, known = probe.agg(F.count(F.lit(1)), F.count_if(F.col("x").isNotNull() & F.col("y").isNotNull())).first()
        if 3 <= size == known == samples <= QUERY_SAMPLES:
            short, long = parted(points, key, _short_points(block_rows, CHUNK_KNOTS))
            asked = np.array(probe.select("x", "y").collect())
            sums = nearest_sums(normalise(short, key), key, asked, 1e-8)
        else:
            long, sums = points, None
        if long is not None:
            others = materialise(resample(normalise(long, key), key, samples, block_rows=block_rows))
            same = others.groupBy(F.col(key).alias("_key")).count().filter(F.col("count") == size)
            others = others.join(same, F.col(key) == F.col("_key"), "left_semi")
            asked_sums = _asked_sums(probe, others, key, block_rows)
            sums = asked_sums if sums is None else sums.unionByName(asked_sums)
    return sums.orderBy("distance_sum", key).limit(k)


def _asked_sums(probe: DataFrame, others: DataFrame, key: str, block_rows: int | None) -> DataFrame:
    """key, distance_sum: from each point of the probe to the nearest of the curve, summed."""
    numbered = positions(probe.select("seq", "x", "y"), [], ["seq", "x", "y"], "seq_", block_rows)
    blocks = (numbered.groupBy(F.floor(F.col("seq_") / QUERY_BLOCK).alias("_block"))
              .agg(F.collect_list(F.struct(F.col("seq_").alias("seq"), "x", "y")).alias("_points")).select("_points"))
    asked = others.select(key).distinct().crossJoin(blocks).select(key, F.explode("_points").alias("p")).select(key, "p.*")
    return nearest_sum(asked, others, key, block_rows)


# ---- near duplicates --------------------------------------------------------

def drop_repeats(points: DataFrame, key: str) -> DataFrame:
    """Exact repeats: the first of equal points stays, and so does the last
    point of the curve."""
    known = _own_stats(points.select(key, "seq", "x", "y"), key, [F.max("seq").alias("_last")])
    return known.groupBy(key, "x", "y", (F.col("seq") == F.col("_last")).alias("_end")).agg(F.min("seq").alias("seq")).select(key, "seq", "x", "y")


#: Rows of a close group that one task settles at a time.
GROUP_POINTS = 200_000


def _close_groups(points: DataFrame, key: str, tolerance: float, block_rows: int | None) -> DataFrame:
    """Adds ``_g0`` to ``_g2``, numbers of groups of points such that points of different groups are at least the tolerance apart:
    cut at gaps along x, then along y inside these, then along x again."""
    groups: list[str] = []
    for i, axis in enumerate(("x", "y", "x")):
        keys = [key, *groups]
        fr = framed(points, keys, [axis, "seq"], 1, 0, block_rows)
        step = F.col(axis) - F.lag(axis).over(fr.window)
        marked = fr.own(fr.df.withColumn("_new", (step.isNull() | (step >= tolerance)).cast("long")))
        points = running_sum(marked, keys, [axis, "seq"], {f"_g{i}": "_new"}, block_rows).drop("_new")
        groups.append(f"_g{i}")
    return points


GROUP = ["_g0", "_g1", "_g2"]


def _settle(key: str, tolerance: float):
    """Greedy pass by seq over some groups: the kept points of a group fall into cells of the tolerance, at most a few in each."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable").reset_index(drop=True)
        cells: dict[tuple, list[tuple[float, float]]] = {}
        keep = np.zeros(len(pdf), dtype=bool)
        for i, (x, y, *group) in enumerate(zip(*(pdf[c].tolist() for c in ("x", "y", key, *GROUP)), strict=True)):
            cx, cy = math.floor(x / tolerance), math.floor(y / tolerance)
            near = (k for dx in (-1, 0, 1) for dy in (-1, 0, 1) for k in cells.get((*group, cx + dx, cy + dy), ()))
            if not any(math.sqrt((x - a) * (x - a) + (y - b) * (y - b)) < tolerance for a, b in near):
                keep[i] = True
                cells.setdefault((*group, cx, cy), []).append((x, y))
        return pdf[keep]
    return run


def drop_near_repeats(points: DataFrame, key: str, tolerance: float = 1e-8,
                      block_rows: int | None = BLOCK_ROWS, group_points: int = GROUP_POINTS) -> DataFrame:
    """A point nearer than the tolerance to an earlier kept one goes; the last
    point of the curve always stays.

    After exact repeats are gone, points without a neighbour in x order, nearly
    all, stay.  The others form groups that do not see each other; a task
    settles a group in one pass by seq.  A group beyond ``group_points`` is cut
    by seq, and its blocks are settled one after the other: the points kept so
    far, which are that far apart, first remove what is near them.  Rounds
    follow the size of the largest group, not the length of its chains.
    """
    once = drop_repeats(points, key)
    known = _own_stats(once, key, [F.max("seq").alias("_last")])
    end = known.filter(F.col("seq") == F.col("_last")).select(key, "seq", "x", "y")
    # a point whose neighbours in x order are too far away meets nobody
    fr = framed(known.filter(F.col("seq") < F.col("_last")).select(key, "seq", "x", "y"), [key], ["x", "seq"], 1, 1, block_rows)
    gap = lambda k: F.coalesce(F.abs(F.lag("x", -k).over(fr.window) - F.col("x")) < tolerance, F.lit(False))
    inner = materialise(fr.own(fr.df.withColumn("_near", gap(1) | gap(-1))))
    alone, open_ = inner.filter("NOT _near").select(key, "seq", "x", "y"), inner.filter("_near").select(key, "seq", "x", "y")
    grouped = _close_groups(open_, key, tolerance, block_rows)
    placed = positions(grouped, [key, *GROUP], ["seq"], "_pos", block_rows)
    blocks = materialise(placed.withColumn("_block", F.floor((F.col("_pos") - 1) / group_points).cast("long")).drop("_pos"))
    last, rows = blocks.agg(F.max("_block"), F.count(F.lit(1))).first()
    if last is None:
        return alone.unionByName(end)
    tasks = blocks.sparkSession.sparkContext.defaultParallelism + 2 * rows // group_points
    share = F.pmod(F.xxhash64(key, *GROUP), F.lit(tasks)).alias("_share")
    cell = {f"_c{c}": F.floor(F.col(c) / tolerance).cast("long") for c in "xy"}
    ring = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]))
    at = [key, *GROUP, "_cx", "_cy"]
    kept: list[DataFrame] = []
    for k in range(last + 1):
        block = blocks.filter(F.col("_block") == k)
        if kept:
            around = (reduce(DataFrame.unionByName, kept).withColumns(cell).withColumn("_o", ring)
                      .select(key, *GROUP, (F.col("_cx") + F.col("_o.dx")).alias("_cx"), (F.col("_cy") + F.col("_o.dy")).alias("_cy"), F.col("x").alias("_kx"), F.col("y").alias("_ky")))
            gone = (block.withColumns(cell).join(around, at).filter(_hypot(F.col("x") - F.col("_kx"), F.col("y") - F.col("_ky")) < tolerance)
                    .select(key, "seq").distinct())
            block = block.join(gone, [key, "seq"], "left_anti").select(*blocks.columns)
        kept.append(materialise(block.groupBy(share).applyInPandas(_settle(key, tolerance), blocks.schema)))
    return reduce(DataFrame.unionByName, [alone, *[d.select(key, "seq", "x", "y") for d in kept], end])


def clean_up(points: DataFrame, key: str, block_rows: int | None = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Cleaned points and a report (format, counts before and after, crossing):
    reorder by format, close, drop near repeats, check for crossings."""
    points = materialise(points.select(key, "seq", "x", "y"))
    block_rows = settled(points, [key], block_rows)
    kinds = curve_format(points, key).select(key, "format")
    ordered = materialise(close(reorder(points, key, block_rows), key))
    cleaned = materialise(drop_near_repeats(ordered, key, block_rows=block_rows))
    before = points.groupBy(key).agg(F.count(F.lit(1)).alias("points_before"))
    after = cleaned.groupBy(key).agg(F.count(F.lit(1)).alias("points_after"))
    report = kinds.join(before, key).join(after, key).join(self_intersections(cleaned, key, block_rows=block_rows), key)
    return cleaned, report
