"""Ordered series: gradients, smoothing, turning points, slopes of pieces.

A series is the rows of one key (``keys``), ordered by ``x``.  All neighbour
access goes through ``framed``, which cuts a very long series into chunks with
copies of the neighbouring rows, so one series may hold most of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import BLOCK_ROWS, framed, join_same, positions, settled
from ..functions.quantiles import number

METHODS = ("forward", "backward", "central")


def _points(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """keys, x, y of the complete rows; time becomes seconds."""
    kind = dict(df.dtypes)[x]
    cx = (F.unix_micros(F.col(x).cast("timestamp")) / 1e6 if kind.startswith("timestamp") else number(x))
    return df.select(*keys, cx.alias("x"), number(y).alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")


def _slope(window: Window, x: str, y: str, method: str) -> tuple[Column, Column]:
    """(gradient, defined): equal x give a NULL gradient on a defined row."""
    at = lambda c, k: F.lag(c, -k).over(window)
    step = lambda i, j: F.try_divide(at(y, j) - at(y, i), at(x, j) - at(x, i))
    back, ahead = at(x, -1).isNotNull(), at(x, 1).isNotNull()
    if method == "forward":
        return step(0, 1), ahead
    if method == "backward":
        return step(-1, 0), back
    if method != "central":
        raise ValueError(f"method must be one of {METHODS}")
    only_two = ~back & ahead & at(x, 2).isNull()  # then forward, as there is no middle
    return (F.when(back & ahead, step(-1, 1)).when(only_two, step(0, 1)), (back & ahead) | only_two)


def _smooth_weights(size: int) -> np.ndarray:
    """Row i: weights of the window values for the fitted value at place i."""
    place = np.arange(size, dtype=float)
    design = np.vander(place - place.mean(), min(3, size - 1) + 1)
    return design @ np.linalg.pinv(design)


def _smoothed(window: Window, g: str, size: int | None) -> Column:
    """Local polynomial of a centred window; end rows use the polynomial of the
    end window.  An even window gives the centred mean instead, NULL at the
    ends.  Series shorter than the window stay as they are."""
    if size is None or size <= 1:
        return F.col(g)
    at = lambda k: F.lag(g, -k).over(window)
    here = lambda k: F.lag(F.lit(1), -k).over(window).isNotNull()
    count = lambda ks: reduce(lambda a, b: a + b, [here(k).cast("int") for k in ks], F.lit(0))
    if size % 2 == 0:
        left = size // 2
        span = range(-left, size - left)
        mean = reduce(lambda a, b: a + b, [at(k) for k in span]) / size
        long_enough = count(range(-size + 1, 0)) + count(range(1, size)) + 1 >= size
        return F.when(long_enough, F.when(here(-left) & here(size - left - 1), mean)).otherwise(F.col(g))
    half, w = size // 2, _smooth_weights(size)
    before, after = count(range(-half, 0)), count(range(1, half + 1))
    out = F.when((before == half) & (after == half),
                 reduce(lambda a, b: a + b, [at(k) * float(w[half, k + half]) for k in range(-half, half + 1)]))
    for i in range(half):
        first = reduce(lambda a, b: a + b, [at(j - i) * float(w[i, j]) for j in range(size)])
        out = out.when((before == i) & here(size - 1 - i), first)
        last = reduce(lambda a, b: a + b, [at(i - j) * float(w[size - 1 - i, size - 1 - j]) for j in range(size)])
        out = out.when((after == i) & here(i - size + 1), last)
    return out.otherwise(F.col(g))


def _derived(rows: DataFrame, window: Window, source: str, output: str, method: str, smooth: int | None) -> DataFrame:
    g, defined = _slope(window, "x", source, method)
    out = rows.withColumns({"_g": g, "_d": defined}).filter("_d").drop("_d")
    return out.withColumn(output, _smoothed(window, "_g", smooth)).drop("_g")


def _reach(smooth: int | None) -> int:
    return 2 + 2 * (smooth or 0)


def gradient(df: DataFrame, keys: Sequence[str], x: str, y: str, method: str = "central",
             smooth: int | None = None, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, x, gradient."""
    reach = _reach(smooth)
    fr = framed(_points(df, keys, x, y), keys, ["x", "y"], reach, reach, block_rows)
    return fr.own(_derived(fr.df, fr.window, "y", "gradient", method, smooth)).select(*keys, "x", "gradient")


def second_derivative(df: DataFrame, keys: Sequence[str], x: str, y: str, method: str = "central",
                      smooth: int | None = None, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, x, second: the gradient of the gradient."""
    reach = 2 * _reach(smooth)
    fr = framed(_points(df, keys, x, y), keys, ["x", "y"], reach, reach, block_rows)
    first = _derived(fr.df, fr.window, "y", "_first", method, smooth)
    second = _derived(first, fr.window, "_first", "second", method, smooth)
    return fr.own(second).select(*keys, "x", "second")


def gradient_outliers(df: DataFrame, keys: Sequence[str], x: str, y: str, method: str = "central",
                      smooth: int | None = None, threshold: float = 3.0, absolute: bool = False,
                      block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, x, gradient, zscore: population z of the gradients of a series."""
    g = gradient(df, keys, x, y, method, smooth, block_rows)
    v = F.abs("gradient") if absolute else F.col("gradient")
    stats = g.groupBy(*keys).agg(
        F.avg(v).alias("_mean"), F.stddev_pop(v).alias("_std"), F.count(v).alias("_n")).filter("_n >= 2 AND _std > 0")
    z = join_same(g, stats, keys).withColumn(
        "zscore", (v - F.col("_mean")) / F.col("_std"))
    return z.filter(F.abs("zscore") > threshold).select(*keys, "x", "gradient", "zscore")


def turning_points(df: DataFrame, keys: Sequence[str], x: str, y: str, inflection_threshold: float = 0.01,
                   extrema_threshold: float = 0.01, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, type, x, y: where the second (inflection) or first derivative
    (maximum, minimum) changes sign, placed by linear interpolation."""
    fr = framed(_points(df, keys, x, y), keys, ["x", "y"], 6, 6, block_rows)
    w = fr.window
    at = lambda c, k: F.lag(c, -k).over(w)
    first, _ = _slope(w, "x", "y", "central")
    # the fall-back of a two-point series has no second derivative
    rows = fr.df.withColumn("d1", F.when(at("x", -1).isNotNull(), first))
    two = at("d1", -1).isNull() & at("d1", 1).isNotNull() & at("d1", 2).isNull()
    second = (F.when(at("d1", -1).isNotNull() & at("d1", 1).isNotNull(),
                     F.try_divide(at("d1", 1) - at("d1", -1), at("x", 1) - at("x", -1)))
               .when(two, F.try_divide(at("d1", 1) - F.col("d1"), at("x", 1) - F.col("x"))))
    rows = rows.withColumn("d2", second)

    def crossing(d: str, limit: float) -> tuple[Column, Column]:
        now, then = F.col(d), at(d, 1)
        t = F.when(F.abs(then - now) > 1e-10, F.try_divide(-now, then - now)).otherwise(F.lit(0.0))
        return F.coalesce((now * then <= 0) & (F.abs(now) < limit), F.lit(False)), t

    hit2, t2 = crossing("d2", inflection_threshold)
    hit1, t1 = crossing("d1", extrema_threshold)
    rows = rows.withColumns({"_dx": at("x", 1) - F.col("x"), "_dy": at("y", 1) - F.col("y"),
                             "_hit2": hit2, "_t2": t2, "_hit1": hit1, "_t1": t1,
                             "_here": F.coalesce("d2", at("d2", 1), at("d2", -1)),
                             "_next": F.coalesce(at("d2", 1), at("d2", 2), F.col("d2"))})
    bend = F.when(F.col("_t1") == 0, F.col("_here")).otherwise(F.col("_next"))
    extreme = F.col("_hit1") & bend.isNotNull()
    kinds = F.array(
        F.when(F.col("_hit2"), F.struct(F.lit("inflection").alias("type"), F.col("_t2").alias("t"))),
        F.when(extreme, F.struct(F.when(bend < 0, "maximum").otherwise("minimum").alias("type"), F.col("_t1").alias("t"))))
    found = fr.own(rows.withColumn("_k", F.explode(kinds)).filter("_k IS NOT NULL"))
    return found.select(*keys, F.col("_k.type").alias("type"), (F.col("x") + F.col("_k.t") * F.col("_dx")).alias("x"),
                        (F.col("y") + F.col("_k.t") * F.col("_dy")).alias("y"))


def _segmented(df: DataFrame, keys: Sequence[str], x: str, y: str, segments: int, block_rows: int | None) -> DataFrame:
    points = _points(df, keys, x, y)
    placed = positions(points, keys, ["x", "y"], "pos", block_rows)
    sizes = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.filter(F.col("_n") >= 2 * segments)
    out = join_same(placed, sizes, keys)
    place = F.least(F.floor((F.col("pos") - 1) / F.floor(F.col("_n") / segments)), F.lit(segments - 1))
    return out.select(*keys, "x", "y", "pos", place.cast("int").alias("segment"))


def piecewise_slopes(df: DataFrame, keys: Sequence[str], x: str, y: str, segments: int = 5,
                     method: str = "linear", block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, segment, start_x, end_x, slope, intercept of equal-count pieces.

    ``linear`` is least squares, ``robust`` the median of the slopes between
    all pairs of points (found by counting, see ``_median_pair_slope``), and
    ``ends`` joins the first and the last point.
    """
    rows = _segmented(df, keys, x, y, segments, block_rows)
    group = [*keys, "segment"]
    ends = [F.min("x").alias("start_x"), F.max("x").alias("end_x")]
    if method == "linear":
        return rows.groupBy(*group).agg(*ends, F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"))
    if method == "ends":
        a, b = F.min_by(F.struct("x", "y"), "pos"), F.max_by(F.struct("x", "y"), "pos")
        out = rows.groupBy(*group).agg(*ends, a.alias("_a"), b.alias("_b"))
        slope = F.try_divide(F.col("_b.y") - F.col("_a.y"), F.col("_b.x") - F.col("_a.x"))
        return out.select(*group, "start_x", "end_x", slope.alias("slope"), (F.col("_a.y") - slope * F.col("_a.x")).alias("intercept"))
    if method != "robust":
        raise ValueError("method must be linear, robust or ends")
    from .pair_slopes import median_pair_slopes
    from ..functions.quantiles import quantile_columns
    slopes = median_pair_slopes(rows, group, block_rows=block_rows)
    middle = quantile_columns(rows, ["x", "y"], {"m": 0.5}, group)
    mid = middle.groupBy(*group).agg(F.max(F.when(F.col("variable") == "x", F.col("m"))).alias("_mx"),
                                     F.max(F.when(F.col("variable") == "y", F.col("m"))).alias("_my"))
    out = rows.groupBy(*group).agg(*ends).join(slopes, group).join(mid, group)
    return out.select(*group, "start_x", "end_x", "slope", (F.col("_my") - F.col("slope") * F.col("_mx")).alias("intercept"))


def slope_breaks(df: DataFrame, keys: Sequence[str], x: str, y: str, size: int = 5, threshold: float = 2.0,
                 block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, x, y, slope1, slope2, ratio: neighbouring windows of ``size`` rows
    whose least-squares slopes differ by more than the factor or in sign."""
    fr = framed(_points(df, keys, x, y), keys, ["x", "y"], 0, 2 * size, block_rows)
    part = lambda a, b: F.coalesce(F.regr_slope("y", "x").over(fr.window.rowsBetween(a, b)), F.lit(0.0))
    at = lambda c, k: F.lag(c, -k).over(fr.window)
    rows = fr.df.withColumns({
        "slope1": part(0, size - 1), "slope2": part(size, 2 * size - 1), "_full": at("x", 2 * size - 1).isNotNull(),
        "_x": (at("x", size - 1) + at("x", size)) / 2, "_y": (at("y", size - 1) + at("y", size)) / 2})
    s1, s2 = F.col("slope1"), F.col("slope2")
    plain = F.abs(F.try_divide(s2, s1))
    over = F.lit(threshold + 1.0)
    ratio = (F.when((F.abs(s1) < 1e-10) & (F.abs(s2) < 1e-10), F.lit(1.0)).when(F.abs(s1) < 1e-10, over)
              .when(s1 * s2 < 0, F.greatest(plain, over)).otherwise(plain))
    out = fr.own(rows.withColumn("ratio", ratio).filter("_full"))
    return out.filter((F.col("ratio") > threshold) | (F.col("ratio") < 1.0 / threshold)).select(
        *keys, F.col("_x").alias("x"), F.col("_y").alias("y"), "slope1", "slope2", "ratio")


def as_series(df: DataFrame, keys: Sequence[str], x: str, columns: Sequence[str]) -> DataFrame:
    """keys, series, x, y: many columns as many series."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("series"), number(c).alias("y")) for c in columns]))
    return df.select(*keys, x, cells.alias("s")).select(*keys, "s.series", F.col(x), "s.y")


def series_summary(df: DataFrame, keys: Sequence[str], x: str, columns: Sequence[str], threshold: float = 3.0,
                   segments: int = 5, window: int = 5, block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Per series and column: gradients, outliers, turning points, breaks."""
    long = as_series(df, keys, x, columns)
    group = [*keys, "series"]
    block_rows = settled(long, group, block_rows)
    args = (long, group, x, "y")
    g = gradient(*args, block_rows=block_rows).groupBy(*group).agg(
        F.count(F.lit(1)).alias("gradients"), F.avg("gradient").alias("mean_gradient"), F.max(F.abs("gradient")).alias("steepest"))
    out = gradient_outliers(*args, threshold=threshold, block_rows=block_rows).groupBy(*group).agg(F.count(F.lit(1)).alias("outliers"))
    turn = turning_points(*args, inflection_threshold=float("inf"), extrema_threshold=float("inf"), block_rows=block_rows).groupBy(*group).agg(
        F.count_if(F.col("type") == "inflection").alias("inflections"), F.count_if(F.col("type") == "maximum").alias("maxima"),
        F.count_if(F.col("type") == "minimum").alias("minima"))
    pieces = piecewise_slopes(*args, segments=segments, block_rows=block_rows).groupBy(*group).agg(F.count(F.lit(1)).alias("pieces"))
    breaks = slope_breaks(*args, size=window, block_rows=block_rows).groupBy(*group).agg(F.count(F.lit(1)).alias("breaks"))
    for part in (out, turn, pieces, breaks):
        g = g.join(part, group, "left")
    return g.fillna(0)


