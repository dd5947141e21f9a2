"""Interpolating cubics through any number of knots, exactly, in chunks.

The second derivatives at the knots solve one tridiagonal system per curve.
It is cut at every ``size``-th knot.  Inside a chunk the unknowns are an affine
function of the two values at its cuts; a task finds that function and sends
only its two ends (a handful of numbers).  The cuts of a curve then solve a
small tridiagonal system of their own, one row per chunk, and with its
solution each chunk finishes its own knots and points.  Nothing is left out
and no neighbouring knots are copied, however uneven the spacing is.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import join_same, positions
from ..functions.sizes import spread_out
from ..functions.storage import written

CHUNK_KNOTS = 50_000


def solve(lower: np.ndarray, main: np.ndarray, upper: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A diagonally dominant tridiagonal system with several right sides: every step links rows twice as far apart.
    Axes between the first and the last are systems side by side."""
    lower, main, upper, right = lower.copy(), main.copy(), upper.copy(), right.copy()
    lower[0] = upper[-1] = 0.0
    step, n = 1, len(main)
    while step < n:
        a, c = np.zeros_like(main), np.zeros_like(main)
        a[step:], c[:-step] = -lower[step:] / main[:-step], -upper[:-step] / main[step:]
        new_main, new_right = main.copy(), right.copy()
        new_main[step:] += a[step:] * upper[:-step]
        new_main[:-step] += c[:-step] * lower[step:]
        new_right[step:] += a[step:, ..., None] * right[:-step]
        new_right[:-step] += c[:-step, ..., None] * right[step:]
        new_lower, new_upper = np.zeros_like(main), np.zeros_like(main)
        new_lower[step:] = a[step:] * lower[:-step]
        new_upper[:-step] = c[:-step] * upper[step:]
        lower, main, upper, right = new_lower, new_main, new_upper, new_right
        step *= 2
    return right / main[..., None]


def system(u: np.ndarray, v: np.ndarray, first: bool, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the inner knots of a chunk.  At an end of the curve the third
    derivative is the same on both sides of the next knot, which gives the end value from its two neighbours."""
    h = np.diff(u, axis=0)
    right = 6 * np.diff(np.diff(v, axis=0) / h[..., None], axis=0)
    main, upper, lower = 2 * (h[:-1] + h[1:]), h[1:].copy(), h[:-1].copy()
    if first:
        r = h[0] / h[1]
        main[0] += h[0] * (1 + r)
        upper[0] -= h[0] * r
    if last:
        r = h[-1] / h[-2]
        main[-1] += h[-1] * (1 + r)
        lower[-1] -= h[-1] * r
    return lower, main, upper, right


def bends(u: np.ndarray, v: np.ndarray, left: np.ndarray | None, right: np.ndarray | None) -> np.ndarray:
    """Second derivatives at the knots of a chunk; None at an end of the curve, else the value at the cut."""
    h = np.diff(u, axis=0)
    lower, main, upper, d = system(u, v, left is None, right is None)
    if left is not None:
        d[0] -= h[0] * left
    if right is not None:
        d[-1] -= h[-1] * right
    m = solve(lower, main, upper, d)
    if left is None:
        r = (h[0] / h[1])[..., None]
        left = (1 + r) * m[0] - r * m[1]
    if right is None:
        r = (h[-1] / h[-2])[..., None]
        right = (1 + r) * m[-1] - r * m[-2]
    return np.concatenate([left[None], m, right[None]])


def values(u: np.ndarray, v: np.ndarray, at: np.ndarray, left: np.ndarray | None = None, right: np.ndarray | None = None) -> np.ndarray:
    """The cubic through the columns of v; a parabola for a curve of three knots."""
    if len(u) == 3 and left is None and right is None:
        a, b, c = u
        t = at[:, None]
        return (v[0] * (t - b) * (t - c) / ((a - b) * (a - c)) + v[1] * (t - a) * (t - c) / ((b - a) * (b - c))
                + v[2] * (t - a) * (t - b) / ((c - a) * (c - b)))
    m, h = bends(u, v, left, right), np.diff(u)
    k = np.clip(np.searchsorted(u, at, side="right") - 1, 0, len(u) - 2)
    t, s, w = (at - u[k])[:, None], (u[k + 1] - at)[:, None], h[k][:, None]
    return ((m[k] * s ** 3 + m[k + 1] * t ** 3) / (6 * w) + (v[k] / w - m[k] * w / 6) * s
            + (v[k + 1] / w - m[k + 1] * w / 6) * t)


def many_values(u: np.ndarray, x: np.ndarray, y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values`` of whole curves with equally many knots, a column a curve: x and y, a row a point."""
    n, curves = len(at), u.shape[1]
    if len(u) == 3:
        a, b, c = u
        t = at[:, None]
        one, two, three = (t - b) * (t - c), (t - a) * (t - c), (t - a) * (t - b)
        low, mid, high = (a - b) * (a - c), (b - a) * (b - c), (c - a) * (c - b)
        x, y = (v[0] * one / low + v[1] * two / mid + v[2] * three / high for v in (x, y))
        return x, y
    m, h = bends(u, np.stack([x, y], axis=-1), None, None), np.diff(u, axis=0)
    # a knot counts from the first point at or after it
    past = np.zeros((n + 1, curves), np.int32)
    np.add.at(past, (np.searchsorted(at, u.ravel()), np.tile(np.arange(curves), len(u))), 1)
    k = np.clip(np.cumsum(past[:n], axis=0) - 1, 0, len(u) - 2) * curves + np.arange(curves)
    w = h.ravel()[k]
    t, s = at[:, None] - u.ravel()[k], u.ravel()[k + curves] - at[:, None]
    out = []
    for c, v in enumerate((x, y)):
        low, high, v = m[:-1, :, c].ravel()[k], m[1:, :, c].ravel()[k], v.ravel()
        out.append((low * s * s * s + high * t * t * t) / (6 * w) + (v[k] / w - low * w / 6) * s + (v[k + curves] / w - high * w / 6) * t)
    return out[0], out[1]


#: What a chunk sends: the inner value next to each cut is p + q * (left cut) + r * (right cut).
ENDS = ["px", "py", "q", "r"]
SENT = [f"{side}_{c}" for side in ("head", "tail") for c in (*ENDS, "h", "sx", "sy")]


def chunk_ends(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("u")
    u, v = pdf["u"].to_numpy(), pdf[["x", "y"]].to_numpy()
    chunk, chunks = int(pdf["_chunk"].iloc[0]), int(pdf["_chunks"].iloc[0])
    lower, main, upper, d = system(u, v, chunk == 0, chunk + 1 == chunks)
    h, cuts = np.diff(u), np.zeros((len(d), 2))
    cuts[0, 0] = 0.0 if chunk == 0 else -h[0]
    cuts[-1, 1] = 0.0 if chunk + 1 == chunks else -h[-1]
    got = solve(lower, main, upper, np.hstack([d, cuts]))
    slope = np.diff(v, axis=0) / h[:, None]
    return pd.DataFrame([[*got[0], h[0], *slope[0], *got[-1], h[-1], *slope[-1]]], columns=SENT)


def cut_values(pdf: pd.DataFrame) -> pd.DataFrame:
    """Values at the cuts of one curve: the row of a cut joins the ends of the chunks on its two sides."""
    pdf = pdf.sort_values("_chunk")
    before, after = pdf.iloc[:-1].reset_index(drop=True), pdf.iloc[1:].reset_index(drop=True)
    hl, hr = before["tail_h"].to_numpy(), after["head_h"].to_numpy()
    lower, upper = hl * before["tail_q"].to_numpy(), hr * after["head_r"].to_numpy()
    main = hl * before["tail_r"].to_numpy() + 2 * (hl + hr) + hr * after["head_q"].to_numpy()
    right = np.column_stack([6 * (after[f"head_s{c}"].to_numpy() - before[f"tail_s{c}"].to_numpy()) - hl * before[f"tail_p{c}"].to_numpy() - hr * after[f"head_p{c}"].to_numpy()
                             for c in "xy"])
    m = solve(lower, main, upper, right)
    gap = np.full((1, 2), np.nan)
    left, last = np.vstack([gap, m]), np.vstack([m, gap])
    return pd.DataFrame({"_chunk": pdf["_chunk"].to_numpy(), "lx": left[:, 0], "ly": left[:, 1], "rx": last[:, 0], "ry": last[:, 1]})


def _points(n: int):
    def evaluate(us: pd.Series, xs: pd.Series, ys: pd.Series, lefts: pd.Series, rights: pd.Series, ends: pd.Series) -> pd.DataFrame:
        grid, out = np.linspace(0, 1, n), []
        for u, x, y, left, right, end in zip(us, xs, ys, lefts, rights, ends, strict=True):
            # a point belongs to the chunk that holds the knot at or before it
            take = (grid >= u[0]) & ((grid < u[-1]) | bool(end))
            p = values(u, np.column_stack([x, y]), grid[take], None if left is None else np.array(left), None if right is None else np.array(right))
            out.append((np.flatnonzero(take) + 1, p[:, 0], p[:, 1]))
        return pd.DataFrame(out, columns=["seq", "x", "y"])
    return evaluate


def spline_points(knots: DataFrame, key: str, n: int, size: int = CHUNK_KNOTS, block_rows: int | None = None) -> DataFrame:
    """key, seq, x, y: n points at equal steps of ``u`` (0 to 1) on the cubic through the knots (key, u, x, y);
    curves have three knots or more, with different u.  A chunk has ``size`` to 2 * ``size`` - 1 steps."""
    size = max(4, size)
    count = knots.groupBy(key).agg(F.count(F.lit(1)).alias("_m"))
    placed = join_same(positions(knots, [key], ["u"], "_i", block_rows).withColumn("_i", F.col("_i") - 1), count, [key])
    placed = placed.withColumn("_chunks", F.greatest(F.lit(1), F.floor((F.col("_m") - 1) / size)).cast("long"))
    own = F.least(F.floor(F.col("_i") / size).cast("long"), F.col("_chunks") - 1)
    # a knot at a cut belongs to both chunks
    both = F.array_compact(F.array(own, F.when((F.col("_i") == own * size) & (own > 0), own - 1)))
    dealt = placed.select(key, "u", "x", "y", "_chunks", F.explode(both).alias("_chunk"))
    several = written(dealt.filter("_chunks > 1"))
    kind = knots.schema[key]
    number = lambda c: T.StructField(c, T.DoubleType())
    name = T.StructType([kind, T.StructField("_chunk", T.LongType())])

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        return chunk_ends(pdf).assign(**{key: pdf[key].iloc[0], "_chunk": pdf["_chunk"].iloc[0]})[[key, "_chunk", *SENT]]

    def cuts(pdf: pd.DataFrame) -> pd.DataFrame:
        return cut_values(pdf).assign(**{key: pdf[key].iloc[0]})[[key, "_chunk", "lx", "ly", "rx", "ry"]]
    sent = several.groupBy(key, "_chunk").applyInPandas(ends, T.StructType([*name.fields, *map(number, SENT)]))
    at_cuts = sent.groupBy(key).applyInPandas(cuts, T.StructType([*name.fields, *map(number, ("lx", "ly", "rx", "ry"))]))
    pair = lambda s: F.when(F.col(f"{s}x").isNotNull() & ~F.isnan(f"{s}x"), F.array(f"{s}x", f"{s}y"))
    at_cuts = written(at_cuts.select(key, "_chunk", pair("l").alias("_left"), pair("r").alias("_right")))
    sets = dealt.groupBy(key, "_chunk", "_chunks").agg(F.array_sort(F.collect_list(F.struct("u", "x", "y"))).alias("_knots"))
    sets = join_same(spread_out(sets, key, "_chunk"), at_cuts, [key, "_chunk"], "left")
    spline = F.pandas_udf(_points(n), "seq array<bigint>, x array<double>, y array<double>")
    made = sets.select(key, spline("_knots.u", "_knots.x", "_knots.y", "_left", "_right", F.col("_chunk") + 1 == F.col("_chunks")).alias("_made"))
    return made.select(key, F.explode(F.arrays_zip("_made.seq", "_made.x", "_made.y")).alias("_at")).select(key, "_at.*")
