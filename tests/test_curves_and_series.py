"""Ordered series and curves, also with everything forced into small blocks."""

import math

import numpy as np
import pandas as pd
import pytest

from statwright.operators import curves, nearest, series

BLOCKS = [6, 2_000_000]


def table(spark, shapes):
    rows = [(k, i, float(x), float(y)) for k, pts in shapes.items() for i, (x, y) in enumerate(pts)]
    return spark.createDataFrame(rows, "curve string, seq long, x double, y double").repartition(3)


def listed(df, key="a"):
    return [(r.x, r.y) for r in df.filter(f"curve = '{key}'").orderBy("seq").collect()]


@pytest.mark.parametrize("block_rows", BLOCKS)
@pytest.mark.parametrize("smooth", [None, 3, 5, 4])
def test_gradient(spark, block_rows, smooth):
    rng = np.random.default_rng(0)
    x, y = np.sort(rng.random(41)) * 9, rng.normal(size=41)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "x": x, "y": y})).repartition(3)
    got = series.gradient(df, ["k"], "x", "y", "central", smooth, block_rows).orderBy("x").toPandas()
    want = (y[2:] - y[:-2]) / (x[2:] - x[:-2])
    if smooth == 4:
        want = pd.Series(want).rolling(4, center=True).mean().to_numpy()
    elif smooth:
        h, g, order = smooth // 2, want.copy(), min(3, smooth - 1)
        fit = lambda lo, at: np.polyval(np.polyfit(np.arange(smooth), g[lo:lo + smooth], order), at)
        want = np.array([fit(min(max(i - h, 0), len(g) - smooth), i - min(max(i - h, 0), len(g) - smooth)) for i in range(len(g))])
    assert np.allclose(got["x"], x[1:-1]) and np.allclose(got["gradient"], want, equal_nan=True)


def test_two_point_series_falls_back(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 5.0), ("b", 0.0, 1.0)], "k string, x double, y double")
    assert [(r.k, r.gradient) for r in series.gradient(df, ["k"], "x", "y").collect()] == [("a", 2.0)]


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_turning_points_of_a_sine(spark, block_rows):
    x = np.linspace(0, 2 * math.pi, 61)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "x": x, "y": np.sin(x)}))
    rows = series.turning_points(df, ["k"], "x", "y", 0.2, 0.2, block_rows).collect()
    at = {r.type: r.x for r in rows}
    assert at["maximum"] == pytest.approx(math.pi / 2, abs=0.02) and at["minimum"] == pytest.approx(1.5 * math.pi, abs=0.02)
    assert at["inflection"] == pytest.approx(math.pi, abs=0.02)


@pytest.mark.parametrize("block_rows", [25, 2_000_000])
def test_slopes_of_pieces(spark, block_rows):
    x = np.arange(80.0)
    y = np.where(x < 40, x, 40 - 3 * (x - 40))
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "x": x, "y": y}))
    for method in ("linear", "ends", "robust"):
        rows = series.piecewise_slopes(df, ["k"], "x", "y", 2, method, block_rows).orderBy("segment").collect()
        assert [r.slope for r in rows] == pytest.approx([1, -3], abs=1e-6)
    breaks = series.slope_breaks(df, ["k"], "x", "y", 5, 2.0, block_rows).collect()
    assert breaks and all(30 < r.x < 50 for r in breaks)


@pytest.mark.parametrize("block_rows", BLOCKS)
def test_measures(spark, block_rows):
    df = table(spark, {"a": [(0, 0), (3, 4), (3, 4), (6, 8)], "b": [(1, 1)]})
    assert {r.curve: r.length for r in curves.length(df, "curve", block_rows).collect()} == {"a": 10.0, "b": 0.0}
    p = {r.curve: r for r in curves.proportions(df, "curve", block_rows).collect()}
    assert p["a"].aspect_ratio == pytest.approx(10 / 6) and p["b"].aspect_ratio is None
    flat = table(spark, {"a": [(i / 100, 0) for i in range(6)] + [(3, 3)], "c": [(0, 0), (0.1, 1)]})
    assert flat.count() and {r.curve: r.leading_radius for r in curves.leading_radius(flat, "curve").collect()}["c"] is None
    ring = table(spark, {"a": [(2 - 2 * math.cos(t), 2 * math.sin(t)) for t in (-0.9, -0.5, -0.2, 0.15, 0.6, 1.1)]})
    assert curves.leading_radius(ring, "curve").first().leading_radius == pytest.approx(2)
    line = table(spark, {"a": [(0, 0), (1, 1), (2, 2), (2.01, 2.01), (2.02, 2.02), (2.03, 2.03), (2.04, 2.04), (3, 3)]})
    assert curves.trailing_angle(line, "curve").first().trailing_angle == pytest.approx(45)


def test_formats(spark):
    shapes = {"split": [(1, 0), (0, 0), (1, 1), (0, 1)], "partial_split": [(1, 0), (0, 0), (1, 1), (0.5, 1)],
              "closed": [(0, 0), (1, 1), (2, 0), (1, -1), (0, 0)], "unordered": [(0, 0), (2, 0), (1, 1)]}
    got = {r.curve: r.format for r in curves.curve_format(table(spark, shapes), "curve").collect()}
    assert got == {k: k for k in shapes}


def split_by_hand(p, right, left):
    runs = []
    for r, l in zip(right[:2], left[:2]):
        runs.append(p[r:l + 1] if r < l else p[l:r + 1][::-1])
    up, down = (runs[1], runs[0]) if np.mean(runs[0], 0)[1] < np.mean(runs[1], 0)[1] else (runs[0], runs[1])
    return up + down[::-1]


@pytest.mark.parametrize("block_rows", [3, 2_000_000])
def test_reordering(spark, block_rows):
    upper = [(1, 0.0), (0.6, 0.3), (0.2, 0.2), (0, 0.0)]
    lower = [(0, 0.01), (0.3, -0.2), (0.7, -0.1), (1, 0.01)]
    shapes = {"split": upper + lower, "partial": [(1, 0), (0, 0), (1, 1), (0.5, 1)], "free": [(0, 0), (2, 0), (1, 1), (1.5, -1), (0.5, 1)]}
    out = curves.reorder(table(spark, shapes), "curve", block_rows)
    assert listed(out, "split") == split_by_hand([(float(x), y) for x, y in upper + lower], [0, 7], [3, 4])
    part = listed(out, "partial")
    assert part[0] in [(1.0, 1.0), (0.0, 0.0)] and len(part) in (3, 4)
    assert listed(out, "free") == [(2.0, 0.0), (1.5, -1.0), (0.0, 0.0), (0.5, 1.0), (1.0, 1.0), (2.0, 0.0)]


def test_partial_split_known_case(spark):
    # first run: point 1 and 2 of the list; second: the rest, from there around
    out = curves.reorder(table(spark, {"a": [(1, 0), (0, 0), (1, 1), (0.5, 1)]}), "curve")
    # points 1 and 2 rise in x, so that run is turned; the rest (0.5, 1), (1, 0)
    # rises too and runs in the direction wanted for it
    assert listed(out) == [(1.0, 1.0), (0.0, 0.0), (0.5, 1.0), (1.0, 0.0)]


def test_closing_and_simplifying(spark):
    df = table(spark, {"a": [(0, 0), (1, 1), (2, 0)], "b": [(0, 0), (1, 1), (0, 0)]})
    out = curves.close(df, "curve")
    assert listed(out)[-1] == (0.0, 0.0) and out.filter("curve = 'b'").count() == 3
    df = table(spark, {"a": [(0, 0), (1, 1e-6), (2, 0), (3, 1)]})
    assert len(listed(curves.simplify(df, "curve"))) == 3


def crosses(p):
    p = [q for i, q in enumerate(p) if i == 0 or q != p[i - 1]]
    ring = len(p) > 3 and p[0] == p[-1]

    def turn(a, b, c):
        return np.sign((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]))
    n = len(p) - 1
    for i in range(n):
        for j in range(i + 1, n):
            a, b, c, d = p[i], p[i + 1], p[j], p[j + 1]
            if j == i + 1:
                if turn(a, b, d) == 0 and (b[0] - a[0]) * (d[0] - b[0]) + (b[1] - a[1]) * (d[1] - b[1]) < 0:
                    return True
                continue
            if ring and i == 0 and j == n - 1:
                continue
            box = max(a[0], b[0]) >= min(c[0], d[0]) and max(c[0], d[0]) >= min(a[0], b[0]) and max(a[1], b[1]) >= min(c[1], d[1]) and max(c[1], d[1]) >= min(a[1], b[1])
            if box and turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0:
                return True
    return False


@pytest.mark.parametrize("cell", [3, 48])
def test_self_intersections(spark, cell):
    rng = np.random.default_rng(6)
    shapes = {"cross": [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)], "plain": [(0, 0), (1, 1), (2, 0), (0, 0)],
              "spiral": [(t * math.cos(t), t * math.sin(t)) for t in np.linspace(1, 12, 60)],
              "back": [(0, 0), (2, 0), (1, 0), (1, 3), (9, 9)]}
    for i in range(8):
        shapes[f"r{i}"] = [tuple(v) for v in np.column_stack([np.arange(7) + rng.normal(0, 0.8, 7), rng.normal(size=7)])]
    got = {r.curve: r.crosses for r in curves.self_intersections(table(spark, shapes), "curve", cell).collect()}
    assert got == {k: crosses([tuple(map(float, q)) for q in p[:-1]]) for k, p in shapes.items()}


def test_resampling(spark):
    x = np.sort(np.random.default_rng(8).random(400)) * 5
    df = table(spark, {"a": list(zip(x, np.sin(3 * x))), "two": [(0, 0), (1, 1)], "three": [(0, 0), (1, 1), (2, 2)]})
    whole = curves.resample(df, "curve", 50)
    cut = curves.resample(df, "curve", 50, block_rows=70, chunk_knots=30)
    assert np.allclose(listed(whole), listed(cut), atol=1e-9) and len(listed(whole)) == 50
    got = np.array(listed(whole))
    assert np.abs(got[:, 1] - np.sin(3 * got[:, 0])).max() < 1e-2 and (np.diff(got[:, 0]) >= 0).all()
    assert listed(whole, "two") == [(0.0, 0.0), (1.0, 1.0)]
    assert np.allclose([p[0] for p in listed(whole, "three")], np.linspace(0, 2, 50))


def test_close_x_are_averaged(spark):
    df = table(spark, {"a": [(0, 0), (1, 1), (1 + 1e-9, 1.2), (2, 2)]})
    assert [(round(r.x, 6), r.y) for r in curves.merged_by_x(df, "curve").orderBy("x").collect()] == [(0.0, 0.0), (1.0, 1.1), (2.0, 2.0)]


@pytest.mark.parametrize("block_points, block_rows", [(256, 2_000_000), (4, 2_000_000), (4, 15)])
def test_nearest_distances(spark, block_points, block_rows):
    rng = np.random.default_rng(9)
    a = {"a": rng.random((50, 2)) * 3 - 1, "b": rng.random((5, 2))}
    b = {"a": np.round(rng.random((60, 2)), 1), "b": rng.random((3, 2))}
    near = nearest.nearest_distances(table(spark, a), table(spark, b), ["curve"], "seq", block_points, block_rows).collect()
    assert len(near) == 55
    for r in near:
        want = np.hypot(*(b[r.curve] - a[r.curve][r.seq]).T).min()
        assert r.distance == pytest.approx(want)


def test_matching(spark):
    t = np.linspace(0, math.pi, 30)
    shapes = {"same": np.column_stack([3 * t + 1, 3 * np.sin(t)]), "flat": np.column_stack([t, 0.1 * np.sin(t)]), "dip": np.column_stack([t, -np.sin(t)])}
    query = table(spark, {"q": np.column_stack([t, np.sin(t)])})
    rows = curves.best_matches(query, table(spark, shapes), "curve", 2, samples=40).collect()
    assert rows[0].curve == "same" and rows[0].distance_sum == pytest.approx(0, abs=1e-6) and len(rows) == 2


@pytest.mark.parametrize("tolerance", [1e-8, 0.15, 0.4])
def test_near_repeats(spark, tolerance):
    rng = np.random.default_rng(10)
    shapes = {"a": [tuple(v) for v in np.round(rng.random((60, 2)), 2)], "b": [(0, 0), (0, 0), (1, 1), (0, 0)]}
    got = curves.drop_near_repeats(table(spark, shapes), "curve", tolerance)
    for k, p in shapes.items():
        kept = [p[0]]
        for q in p[1:-1]:
            if all(math.hypot(q[0] - r[0], q[1] - r[1]) >= tolerance for r in kept):
                kept.append(q)
        assert listed(got, k) == [tuple(map(float, q)) for q in [*kept, p[-1]]]


def test_clean_up(spark):
    df = table(spark, {"a": [(0, 0), (2, 0), (1, 1), (1.5, -1), (0.5, 1)]})
    points, report = curves.clean_up(df, "curve")
    r = report.first()
    assert (r.format, r.points_before, r.points_after) == ("unordered", 5, 6)
