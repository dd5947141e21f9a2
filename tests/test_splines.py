"""Splines solved in chunks against one dense solve."""

import numpy as np
import pandas as pd
import pytest

from statwright.operators import splines


def dense(u, v, at):
    """All second derivatives at once, with the end conditions as rows of the system."""
    n, h = len(u), np.diff(u)
    a, d = np.zeros((n, n)), np.zeros((n, v.shape[1]))
    a[0, :3] = 1 / h[0], -1 / h[0] - 1 / h[1], 1 / h[1]
    a[-1, -3:] = 1 / h[-2], -1 / h[-2] - 1 / h[-1], 1 / h[-1]
    for i in range(1, n - 1):
        a[i, i - 1:i + 2] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        d[i] = 6 * ((v[i + 1] - v[i]) / h[i] - (v[i] - v[i - 1]) / h[i - 1])
    scale = np.abs(a).max(axis=1)[:, None]
    m = np.linalg.solve(a / scale, d / scale)
    k = np.clip(np.searchsorted(u, at, side="right") - 1, 0, n - 2)
    t, s, w = (at - u[k])[:, None], (u[k + 1] - at)[:, None], h[k][:, None]
    return (m[k] * s ** 3 + m[k + 1] * t ** 3) / (6 * w) + (v[k] / w - m[k] * w / 6) * s + (v[k + 1] / w - m[k + 1] * w / 6) * t


@pytest.mark.parametrize("n", [1, 2, 3, 17, 400])
def test_tridiagonal_systems(n):
    rng = np.random.default_rng(n)
    lower, upper, right = rng.normal(size=n), rng.normal(size=n), rng.normal(size=(n, 3))
    main = np.abs(lower) + np.abs(upper) + 0.1
    full = np.diag(main) + (np.diag(lower[1:], -1) + np.diag(upper[:-1], 1) if n > 1 else 0)
    assert np.allclose(splines.solve(lower, main, upper, right), np.linalg.solve(full, right), rtol=1e-11, atol=1e-12)


@pytest.mark.parametrize("size", [4, 5, 37, 10_000])
def test_chunks_give_the_whole_spline(spark, size):
    rng = np.random.default_rng(3)
    steps = {"even": np.ones(80), "uneven": 10 ** rng.uniform(-6, 0, 150), "jumps": np.tile([1e-5, 1.0, 1.0, 1e-4], 30), "four": rng.random(3) + 0.1,
             "eight": rng.random(7) + 0.1, "nine": rng.random(8) + 0.1, "thirteen": rng.random(12) + 0.1}
    frames, want = [], {}
    for name, h in steps.items():
        u = np.r_[0, np.cumsum(h)] / h.sum()
        v = np.column_stack([u * 3, np.cumsum(np.r_[0, h / h.sum()] * rng.normal(size=len(u)))])
        frames.append(pd.DataFrame({"k": name, "u": u, "x": v[:, 0], "y": v[:, 1]}))
        want[name] = dense(u, v, np.linspace(0, 1, 60))
    got = splines.spline_points(spark.createDataFrame(pd.concat(frames)), "k", 60, size).toPandas()
    for name, p in want.items():
        mine = got[got.k == name].sort_values("seq")
        assert mine.seq.tolist() == list(range(1, 61))
        assert np.abs(mine[["x", "y"]].to_numpy() - p).max() <= 1e-9 * max(1, np.abs(p).max())
