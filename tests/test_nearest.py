"""Nearest points through the packed tree, against all distances."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statwright.operators import curves, nearest


def layouts():
    rng = np.random.default_rng(4)
    yield "plane", rng.normal(size=(700, 2)), rng.normal(size=(900, 2))
    yield "one x", np.c_[np.full(300, 2.0), rng.normal(size=300)], np.c_[np.full(2000, 2.0), rng.normal(size=2000) * 5]
    yield "one spot", rng.normal(size=(50, 2)), np.full((400, 2), 0.25)
    yield "line and cluster", rng.normal(size=(200, 2)) * 50, np.r_[np.c_[np.linspace(0, 1, 500), np.zeros(500)], rng.normal(size=(500, 2)) * 1e-9 + 30]
    yield "far away", rng.normal(size=(60, 2)) + 1e6, rng.normal(size=(600, 2))


@pytest.mark.parametrize("block_rows", [2_000_000, 150])
def test_tree_finds_the_nearest(spark, block_rows):
    asked, targets, want = [], [], {}
    for name, a, b in layouts():
        asked.append(pd.DataFrame({"k": name, "id": np.arange(len(a)), "x": a[:, 0], "y": a[:, 1]}))
        targets.append(pd.DataFrame({"k": name, "x": b[:, 0], "y": b[:, 1]}))
        away = np.hypot(a[:, None, 0] - b[None, :, 0], a[:, None, 1] - b[None, :, 1]).min(axis=1)
        want.update({(name, i): v for i, v in enumerate(away)})
    asked.append(pd.DataFrame({"k": ["no targets"], "id": [0], "x": [0.0], "y": [0.0]}))
    got = nearest.nearest_distances(spark.createDataFrame(pd.concat(asked)), spark.createDataFrame(pd.concat(targets)), ["k"], "id", 16, block_rows, 4).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.distance == pytest.approx(want[r.k, r.id], rel=1e-12, abs=1e-12)


def test_targets_of_one_x_do_not_meet_all_points(spark):
    """Rows that leave the descent: a few leaves a point, not all 313."""
    asked = spark.range(2_000).select(F.lit(1).alias("k"), "id", F.lit(0.0).alias("x"), (F.col("id") * 5.0 + 0.3).alias("y"))
    targets = spark.range(10_000).select(F.lit(1).alias("k"), F.lit(0.0).alias("x"), F.col("id").cast("double").alias("y"))
    out = nearest.nearest_distances(asked, targets, ["k"], "id", 32)
    assert out.agg(F.sum("distance"), F.count("id")).first() == (pytest.approx(2_000 * 0.3), 2_000)
    rows = out._jdf.queryExecution().executedPlan()  # noqa: SLF001
    assert "CartesianProduct" not in rows.toString() and "NestedLoop" not in rows.toString()


def test_a_long_query_curve_stays_a_table(spark):
    wave = spark.range(12_000).select(F.lit(0).alias("c"), F.col("id").alias("seq"), (F.col("id") / 12_000).alias("x"), F.sin(F.col("id") / 300).alias("y"))
    other = wave.filter("seq % 7 = 0").withColumns({"c": F.lit(1), "y": F.col("y") + 0.5})
    got = curves.best_matches(wave, wave.unionByName(other), "c", 2, samples=None).collect()
    assert [r.c for r in got] == [0, 1] and got[0].distance_sum == pytest.approx(0, abs=1e-6) and got[1].distance_sum > 1


def greedy(rows, tolerance):
    kept, seen = [], set()
    rows = sorted(rows)
    for s, x, y in rows[:-1]:
        if (x, y) not in seen and all(np.hypot(x - a, y - b) >= tolerance for _, a, b in kept):
            kept.append((s, x, y))
        seen.add((x, y))
    return kept + rows[-1:]


@pytest.mark.parametrize("group_points", [200_000, 7])
def test_near_repeats_of_groups_cut_by_seq(spark, group_points):
    rng = np.random.default_rng(6)
    frames, want = [], {}
    for name, n, spread in [("dense", 120, 1.0), ("loose", 60, 30.0), ("line", 80, 0.0), ("one", 1, 1.0)]:
        p = np.round(np.c_[np.arange(n) * 0.03 if name == "line" else rng.random(n) * spread, rng.random(n) * spread], 3)
        p = p[rng.permutation(n)]
        frames.append(pd.DataFrame({"c": name, "seq": np.arange(n), "x": p[:, 0], "y": p[:, 1]}))
        want[name] = greedy([(i, *map(float, v)) for i, v in enumerate(p)], 0.1)
    got = curves.drop_near_repeats(spark.createDataFrame(pd.concat(frames)), "c", 0.1, group_points=group_points)
    for name, rows in want.items():
        assert sorted((r.seq, r.x, r.y) for r in got.filter(F.col("c") == name).collect()) == rows


def test_a_long_chain_is_settled_in_few_rounds(spark):
    """Each point is near the one before it only; every second one goes."""
    chain = spark.range(100_000).select(F.lit("a").alias("c"), F.col("id").alias("seq"), (F.col("id") * 0.75).alias("x"), F.lit(0.0).alias("y"))
    got = curves.drop_near_repeats(chain, "c", 1.0)
    assert got.agg(F.count("seq"), F.sum(F.col("seq") % 2)).first() == (50_001, 1)


def star(spokes, inner, swap=False):
    """A zigzag around a spot that it never meets; swapped inner points make it cross itself."""
    turn = np.arange(spokes) * 2 * np.pi / spokes
    near = turn + np.pi / spokes
    if swap:
        near[[10, spokes // 2]] = near[[spokes // 2, 10]]
    p = np.empty((2 * spokes, 2))
    p[::2], p[1::2] = np.c_[np.cos(turn), np.sin(turn)], inner * np.c_[np.cos(near), np.sin(near)]
    return p


@pytest.mark.parametrize("depth", [0, 3, 24])
def test_lines_around_a_spot(spark, depth):
    shapes = {"apart": star(500, 1e-13), "crossed": star(500, 1e-13, True), "wide": star(100, 0.5), "wide crossed": star(100, 0.5, True),
              "met": np.concatenate([star(20, 0.3), [[0.0, 0.0]], star(20, 0.3) * 2, [[9.0, 9.0]]])}
    frames = [pd.DataFrame({"c": k, "seq": np.arange(len(p)), "x": p[:, 0], "y": p[:, 1]}) for k, p in shapes.items()]
    got = {r.c: r.crosses for r in curves.self_intersections(spark.createDataFrame(pd.concat(frames)), "c", max_depth=depth).collect()}
    assert got == {"apart": False, "crossed": True, "wide": False, "wide crossed": True, "met": True}
