"""Normal distribution as columns, Shapiro-Wilk and K squared at any size, pair tables."""

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statwright.functions import special
from statwright.functions.normal import erfc, normal_cdf, normal_quantile
from statwright.functions.quantiles import quantiles
from statwright.operators import inference, normality


def test_normal_columns(spark):
    x = [*np.linspace(-9, 9, 2001), 0.46875, -0.46875, 4.0, -4.0, 26.0, -30.0, 40.0, 0.0, 1e-300]
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", erfc(F.col("x")).alias("e"), normal_cdf(F.col("x")).alias("c")).collect()
    for r in rows:
        assert r.e == pytest.approx(math.erfc(r.x), rel=1e-12, abs=1e-300) and r.c == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), rel=1e-12)
    p = [*np.linspace(1e-6, 1 - 1e-6, 2001), 1e-15, 1e-100, 1 - 1e-13, 0.075, 0.925]
    for r in spark.createDataFrame([(float(v),) for v in p], "p double").select("p", normal_quantile(F.col("p")).alias("q")).collect():
        assert r.q == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-12)
    ends = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p double").select(normal_quantile(F.col("p"))).collect()
    assert [r[0] for r in ends] == [-math.inf, math.inf, None]


@pytest.mark.parametrize("n", [3, 4, 5, 6, 11, 12, 50, 4999, 5000, 20_000])
def test_shapiro_wilk_of_any_size(spark, n):
    rng = np.random.default_rng(n)
    frame = pd.DataFrame({"k": ["a"] * n + ["b"] * n, "x": np.concatenate([rng.normal(1e4, 2, n), np.round(rng.exponential(5, n), 1)])})
    df = spark.createDataFrame(frame).repartition(3)
    for sizes in ({}, {"block_rows": max(5, n // 3)}):
        got = {r.k: r for r in normality.shapiro_wilk(df, ["k"], "x", **sizes).collect()}
        for k in "ab":
            w, p = special.shapiro_wilk(frame.x[frame.k == k].to_numpy())
            assert got[k].n == n and got[k].statistic == pytest.approx(w, rel=1e-9) and got[k].p_value == pytest.approx(p, rel=1e-6, abs=1e-12)


def test_normality_table(spark):
    df = spark.createDataFrame([(float(i), 7.0, None, float(i) if i < 2 else None) for i in range(30)], "a double, b double, c double, d double")
    got = {r.variable: r for r in inference.normality(df, ["a", "b", "c", "d"]).collect()}
    assert got["a"].test == "Shapiro-Wilk" and got["b"].statistic == 1.0 and got["b"].p_value == 1.0
    assert got["c"].test is None and got["d"].statistic is None and got["d"].fits is None
    assert inference.normality(df, ["a"], test="dagostino").first().test == "D'Agostino's K^2"
    assert inference.normality(df, ["a"], test="auto").first().test == "Shapiro-Wilk"
    with pytest.raises(ValueError):
        inference.normality(df, ["a"], test="other")


def test_automatic_choice_by_size(spark):
    rows = spark.range(12_000).select((F.col("id") % 2).cast("string").alias("k"), (F.randn(3) * 2).alias("x"))
    got = normality.group_tests(rows, ["k"], "x", "auto").collect()
    assert {r.test for r in got} == {"D'Agostino's K^2"} and {r.n for r in got} == {6000}
    assert {r.test for r in inference.group_normality(rows, "x", "k").collect()} == {"Shapiro-Wilk"}


@pytest.mark.parametrize("n,kind", [(8, "normal"), (100, "expon"), (3000, "normal")])
def test_k_squared(spark, n, kind):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n) if kind == "normal" else rng.exponential(size=n)
    z = (x - x.mean()) / x.std()
    want = special.dagostino_k2(n, float((z ** 3).mean()), float((z ** 4).mean() - 3))
    r = normality.dagostino(spark.createDataFrame(pd.DataFrame({"x": x})), [], "x").first()
    assert (r.statistic, r.p_value) == (pytest.approx(want[0], rel=1e-9), pytest.approx(want[1], rel=1e-9))
    assert normality.dagostino(spark.createDataFrame([(1.0,)] * 9, "x double"), [], "x").first().statistic is None


def test_pair_tables(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"g": [f"g{i % 4}" for i in range(200)], "v": np.round(rng.normal(size=200) + np.arange(200) % 4 * 0.3, 1)})
    df = spark.createDataFrame(frame)
    groups = {g: p.v for g, p in frame.groupby("g")}
    mse = sum(((v - v.mean()) ** 2).sum() for v in groups.values()) / (200 - 4)
    got = {(r.group1, r.group2): r for r in inference.tukey(df, "v", "g").collect()}
    assert len(got) == 6
    for (a, b), r in got.items():
        q = abs(groups[b].mean() - groups[a].mean()) / math.sqrt(mse / 2 * (1 / 50 + 1 / 50))
        assert r.statistic == pytest.approx(q) and r.p_value == pytest.approx(special.studentized_range_sf(q, 4, 196)) and r.reject == (r.p_value < 0.05)
    ranks = frame.v.rank()
    ties = sum(c ** 3 - c for c in frame.v.value_counts())
    base = 200 * 201 / 12 - ties / (12 * 199)
    for r in inference.dunn(df, "v", "g").collect():
        z = abs(ranks[frame.g == r.group1].mean() - ranks[frame.g == r.group2].mean()) / math.sqrt(base * 2 / 50)
        assert r.statistic == pytest.approx(z) and r.p_value == pytest.approx(min(1, 2 * special.norm_sf(z) * 6))
    flat = inference.dunn(df.withColumn("v", F.lit(1.0)), "v", "g").collect()
    assert len(flat) == 6 and all(r.p_value is None for r in flat)


def test_quantiles_of_many_large_groups(spark):
    """Groups on both sides of the sketch's accuracy, a hot value, a hot group; all columns from one sketch."""
    rng = np.random.default_rng(9)
    parts = [pd.DataFrame({"k": f"g{i}", "x": rng.lognormal(0, 4, n), "y": np.where(rng.random(n) < 0.4, 3.0, np.round(rng.normal(size=n), 2))})
             for i, n in enumerate([1, 2, 7, 300, 4100, 9000, 15_000, 40_000])]
    frame = pd.concat(parts)
    frame.loc[frame.index % 50 == 3, "y"] = np.nan
    df = spark.createDataFrame(frame).repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.977, 1.0]
    got = quantiles(df, ["x", "y"], probs, ["k"], exact_rows=100, block_rows=300).collect()
    assert len(got) == 8 * 2 * 6
    for r in got:
        want = frame.loc[frame.k == r.k, r.variable].quantile(r.prob)
        assert (r.value is None and math.isnan(want)) or r.value == pytest.approx(want, rel=1e-12, abs=1e-12)
    for r in quantiles(df, ["x", "y"], probs, exact_rows=100).collect():
        assert r.value == pytest.approx(frame[r.variable].quantile(r.prob), rel=1e-12, abs=1e-12)
