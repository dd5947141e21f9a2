"""Outliers, tests, correlation and regression against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statwright.functions import special
from statwright.operators import components, correlation, inference, outliers, pair_slopes, regression
from statwright.plans import workflows


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 400
    a = rng.normal(10, 2, n)
    b = 0.8 * a + rng.normal(0, 1, n)
    c = np.round(rng.exponential(3, n))
    a[:5] = [60, 70, -40, 55, 52]
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "c": c, "g": rng.choice(["p", "q", "r"], n)})
    pdf.loc[7, "c"] = np.nan
    return pdf, spark.createDataFrame(pdf).repartition(3)


def test_iterative_bounds(data):
    pdf, df = data
    x, last = pdf["a"].to_numpy(), None
    for both, rounds in ((False, 5), (True, 10)):
        for _ in range(rounds):
            z = (x - x.mean()) / x.std()
            keep = np.abs(z) <= 3 if both else z <= 3
            lo, hi = x[keep].min(), x[keep].max()
            if last and abs(hi - last[1]) < 1e-3 and (not both or abs(lo - last[0]) < 1e-3):
                break
            x, last = x[keep], (lo, hi)
    got = outliers.iterative_bounds(df, "a").first()
    assert (got.min_value, got.max_value) == (pytest.approx(x.min()), pytest.approx(x.max()))


def test_fences_need_four_values(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    assert outliers.fence_table(df, ["x"]).first().q1 is None
    assert not outliers.flag_by_iqr(df, ["x"]).filter("is_iqr_outlier").count()


def test_constant_column_has_zero_scores(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [r.x_zscore for r in outliers.z_scores(df, ["x"]).collect()] == [0.0, 0.0]


def test_workflow_partitions_the_rows(data):
    pdf, df = data
    w = workflows.outlier_workflow(df, "id", ["a", "b"])
    rows = w.consensus.rows.collect()
    assert all(1 <= r.method_count <= 3 for r in rows)
    removed = sum(r.method_count >= 2 for r in rows)
    assert w.cleaned.count() + removed == len(pdf) and removed >= 5


def test_components(data):
    pdf, df = data
    model = components.fit(df, ["a", "b", "c"])
    z = pdf[["a", "b", "c"]].dropna()
    z = (z - z.mean()) / z.std(ddof=0)
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T, ddof=0)))[::-1]
    assert np.allclose(model.values, values) and model.ratios.sum() == pytest.approx(1)
    share = np.cumsum(values) / values.sum()
    assert model.kept == int(np.argmax(share >= 0.95)) + 1
    out = components.scores(df, model)
    assert out.agg(F.avg("PC1")).first()[0] == pytest.approx(0, abs=1e-9)
    assert out.agg(F.var_pop("PC1")).first()[0] == pytest.approx(values[0])


def test_split_is_exact_and_disjoint(data):
    pdf, df = data
    for exact in ({"n": 123}, {"fraction": 0.7}):
        a, b = inference.split_sample(df, "id", **exact)
        assert a.count() == (123 if "n" in exact else 280) and a.count() + b.count() == len(pdf)
        assert a.join(b, "id").count() == 0
    assert inference.split_sample(df, "id", n=999)[0].count() == len(pdf)


def test_repeated_samples(data):
    pdf, df = data
    rows = inference.repeated_samples(df, "id", "a", 12, 20, 10.0).collect()
    assert len(rows) == 12 and all(r.n == 20 and r.mean_low < r["mean"] < r.mean_high for r in rows)
    again = inference.repeated_samples(df.repartition(7), "id", "a", 12, 20, 10.0).collect()
    assert {r.run: r["mean"] for r in rows} == pytest.approx({r.run: r["mean"] for r in again})


@pytest.mark.parametrize("block_rows", [20, 2_000_000])
def test_fit_statistics(data, block_rows):
    pdf, df = data
    x = np.sort(pdf["c"].dropna().to_numpy())
    n = len(x)
    f = 1 - np.exp(-x / x.mean())
    i = np.arange(1, n + 1)
    want = max((i / n - f).max(), (f - (i - 1) / n).max())
    got = inference.kolmogorov_smirnov(df, "c", "expon", block_rows=block_rows).first()
    assert got.statistic == pytest.approx(want) and 0 <= got.statistic <= 1
    x = np.sort(pdf["b"].to_numpy())
    z = (x - x.mean()) / x.std(ddof=1)
    low = np.array([special.norm_cdf(v) for v in z])
    want = -n - 1 - np.sum((2 * np.arange(1, n + 2) - 1) * (np.log(low) + np.log(1 - low[::-1]))) / (n + 1)
    got = inference.anderson_darling(df, "b", "norm", block_rows=block_rows).first()
    assert got.statistic == pytest.approx(want) and got.level == 0.05


def test_rank_tests(data):
    pdf, df = data
    two = df.filter("g <> 'r'")
    p2 = pdf[pdf["g"] != "r"].dropna(subset=["c"])
    x, y = p2[p2["g"] == "p"]["c"].to_numpy(), p2[p2["g"] == "q"]["c"].to_numpy()
    u = sum((v > y).sum() + 0.5 * (v == y).sum() for v in x)
    assert inference.mann_whitney(two, "c", "g", block_rows=10).first().statistic == pytest.approx(u)
    p3 = pdf.dropna(subset=["c"])
    r, n = p3["c"].rank(), len(p3)
    h = 12 / (n * (n + 1)) * sum(v.sum() ** 2 / len(v) for _, v in r.groupby(p3["g"])) - 3 * (n + 1)
    t = p3["c"].value_counts()
    assert inference.kruskal(df, "c", "g").first().statistic == pytest.approx(h / (1 - (t ** 3 - t).sum() / (n ** 3 - n)))
    assert inference.compare_groups(df, "c", "g").first().test == "Kruskal-Wallis H test"


def test_exact_mann_whitney(spark):
    df = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0)] + [("b", v) for v in (4.0, 5.0, 6.0, 7.0)], "g string, v double")
    r = inference.mann_whitney(df, "v", "g").first()
    assert r.statistic == 0 and r.p_value == pytest.approx(2 / 35)


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 25}])
def test_spearman(data, sizes):
    pdf, df = data
    got = {(r.var1, r.var2): r.r for r in correlation.correlation_pairs(df, ["a", "b", "c"], "spearman", **sizes).collect()}
    for (x, y), r in got.items():
        part = pdf[[x, y]].dropna()
        assert r == pytest.approx(part[x].rank().corr(part[y].rank()))


@pytest.mark.parametrize("bits, block_rows", [(18, 2_000_000), (3, 2_000_000), (2, 30)])
def test_kendall_counts_all_pairs(data, bits, block_rows):
    pdf, df = data
    points = correlation._weighted_points(df, [("a", "c"), ("b", "c")])
    got = {r.var1: r.r for r in correlation._kendall(points, chunk_bits=bits, block_rows=block_rows).collect()}
    for x, r in got.items():
        p = pdf[[x, "c"]].dropna().to_numpy()
        i, j = np.triu_indices(len(p), 1)
        s, t = np.sign(p[i, 0] - p[j, 0]), np.sign(p[i, 1] - p[j, 1])
        assert r == pytest.approx((s * t).sum() / np.sqrt(np.abs(s).sum() * np.abs(t).sum()))


def test_disorder_counts(spark):
    rng = np.random.default_rng(2)
    x, v = rng.integers(0, 20, 150).astype(float), rng.integers(0, 30, 150).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"k": "a", "x": x, "v": v}))
    want = sum((x[i] < x[j]) and (v[i] > v[j]) for i in range(150) for j in range(150))
    assert pair_slopes._count_disorder(df, ["k"], 20).first().inv == want
    assert pair_slopes._below(x, v + 0 * x, 0.0) == want


def test_median_slope_by_counting():
    rng = np.random.default_rng(4)
    for n in (70, 101):
        x, y = np.round(rng.random(n) * 40), rng.normal(size=n)
        i, j = np.triu_indices(n, 1)
        d = x[j] - x[i]
        want = np.median((y[j] - y[i])[d != 0] / d[d != 0])
        assert pair_slopes.median_slope(x, y) == pytest.approx(want, abs=1e-12)


def test_multiple_fit(data):
    pdf, df = data
    p = pdf.dropna()
    design = np.column_stack([np.ones(len(p)), p["a"], p["c"]])
    beta, *_ = np.linalg.lstsq(design, p["b"], rcond=None)
    rest = p["b"] - design @ beta
    error = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * (rest @ rest) / (len(p) - 3))
    out = regression.multiple_fit(df, "b", ["a", "c"])
    rows = out.coefficients.collect()
    assert np.allclose([r.coefficient for r in rows], beta) and np.allclose([r.std_error for r in rows], error)
    assert out.model.first().r2 == pytest.approx(1 - rest @ rest / ((p["b"] - p["b"].mean()) ** 2).sum())


def test_stepwise_drops_a_collinear_pair_at_once(data):
    pdf, df = data
    df = df.withColumn("twin", F.col("a") * 2 + F.col("id") % 2 * 1e-3).withColumn("noise", (F.col("id") * 7919) % 101)
    got = regression.stepwise(df, "b", ["a", "c", "noise"])
    assert got.selected[0] == "a" and "noise" not in got.selected
    empty = regression.stepwise(df, "noise", ["c"])
    assert empty.selected == [] and empty.inflation.count() == 0 and empty.coefficients.count() == 1


def test_share_sweep_equals_single_fits(data):
    pdf, df = data
    sweep = {r.test_percent: r for r in regression.share_sweep(df, "id", "b", ["a", "c"]).collect()}
    one = regression.split_fit(df.dropna(), "id", "b", ["a", "c"], 40).model.filter("side = 'test'").first()
    assert sweep[40].r2 == pytest.approx(one.r2) and sweep[40].test_rows == one.n


def test_quadratic_projection(spark):
    rows = [("k", y, 2.0 + 0.5 * (y - 2000) - 0.1 * (y - 2000) ** 2) for y in range(2000, 2009)]
    df = spark.createDataFrame(rows, "k string, yr int, v double")
    out = {r.yr: r.fitted for r in regression.project_quadratic(df, "k", "yr", "v", 2).collect()}
    assert out[2010] == pytest.approx(2 + 5 - 10) and len(out) == 11
    line = {r.yr: r.projected for r in regression.project_linear(df.withColumn("v", F.col("yr") * 2.0), "k", "yr", "v").collect()}
    assert line == pytest.approx({y: 2.0 * y for y in range(2009, 2014)})


def test_clusters_scale_by_the_population(spark):
    rows = [(i, float(i % 5), 3.0) for i in range(10)]
    out = regression.clusters(spark.createDataFrame(rows, "id int, x double, c double"), ["x", "c"], 2, elbow=[1, 5], starts=3)
    cost = {r.k: r.cost for r in out.elbow.collect()}
    assert cost[1] == 10.0 and abs(cost[5]) < 1e-9
    assert out.rows.count() == 10


def test_two_groups_are_named(spark):
    df = spark.createDataFrame([(g, float(v)) for g, v in zip("aabbcc", (1, 2, 5, 7, 9, 12))], "g string, v double")
    for test in (inference.two_group_t, inference.mann_whitney):
        with pytest.raises(ValueError):
            test(df, "v", "g")
        assert test(df, "v", "g", ["b", "c"]).first() == test(df.filter("g <> 'a'"), "v", "g").first()


def test_constant_values_have_no_statistic(spark):
    df = spark.createDataFrame([(g, 2.0) for g in "aabbcc"], "g string, v double")
    assert inference.two_group_t(df, "v", "g", ["a", "b"]).first().statistic is None
    assert inference.kruskal(df, "v", "g").first().statistic is None
    assert {r.statistic for r in inference.dunn(df, "v", "g").collect() + inference.tukey(df, "v", "g").collect()} == {None}


def test_exact_ranks_of_unequal_groups():
    from itertools import combinations
    n1, n2 = 3, 6
    us = [sum(c) - n1 * (n1 + 1) // 2 for c in combinations(range(1, n1 + n2 + 1), n1)]
    for u in range(9, 19):
        assert inference._exact_mann_whitney(u, n1, n2) == pytest.approx(min(1.0, 2 * sum(x >= u for x in us) / len(us)))


def test_slopes_of_large_groups_with_any_key_name(spark, monkeypatch):
    monkeypatch.setattr(pair_slopes, "ROUNDS", 1)  # each round is several Spark jobs
    df = spark.createDataFrame([(7, float(x), y) for x, y in enumerate((0.0, 1.0, 5.0, 3.0))], "k int, x double, y double")
    got = pair_slopes.median_pair_slopes(df, ["k"], group_rows=2)
    assert got.columns == ["k", "slope"] and [r.k for r in got.collect()] == [7]
