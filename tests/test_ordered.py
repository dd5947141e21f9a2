"""The shared building blocks, with groups forced to be split."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statwright.functions.ordered import framed, positions, running_sum, value_counts_ranked
from statwright.functions.quantiles import quantiles
from statwright.functions.sizes import broadcast_if_small


def hot(spark, n=300, seed=1):
    """Two thirds of the rows in one key, a third of them with one value."""
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.67, "hot", rng.choice(["a", "b", "c"], n))
    x = np.where(rng.random(n) < 0.33, 5.0, rng.integers(0, 60, n).astype(float))
    pdf = pd.DataFrame({"k": key, "x": x, "id": np.arange(n), "v": rng.integers(1, 9, n)})
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("block_rows", [10, 2_000_000, None])
def test_running_sum(spark, block_rows):
    pdf, df = hot(spark)
    got = running_sum(df, ["k"], ["x", "id"], {"s": "v"}, block_rows).toPandas().sort_values(["k", "x", "id"])
    want = pdf.sort_values(["k", "x", "id"])
    assert (got["s"].to_numpy() == want.groupby("k")["v"].cumsum().to_numpy()).all()


@pytest.mark.parametrize("block_rows", [7, 2_000_000])
def test_positions_number_every_row_once(spark, block_rows):
    pdf, df = hot(spark)
    got = positions(df, ["k"], ["x"], "p", block_rows).toPandas()
    assert len(got) == len(pdf)
    for _, part in got.groupby("k"):
        assert sorted(part["p"]) == list(range(1, len(part) + 1))
        assert part.sort_values("p")["x"].is_monotonic_increasing


@pytest.mark.parametrize("block_rows", [9, 2_000_000])
def test_framed_neighbours(spark, block_rows):
    pdf, df = hot(spark)
    fr = framed(df, ["k"], ["x", "id"], 3, 2, block_rows)
    rows = fr.df.withColumns({"back": F.lag("id", 3).over(fr.window), "ahead": F.lead("id", 2).over(fr.window)})
    got = fr.own(rows).toPandas().sort_values(["k", "x", "id"])
    want = pdf.sort_values(["k", "x", "id"])
    assert len(got) == len(want)
    assert np.array_equal(got["back"].to_numpy(float), want.groupby("k")["id"].shift(3).to_numpy(), equal_nan=True)
    assert np.array_equal(got["ahead"].to_numpy(float), want.groupby("k")["id"].shift(-2).to_numpy(), equal_nan=True)


def test_average_rank(spark):
    pdf, df = hot(spark)
    got = value_counts_ranked(df, [], "x", 8).toPandas()
    rank = dict(zip(got["x"], got["upto"] - (got["n"] - 1) / 2))
    assert np.allclose(pdf["x"].map(rank), pdf["x"].rank())


@pytest.mark.parametrize("exact_rows", [0, 2_000_000])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_quantiles_are_exact(spark, exact_rows, keys):
    pdf, df = hot(spark)
    df = df.withColumn("x", F.when(F.col("id") % 17 == 0, F.lit(float("nan"))).otherwise(F.col("x")))
    pdf.loc[pdf["id"] % 17 == 0, "x"] = np.nan
    probs = [0, 0.01, 0.25, 0.5, 0.9, 1]
    got = quantiles(df, ["x", "v"], probs, keys, exact_rows=exact_rows, block_rows=11).collect()
    assert len(got) == 2 * len(probs) * (pdf["k"].nunique() if keys else 1)
    for r in got:
        part = pdf[pdf["k"] == r.k] if keys else pdf
        assert r.value == pytest.approx(part[r.variable].quantile(r.prob))


def test_narrow_quantiles_of_many_distinct_values(spark):
    values = np.random.default_rng(3).lognormal(0, 3, 40_000)
    df = spark.createDataFrame(pd.DataFrame({"x": values})).repartition(4)
    got = {r.prob: r.value for r in quantiles(df, ["x"], [0.001, 0.5, 0.999], exact_rows=0, block_rows=50).collect()}
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, x double, id long, v long")
    assert positions(df, ["k"], ["x"]).count() == 0
    assert all(r.value is None for r in quantiles(df, ["x"], [0.5]).collect())


def test_broadcast_needs_a_counted_size(spark):
    df = spark.range(50)
    assert broadcast_if_small(df, 10) is df
    assert broadcast_if_small(df, 100) is not df
