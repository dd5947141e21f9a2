"""Short curves, many at a time, against the chunked way and against all distances."""

import numpy as np
from pyspark.sql import functions as F

from statwright.operators import curves, whole_curves


def odd_curves(spark):
    """Repeated, close and chained x, unknown and infinite values, one to nine points a curve."""
    rng = np.random.default_rng(12)
    rows = []
    for c in range(80):
        n = int(rng.integers(1, 10))
        x = (np.arange(n) if c % 8 == 1 else rng.integers(0, 6, n)) + rng.choice([0, 0, 4e-9, 9e-9, 1.3e-8, 2.2e-8], n)
        y = np.round(rng.normal(size=n), 3)
        p = [[c, i, float(a), float(b)] for i, (a, b) in enumerate(zip(x, y, strict=True))]
        if c % 8 == 1 and n > 3:
            p[int(rng.integers(n))][int(rng.integers(2, 4))] = None
        if c % 8 == 2:
            p[0][3] = float("nan")
        if c % 8 == 3:
            p[-1][2] = float("inf")
        rows += p + p[:1] if c % 8 == 4 else p
    rows += [[None, i, float(i), 1.0] for i in range(5)]
    return spark.createDataFrame(rows, "curve int, seq int, x double, y double")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")  # noqa: SLF001


def listed(df):
    return sorted(df.select(*[c for c in ("curve", "seq") if c in df.columns], *[
        F.format_string("%s", F.round(c, 6) + 0) for c, t in df.dtypes if t == "double"]).collect(), key=str)


def test_short_curves_as_in_chunks(spark):
    df = odd_curves(spark)
    whole = curves.resample(df, "curve", 20)
    cut = curves.resample(df, "curve", 20, chunk_knots=2)
    assert whole.count() > 700 and listed(whole) == listed(cut)
    assert whole.schema == cut.schema


def test_short_and_long_curves_together(spark):
    df = odd_curves(spark)
    assert listed(curves.resample(df, "curve", 20)) == listed(curves.resample(df, "curve", 20, chunk_knots=5))


def test_points_of_short_curves_meet_once(spark):
    """One shuffle and nothing written: disk for the points once, not for every step."""
    rows = spark.range(3_000).select(F.floor(F.col("id") / 6).alias("curve"), (F.col("id") % 6).alias("seq"),
                                     (F.col("id") % 6).cast("double").alias("x"), F.sin("id").alias("y"))
    out = curves.resample(rows, "curve", 10)
    assert out.count() == 5_000 and exchanges(out) == 1


def test_rounded_as_spark_rounds(spark):
    rng = np.random.default_rng(14)
    halves = (rng.integers(0, 10 ** 9, 500) + 0.5) / 1e6
    x = np.r_[rng.normal(size=500) * 10.0 ** rng.integers(-9, 13, 500), halves, -halves, np.nextafter(halves, 9e9), np.nextafter(halves, 0),
              0.0, -0.0, -1e-9, 5e-7, -5e-7, 1e300, -1e300, 2.0 ** 52 + 0.5, 4503599627.370497, 1e11 + 1e-5, np.inf, -np.inf]
    want = [r[0] for r in spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "i int, x double").orderBy("i").select(F.round("x", 6)).collect()]
    with np.errstate(all="ignore"):
        got = whole_curves.half_up(x, 6).tolist()
        assert np.isnan(whole_curves.half_up(np.array([np.nan]), 6)).all()
    assert list(map(repr, got)) == list(map(repr, want))
    df = odd_curves(spark)
    assert listed(curves.resample(df, "curve", 20, digits=6)) == listed(curves.resample(df, "curve", 20))


def all_distances(query, points, n):
    """Sums from every point of the resampled query to the nearest of each curve of n points."""
    q = curves.resample(curves.normalise(query, "curve"), "curve", n).toPandas()[["x", "y"]].to_numpy()
    made = curves.resample(curves.normalise(points, "curve"), "curve", n).toPandas()
    out = {}
    for c, p in made.groupby("curve"):
        if len(p) == n:
            p = p[["x", "y"]].dropna().to_numpy()
            out[c] = np.hypot(q[:, None, 0] - p[None, :, 0], q[:, None, 1] - p[None, :, 1]).min(axis=1).sum() if len(p) else np.inf
    return out


def test_matches_are_those_of_all_distances(spark):
    """Curves of three points, long ones and unknown values among the others; two points never match."""
    t, rng = np.arange(5000), np.random.default_rng(13)
    rows = [(100, int(i), float(i), float(np.sin(i / 700))) for i in t]
    rows += [(c, i, i + float(rng.random() / 2), float(rng.normal())) for c in range(30) for i in range(2 + c % 9)]
    rows += [(200, i, float(i), None if i == 2 else 1.0 + i) for i in range(6)]
    df = spark.createDataFrame(rows, "curve int, seq int, x double, y double")
    query = df.filter("curve = 7")
    want = all_distances(query, df, 150)
    got = curves.best_matches(query, df, "curve", 99, 150).collect()
    assert {r.curve for r in got} == set(want) and got[0].curve == 7 and len(got) == 28
    assert np.allclose([r.distance_sum for r in got], sorted(want.values()), atol=1e-9)
    assert all(abs(r.distance_sum - want[r.curve]) < 1e-9 or want[r.curve] == np.inf == r.distance_sum for r in got)


def test_no_row_for_each_curve_and_point_of_the_query(spark):
    """The query goes to the curves: it is not multiplied by them and shuffled."""
    rows = spark.range(6_000).select(F.floor(F.col("id") / 6).alias("curve"), (F.col("id") % 6).alias("seq"),
                                     (F.col("id") % 6).cast("double").alias("x"), F.sin("id").alias("y"))
    out = curves.best_matches(rows.filter("curve = 3"), rows, "curve", 2, 150)
    assert out.first() == (3, 0.0)
    plan = out._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_negative_zero_as_key(spark):
    df = spark.createDataFrame([(-0.0, i, float(i), float(i * i)) for i in range(5)], "curve double, seq int, x double, y double")
    assert {str(r.curve) for r in curves.resample(df, "curve", 10).collect()} == {"0.0"}
    assert [str(r.curve) for r in curves.best_matches(df, df, "curve", 1, 10).collect()] == ["0.0"]
