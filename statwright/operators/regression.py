"""Least squares, projections per key, trees and clusters.

Linear models are solved from one matrix of cross products, which one
aggregate computes whatever the number of rows; sub-models, splits and shares
reuse it.  Trees and clusters are those of ``pyspark.ml``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..functions.quantiles import number
from .components import complete_rows
from .correlation import inflation_factors


def simple_fits(df: DataFrame, response: str, predictors: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """One simple model per predictor: b0, b1, t, interval of b1, r2."""
    y = number(response)
    aggs = []
    for i, p in enumerate(predictors):
        x = number(p)
        aggs += [F.regr_slope(y, x).alias(f"b1_{i}"), F.regr_intercept(y, x).alias(f"b0_{i}"), F.regr_r2(y, x).alias(f"r2_{i}"),
                 F.regr_sxx(y, x).alias(f"sxx_{i}"), F.regr_syy(y, x).alias(f"syy_{i}"), F.regr_count(y, x).alias(f"n_{i}")]
    row = df.agg(*aggs).first()
    out = []
    for i, p in enumerate(predictors):
        n, b1, b0, r2, sxx, syy = (row[f"{k}_{i}"] for k in ("n", "b1", "b0", "r2", "sxx", "syy"))
        if b1 is None or n < 3:
            out.append((p, n, b0, b1, None, None, None, r2))
            continue
        error = math.sqrt(max(0.0, syy - b1 * b1 * sxx) / (n - 2) / sxx)
        half = special.t_ppf((1 + confidence) / 2, n - 2) * error
        out.append((p, n, b0, b1, b1 / error if error else math.inf, b1 - half, b1 + half, r2))
    return df.sparkSession.createDataFrame(out, "predictor string, n long, b0 double, b1 double, t double, low double, high double, r2 double")


class Moments(NamedTuple):
    """Count, means and centred cross products of columns (last: response)."""

    names: list[str]
    n: float
    means: np.ndarray
    products: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        if not self.n or not other.n:
            return self if self.n else other
        gap = other.means - self.means
        return Moments(self.names, n, self.means + gap * other.n / n,
                       self.products + other.products + np.outer(gap, gap) * self.n * other.n / n)


def _moment_columns(names: Sequence[str]) -> list[Column]:
    k = len(names)
    return ([F.count(F.lit(1)).alias("n")] + [F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(names)]
            + [F.covar_pop(number(names[i]), number(names[j])).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)])


def _read_moments(row, names: Sequence[str]) -> Moments:
    k, n = len(names), float(row.n)
    products = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            products[i, j] = products[j, i] = (row[f"c{i}_{j}"] or 0.0) * n
    return Moments(list(names), n, np.array([row[f"m{i}"] or 0.0 for i in range(k)]), products)


def moments(df: DataFrame, names: Sequence[str]) -> Moments:
    return _read_moments(complete_rows(df, names).agg(*_moment_columns(names)).first(), names)


class Fit(NamedTuple):
    names: list[str]
    coefficients: np.ndarray   # intercept first
    errors: np.ndarray
    t: np.ndarray
    p: np.ndarray
    n: float
    dof: float
    r2: float
    sse: float

    @property
    def adjusted(self) -> float:
        return 1 - (1 - self.r2) * (self.n - 1) / self.dof if self.dof > 0 else float("nan")

    @property
    def f(self) -> float:
        k = len(self.names)
        return (self.r2 / k) / ((1 - self.r2) / self.dof) if k and self.r2 < 1 else float("inf")

    @property
    def log_likelihood(self) -> float:
        return -self.n / 2 * (math.log(2 * math.pi) + math.log(max(self.sse, 1e-300) / self.n) + 1)

    @property
    def aic(self) -> float:
        return 2 * (len(self.names) + 1) - 2 * self.log_likelihood

    @property
    def bic(self) -> float:
        return math.log(self.n) * (len(self.names) + 1) - 2 * self.log_likelihood


def solve(m: Moments, predictors: Sequence[str], response: str) -> Fit:
    """Least squares of a subset of the columns from the shared products."""
    at, y = [m.names.index(p) for p in predictors], m.names.index(response)
    sxx, sxy, syy = m.products[np.ix_(at, at)], m.products[at, y], m.products[y, y]
    inverse = np.linalg.pinv(sxx) if at else np.zeros((0, 0))
    slopes = inverse @ sxy
    intercept = m.means[y] - slopes @ m.means[at]
    sse = max(0.0, float(syy - slopes @ sxy))
    dof = m.n - len(at) - 1
    scale = sse / dof if dof > 0 else float("nan")
    errors = np.sqrt(np.r_[scale * (1 / m.n + m.means[at] @ inverse @ m.means[at]), scale * np.diag(inverse)])
    coefficients = np.r_[intercept, slopes]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = coefficients / errors
    p = np.array([special.t_two_sided(float(v), dof) if math.isfinite(v) else 0.0 for v in t])
    return Fit(list(predictors), coefficients, errors, t, p, m.n, dof, 1 - sse / syy if syy > 0 else 0.0, sse)


COEFFICIENTS = "term string, coefficient double, std_error double, t double, p_value double, low double, high double"
MODEL = "n long, r2 double, adjusted_r2 double, f double, f_p_value double, aic double, bic double"


def coefficient_table(spark, fit: Fit, confidence: float = 0.95) -> DataFrame:
    q = special.t_ppf((1 + confidence) / 2, fit.dof)
    return spark.createDataFrame([
        (name, float(b), float(e), float(t), float(p), float(b - q * e), float(b + q * e))
        for name, b, e, t, p in zip(["(intercept)", *fit.names], fit.coefficients, fit.errors, fit.t, fit.p)], COEFFICIENTS)


def model_table(spark, fit: Fit) -> DataFrame:
    k = len(fit.names)
    f_p = special.f_sf(fit.f, k, fit.dof) if k and math.isfinite(fit.f) else 0.0
    return spark.createDataFrame([(int(fit.n), float(fit.r2), float(fit.adjusted), float(fit.f), float(f_p),
                                   float(fit.aic), float(fit.bic))], MODEL)


class Linear(NamedTuple):
    coefficients: DataFrame
    model: DataFrame


def multiple_fit(df: DataFrame, response: str, predictors: Sequence[str]) -> Linear:
    fit = solve(moments(df, [*predictors, response]), predictors, response)
    return Linear(coefficient_table(df.sparkSession, fit), model_table(df.sparkSession, fit))


class Stepwise(NamedTuple):
    selected: list[str]
    coefficients: DataFrame
    model: DataFrame
    full: DataFrame
    inflation: DataFrame


def stepwise(df: DataFrame, response: str, predictors: Sequence[str], enter: float = 0.05, leave: float = 0.10,
             max_inflation: float = 5.0) -> Stepwise:
    """Forward by the smallest p, backward by the largest, then all variables of
    high inflation at once.  A removed variable is not tried again."""
    m = moments(df, [*predictors, response])
    spread = np.sqrt(np.diag(m.products))
    chosen: list[str] = []
    waiting = list(predictors)
    p_of = lambda names, v: solve(m, names, response).p[1 + names.index(v)]

    def inflation(names):
        at = [m.names.index(v) for v in names]
        return inflation_factors(m.products[np.ix_(at, at)] / np.outer(spread[at], spread[at]))
    while waiting:
        best = min(waiting, key=lambda v: p_of([*chosen, v], v))
        if not p_of([*chosen, best], best) < enter:
            break
        chosen.append(best)
        waiting.remove(best)
        while chosen:
            worst = max(chosen, key=lambda v: p_of(chosen, v))
            if not p_of(chosen, worst) > leave:
                break
            chosen.remove(worst)
        if len(chosen) > 1:
            high = inflation(chosen) > max_inflation
            chosen = [v for v, drop in zip(chosen, high) if not drop]
    spark = df.sparkSession
    fit = solve(m, chosen, response)
    factors = inflation(chosen) if chosen else []
    return Stepwise(chosen, coefficient_table(spark, fit), model_table(spark, fit),
                    model_table(spark, solve(m, list(predictors), response)),
                    spark.createDataFrame([(c, float(v)) for c, v in zip(chosen, factors)], "variable string, vif double"))


def trend(df: DataFrame, x: str, y: str, logarithmic: bool = False, keys: Sequence[str] = ()) -> DataFrame:
    """slope, intercept, r and slope error of y on x or on ln x; the p-value is
    added for one whole-table trend."""
    cx = F.when(number(x) > 0, F.ln(number(x))) if logarithmic else number(x)
    cy = number(y)
    out = df.groupBy(*keys).agg(
        F.regr_count(cy, cx).alias("n"), F.regr_slope(cy, cx).alias("slope"), F.regr_intercept(cy, cx).alias("intercept"),
        F.corr(cy, cx).alias("r"), F.regr_sxx(cy, cx).alias("_sxx"), F.regr_syy(cy, cx).alias("_syy"))
    rest = F.col("_syy") - F.col("slope") * F.col("slope") * F.col("_sxx")
    out = out.withColumn("std_error", F.sqrt(F.greatest(F.try_divide(rest, (F.col("n") - 2) * F.col("_sxx")), F.lit(0.0)))).drop("_sxx", "_syy")
    if keys:
        return out
    r = out.first()
    p = special.t_two_sided(r.slope / r.std_error, r.n - 2) if r.slope is not None and r.std_error else None
    return out.withColumn("p_value", F.lit(p).cast("double"))


# ---- splits and errors ------------------------------------------------------

def bucket(row_id: str, buckets: int = 100, seed: int = 42) -> Column:
    """Repeatable bucket 0.. of a row."""
    return F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(buckets)).cast("int")


def prediction(fit: Fit) -> Column:
    parts = [number(c) * F.lit(float(b)) for c, b in zip(fit.names, fit.coefficients[1:])]
    return reduce(lambda a, b: a + b, parts, F.lit(float(fit.coefficients[0])))


def errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """n, mse, mae, r2 in one aggregate."""
    a, p = number(actual), number(predicted)
    both = a.isNotNull() & p.isNotNull()
    gap = a - p
    return df.filter(both).agg(
        F.count(F.lit(1)).alias("n"), F.avg(gap * gap).alias("mse"), F.avg(F.abs(gap)).alias("mae"),
        (1 - F.try_divide(F.avg(gap * gap), F.var_pop(a))).alias("r2"))


def split_fit(df: DataFrame, row_id: str, response: str, predictors: Sequence[str], test_percent: int = 30,
              standardise: bool = False, seed: int = 42) -> Linear:
    """Fit on the training buckets, errors on both sides.  ``standardise``
    reports coefficients per training deviation, largest first."""
    spot = bucket(row_id, 100, seed)
    train, test = df.filter(spot >= test_percent), df.filter(spot < test_percent)
    m = moments(train, [*predictors, response])
    fit = solve(m, predictors, response)
    side = lambda part, name: errors(part.withColumn("_p", prediction(fit)), response, "_p").select(F.lit(name).alias("side"), "*")
    table = coefficient_table(df.sparkSession, fit)
    if standardise:
        std = np.sqrt(np.diag(m.products) / m.n)
        rows = [(c, float(b * std[m.names.index(c)])) for c, b in zip(fit.names, fit.coefficients[1:])]
        table = df.sparkSession.createDataFrame(rows, "term string, coefficient double").orderBy(F.abs("coefficient").desc())
    return Linear(table, side(train, "train").unionByName(side(test, "test")))


def share_sweep(df: DataFrame, row_id: str, response: str, predictors: Sequence[str],
                test_percents: Sequence[int] = range(1, 90), seed: int = 42) -> DataFrame:
    """test_percent, r2 on the test rows, for many shares from one job: rows go
    to 100 buckets, and the products of any share are sums over buckets."""
    names = [*predictors, response]
    rows = complete_rows(df, names).groupBy(bucket(row_id, 100, seed).alias("b")).agg(*_moment_columns(names)).collect()
    per = {r.b: _read_moments(r, names) for r in rows}
    zero = Moments(list(names), 0.0, np.zeros(len(names)), np.zeros((len(names), len(names))))
    part = lambda low, high: reduce(lambda a, b: a + b, [per[b] for b in range(low, high) if b in per], zero)
    out = []
    for percent in test_percents:
        train, test = part(percent, 100), part(0, percent)
        if train.n <= len(predictors) + 1 or test.n < 2:
            continue
        fit = solve(train, predictors, response)
        w = np.r_[-fit.coefficients[1:], 1.0]
        bias = w @ test.means - fit.coefficients[0]
        sse = w @ test.products @ w + test.n * bias ** 2
        syy = test.products[-1, -1]
        out.append((int(percent), int(train.n), int(test.n), float(1 - sse / syy) if syy > 0 else None))
    return df.sparkSession.createDataFrame(out, "test_percent int, train_rows long, test_rows long, r2 double")


# ---- projections per key ----------------------------------------------------

def project_linear(df: DataFrame, key: str, x: str, y: str, ahead: int = 5, least: int = 3) -> DataFrame:
    """key, x, projected: the line of every key with enough points, continued
    for the next ``ahead`` steps."""
    cx, cy = F.col(x).cast("double"), number(y)
    fits = df.groupBy(key).agg(F.regr_slope(cy, cx).alias("_b"), F.regr_intercept(cy, cx).alias("_a"),
                               F.max(x).alias("_last"), F.regr_count(cy, cx).alias("_n")).filter(F.col("_n") >= least)
    steps = F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + ahead))
    return fits.withColumn(x, steps).select(key, x, (F.col("_a") + F.col("_b") * F.col(x)).alias("projected"))


def project_quadratic(df: DataFrame, key: str, x: str, y: str, ahead: int = 10) -> DataFrame:
    """key, x, fitted: the parabola of every key over its x and the next
    ``ahead`` steps; power sums around the mean x, solved per key in columns."""
    cx, cy = F.col(x).cast("double"), number(y)
    rows = df.select(key, x, cx.alias("_x"), cy.alias("_y")).filter("_x IS NOT NULL AND _y IS NOT NULL")
    mid = rows.groupBy(key).agg(F.avg("_x").alias("_m"), F.max(x).alias("_last"))
    rows = rows.join(mid, key).withColumn("_t", F.col("_x") - F.col("_m"))
    t, v = F.col("_t"), F.col("_y")
    s = rows.groupBy(key, "_m", "_last").agg(
        F.count(t).cast("double").alias("s0"), F.sum(t * t).alias("s2"), F.sum(t * t * t).alias("s3"), F.sum(t * t * t * t).alias("s4"),
        F.sum(v).alias("r0"), F.sum(t * v).alias("r1"), F.sum(t * t * v).alias("r2"), F.countDistinct("_x").alias("_n"))
    s0, s2, s3, s4, r0, r1, r2 = (F.col(c) for c in ("s0", "s2", "s3", "s4", "r0", "r1", "r2"))
    # normal equations with the first power sum equal to zero
    det = s0 * (s2 * s4 - s3 * s3) - s2 * s2 * s2
    a = r0 * (s2 * s4 - s3 * s3) + s2 * (r1 * s3 - s2 * r2)
    b = s0 * (r1 * s4 - s3 * r2) - s2 * s2 * r1 + s2 * s3 * r0
    c = s0 * (s2 * r2 - s3 * r1) - s2 * s2 * r0
    fits = s.filter("_n >= 3").select(key, "_m", "_last", *[F.try_divide(k, det).alias(n) for k, n in ((a, "_a"), (b, "_b"), (c, "_c"))])
    known = rows.select(key, x)
    future = fits.select(key, F.explode(F.sequence(F.col("_last") + 1, F.col("_last") + ahead)).alias(x))
    out = known.unionByName(future).join(fits, key).withColumn("_t", F.col(x) - F.col("_m"))
    return out.select(key, x, (F.col("_a") + F.col("_b") * F.col("_t") + F.col("_c") * F.col("_t") * F.col("_t")).alias("fitted"))


# ---- trees and clusters -----------------------------------------------------

def _assembled(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    rows = complete_rows(df, features).withColumns({f"_f{i}": number(c) for i, c in enumerate(features)})
    return VectorAssembler(inputCols=[f"_f{i}" for i in range(len(features))], outputCol=output).transform(rows)


def forest_importance(df: DataFrame, row_id: str, response: str, predictors: Sequence[str], trees: int = 100,
                      test_percent: int = 25, seed: int = 42) -> Linear:
    """Random forest: importance per predictor and errors on the test rows."""
    data = _assembled(df, predictors).withColumn("_y", number(response)).filter("_y IS NOT NULL")
    spot = bucket(row_id, 100, seed)
    model = RandomForestRegressor(featuresCol="features", labelCol="_y", predictionCol="_p", numTrees=trees, seed=seed).fit(data.filter(spot >= test_percent))
    table = df.sparkSession.createDataFrame(
        [(c, float(v)) for c, v in zip(predictors, model.featureImportances.toArray())], "predictor string, importance double")
    return Linear(table.orderBy(F.desc("importance")), errors(model.transform(data.filter(spot < test_percent)), "_y", "_p"))


class Clusters(NamedTuple):
    elbow: DataFrame
    rows: DataFrame
    profile: DataFrame


def clusters(df: DataFrame, features: Sequence[str], k: int = 4, elbow: Sequence[int] = range(1, 11), seed: int = 42,
             starts: int = 10) -> Clusters:
    """K-means on columns scaled by their population deviation: cost for every
    k of the elbow, the rows with their cluster, and size and feature means per
    cluster.  Of several starts the one with the least cost counts; a constant
    column does not tell rows apart."""
    rows = complete_rows(df, features)
    seen = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(features)],
                    *[F.stddev_pop(number(c)).alias(f"s{i}") for i, c in enumerate(features)]).first()
    spread = [i for i in range(len(features)) if seen[f"s{i}"]]
    scaled = rows.withColumns({f"_f{i}": (number(c) - F.lit(seen[f"m{i}"])) / F.lit(seen[f"s{i}"]) if i in spread else F.lit(0.0)
                               for i, c in enumerate(features)})
    scaled = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(features))], outputCol="features").transform(scaled)
    scaled = scaled.select(*df.columns, "features").persist()  # read once per k and start

    def best(n: int) -> tuple[float, KMeansModel]:
        fits = [KMeans(k=n, seed=seed + i, predictionCol="cluster").fit(scaled) for i in range(starts)]
        return min(((float(m.summary.trainingCost), m) for m in fits), key=lambda x: x[0])

    try:
        # One cluster lies at the mean: each column that varies adds its n squared deviations of one on average.
        costs = [(n, float(seen["n"] * len(spread)) if n == 1 else best(n)[0]) for n in elbow]
        model = best(k)[1]
    finally:
        scaled.unpersist()
    rows = model.transform(scaled).drop("features")
    profile = rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"), *[F.avg(number(c)).alias(c) for c in features])
    return Clusters(df.sparkSession.createDataFrame(costs, "k int, cost double"), rows, profile)
