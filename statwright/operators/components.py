"""Principal components.  One aggregate gives the correlation matrix (columns x
columns); its decomposition is a driver-side step of that size; scores are
column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import number, quantile_table


class Components(NamedTuple):
    columns: list[str]
    rows: int
    means: np.ndarray
    stds: np.ndarray
    values: np.ndarray      # eigenvalues of every component
    vectors: np.ndarray     # one column per component
    kept: int

    @property
    def ratios(self) -> np.ndarray:
        return self.values / self.values.sum()


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [number(c).isNotNull() for c in columns]))


def fit(df: DataFrame, columns: Sequence[str], n_components: int | float | None = None,
        variance: float = 0.95) -> Components:
    """``n_components``: a count, a share of variance, or None for ``variance``."""
    columns = list(columns)
    rows = complete_rows(df, columns)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(number(c)).alias(f"s{i}") for i, c in enumerate(columns)],
        *[F.corr(number(columns[i]), number(columns[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    if stats.n < 2:
        raise ValueError("at least two complete rows are needed")
    stds = np.array([stats[f"s{i}"] for i in range(len(columns))])
    matrix = np.diag((stds > 0).astype(float))
    for i, j in pairs:
        r = stats[f"c{i}_{j}"]
        matrix[i, j] = matrix[j, i] = 0.0 if r is None or r != r else r
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1]
    values, vectors = np.clip(values[order], 0, None), vectors[:, order]
    peak = np.argmax(np.abs(vectors), axis=0)
    vectors = vectors * np.sign(vectors[peak, np.arange(vectors.shape[1])])
    if isinstance(n_components, int):
        kept = min(n_components, len(columns))
    else:
        share = np.cumsum(values / values.sum())
        kept = min(len(columns), int(np.searchsorted(share, n_components or variance, side="right")) + 1)
        if share[max(kept - 2, 0)] >= (n_components or variance) and kept > 1:
            kept -= 1
    means = np.array([stats[f"m{i}"] for i in range(len(columns))])
    return Components(columns, stats.n, means, np.where(stds > 0, stds, 1.0), values, vectors, kept)


def scores(df: DataFrame, model: Components) -> DataFrame:
    """Complete rows with PC1..PCk."""
    def score(j):
        parts = [(number(c) - F.lit(float(m))) * F.lit(float(v / s)) for c, m, s, v in
                 zip(model.columns, model.means, model.stds, model.vectors[:, j])]
        return reduce(lambda a, b: a + b, parts)
    return complete_rows(df, model.columns).withColumns({f"PC{j + 1}": score(j) for j in range(model.kept)})


def explained(spark, model: Components) -> DataFrame:
    """component, eigenvalue (sample variance), ratio, cumulative, kept, kaiser."""
    sample = model.values * model.rows / (model.rows - 1)
    total = np.cumsum(model.ratios)
    return spark.createDataFrame(
        [(j + 1, float(v), float(model.ratios[j]), float(total[j]), j < model.kept, bool(v > 1))
         for j, v in enumerate(sample)],
        "component int, eigenvalue double, ratio double, cumulative double, kept boolean, kaiser boolean")


def loadings(spark, model: Components, top: int | None = None) -> DataFrame:
    """component, variable, loading; the ``top`` strongest per component."""
    rows = []
    for j in range(model.kept):
        order = np.argsort(-np.abs(model.vectors[:, j]), kind="stable")[:top]
        rows += [(j + 1, model.columns[i], float(model.vectors[i, j])) for i in order]
    return spark.createDataFrame(rows, "component int, variable string, loading double")


def importance(spark, model: Components) -> DataFrame:
    """Squared loadings weighted by the variance ratio of their component."""
    weight = (model.vectors[:, :model.kept] ** 2 * model.ratios[:model.kept]).sum(axis=1)
    return spark.createDataFrame([(c, float(w)) for c, w in zip(model.columns, weight)],
                                 "variable string, importance double").orderBy(F.desc("importance"))


class DistanceOutliers(NamedTuple):
    rows: DataFrame
    threshold: float


def distance_outliers(df: DataFrame, columns: Sequence[str], n_components: int | float | None = None,
                      factor: float = 3.0) -> DistanceOutliers:
    """Rows whose squared distance in component space is above the median plus
    ``factor`` times the (unscaled) median absolute deviation."""
    model = fit(df, columns, n_components)
    scored = scores(df, model)
    away = scored.withColumn("distance", reduce(
        lambda a, b: a + b, [F.col(f"PC{j + 1}") * F.col(f"PC{j + 1}") for j in range(model.kept)]))
    middle = quantile_table(away, ["distance"], [0.5])["distance", 0.5]
    gap = away.select(F.abs(F.col("distance") - F.lit(middle)).alias("gap"))
    threshold = middle + factor * quantile_table(gap, ["gap"], [0.5])["gap", 0.5]
    return DistanceOutliers(away.filter(F.col("distance") > F.lit(threshold)), threshold)
