"""Analyses made of several operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import written
from ..operators import components, correlation, outliers, profile


@dataclass
class OutlierWorkflow:
    """What the methods found and what is left; the tables of numbers are made when they are asked for."""

    df: DataFrame
    columns: Sequence[str]
    zscore: DataFrame | None
    iqr: DataFrame | None
    pca: DataFrame | None
    consensus: outliers.Consensus
    cleaned: DataFrame
    second: OutlierWorkflow | None

    @cached_property
    def statistics(self) -> DataFrame:
        return profile.advanced_statistics(self.df, self.columns)

    @cached_property
    def comparison(self) -> DataFrame:
        return outliers.before_after(self.df, self.cleaned, self.columns)


def outlier_workflow(df: DataFrame, row_id: str, columns: Sequence[str],
                     methods: Sequence[str] = ("zscore", "iqr", "pca"), zscore_threshold: float = 3.0,
                     iqr_k: float = 1.5, pca_variance: float = 0.95, removal: str = "consensus",
                     min_methods: int = 2, second_run: bool = True) -> OutlierWorkflow:
    """Statistics, the chosen methods, their consensus, removal, and the same
    once more over the cleaned rows.  The ids that the methods found and those
    that go are written, so cleaning is an anti join with a table of ids and no method runs twice."""
    zscore = iqr = pca = None
    found = {}
    if "zscore" in methods:
        zscore = outliers.z_score_outliers(df, columns, zscore_threshold).rows
        found["zscore"] = zscore
    if "iqr" in methods:
        flagged = outliers.flag_by_iqr(df, columns, iqr_k)
        iqr = flagged.filter("is_iqr_outlier")
        found["iqr"] = iqr
    if "pca" in methods:
        pca = components.distance_outliers(df, columns, pca_variance).rows
        found["pca"] = pca
    marks = written(reduce(DataFrame.unionByName, [rows.select(row_id, F.lit(name).alias("_method")) for name, rows in found.items()]))
    found = {name: marks.filter(F.col("_method") == name).select(row_id) for name in found}
    cleaned = df.join(written(outliers.rows_to_remove(found, row_id, removal, min_methods)), row_id, "left_anti")
    second = None
    if second_run:
        second = outlier_workflow(cleaned, row_id, columns, methods, zscore_threshold, iqr_k, pca_variance,
                                  removal, min_methods, second_run=False)
    return OutlierWorkflow(df, columns, zscore, iqr, pca, outliers.consensus(found, row_id), cleaned, second)


class CorrelationReport(NamedTuple):
    matrix: DataFrame
    high: DataFrame
    edges: DataFrame
    strongest: DataFrame
    inflation: DataFrame


def correlation_report(df: DataFrame, columns: Sequence[str], method: str = "pearson",
                       threshold: float = 0.7) -> CorrelationReport:
    pairs = correlation.correlation_pairs(df, columns, method)
    return CorrelationReport(correlation.correlation_matrix(df, columns, method),
                             correlation.high_pairs(pairs, threshold), correlation.correlation_edges(pairs, threshold),
                             correlation.strongest_pairs(pairs), correlation.variance_inflation(df, columns))
