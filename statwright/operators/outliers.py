"""Outliers by z-score, quartile fences and consensus.  Bounds are statistics
of whole columns: they are read first and applied as literals, so that the
second pass needs no join and no shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import number, quantile_table
from .profile import summary


class Spread(NamedTuple):
    mean: float
    std: float


def spreads(df: DataFrame, columns: Sequence[str]) -> dict[str, Spread]:
    rows = summary(df, columns, ["mean", "std"]).collect()
    return {r.variable: Spread(r["mean"], r["std"]) for r in rows if r["mean"] is not None}


def _z(column: str, s: Spread | None) -> Column:
    if s is None:
        return F.lit(None).cast("double")
    if not s.std:
        return F.when(number(column).isNotNull(), F.lit(0.0))
    return (number(column) - F.lit(s.mean)) / F.lit(s.std)


def z_scores(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds column_zscore (sample deviation; 0 for a constant column)."""
    s = spreads(df, columns)
    return df.withColumns({f"{c}_zscore": _z(c, s.get(c)) for c in columns})


def _any(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags])


def flag_by_z_score(df: DataFrame, columns: Sequence[str], threshold: float = 3.0,
                    output: str = "is_outlier") -> DataFrame:
    """True where any column is beyond the threshold; an existing True stays."""
    s = spreads(df, columns)
    flag = _any([F.abs(_z(c, s.get(c))) > threshold for c in columns])
    if output in df.columns:
        flag = F.coalesce(F.col(output), F.lit(False)) | flag
    return df.withColumn(output, flag)


class Outliers(NamedTuple):
    rows: DataFrame
    columns: DataFrame


def z_score_outliers(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> Outliers:
    """Wide form: outlier rows with scores and flags; counts per column."""
    s = spreads(df, columns)
    scored = df.withColumns({f"{c}_zscore": _z(c, s.get(c)) for c in columns})
    scored = scored.withColumns({f"{c}_is_outlier": F.coalesce(F.abs(f"{c}_zscore") > threshold, F.lit(False))
                                 for c in columns})
    counts = scored.agg(*[F.count_if(f"{c}_is_outlier").alias(c) for c in columns])
    return Outliers(scored.filter(_any([F.col(f"{c}_is_outlier") for c in columns])),
                    counts.unpivot([], list(columns), "variable", "outliers"))


def z_score_outliers_long(df: DataFrame, row_id: str, columns: Sequence[str],
                          threshold: float = 3.0) -> Outliers:
    """Long form: variable, row id, value, z (largest first); statistics per column."""
    s = spreads(df, columns)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), number(c).alias("value"),
                                         _z(c, s.get(c)).alias("zscore")) for c in columns]))
    long = df.select(row_id, cells.alias("c")).select(row_id, "c.*").filter(F.col("value").isNotNull())
    stats = long.groupBy("variable").agg(
        F.count_if(F.abs("zscore") > threshold).alias("outliers"), F.count("value").alias("count"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("zscore").alias("min_zscore"), F.max("zscore").alias("max_zscore"))
    stats = stats.withColumn("outlier_pct", F.col("outliers") * 100.0 / F.col("count"))
    found = long.filter(F.abs("zscore") > threshold).orderBy(F.abs("zscore").desc(), "variable", row_id)
    return Outliers(found, stats)


def iterative_bounds(df: DataFrame, column: str, threshold: float = 3.0, max_rounds: int = 10,
                     high_rounds: int = 5, tolerance: float = 1e-3) -> DataFrame:
    """min and max left by repeated removal: first only high values, then both
    sides (population deviation).  The state is a pair of bounds; every round
    is one aggregate over the column."""
    values = df.select(number(column).alias("v")).filter(F.col("v").isNotNull())

    def measure(low, high):
        kept = values
        if low is not None:
            kept = kept.filter(F.col("v") >= F.lit(low))
        if high is not None:
            kept = kept.filter(F.col("v") <= F.lit(high))
        return kept.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"),
                        F.min("v").alias("low"), F.max("v").alias("high")).first()

    now, low, high, last = measure(None, None), None, None, None
    for both, rounds in ((False, high_rounds), (True, max_rounds)):
        for _ in range(rounds if now.n >= 3 else 0):
            if not now.std:
                break
            cut = now.mean + threshold * now.std
            new_high = cut if high is None else min(high, cut)
            new_low = low
            if both:
                cut = now.mean - threshold * now.std
                new_low = cut if low is None else max(low, cut)
            after = measure(new_low, new_high)
            if after.n == 0:
                break
            if last is not None and abs(after.high - last[1]) < tolerance and (
                    not both or abs(after.low - last[0]) < tolerance):
                break
            now, low, high, last = after, new_low, new_high, (after.low, after.high)
    return df.sparkSession.createDataFrame([(now.low, now.high)], "min_value double, max_value double")


def adaptive_lower_bound(df: DataFrame, column: str, percent: float = 10) -> DataFrame:
    q = quantile_table(df, [column], [percent / 100])
    value = q.get((column, percent / 100))
    return df.sparkSession.createDataFrame([(None if value is None else max(value, 1.0),)], "lower_bound double")


class Fence(NamedTuple):
    q1: float
    q3: float
    low: float
    high: float


def fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, Fence]:
    """Quartile fences; none for a column with fewer than four values."""
    counts = df.agg(*[F.count(number(c)).alias(c) for c in columns]).first()
    q = quantile_table(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        if counts[c] >= 4:
            a, b = q[c, 0.25], q[c, 0.75]
            out[c] = Fence(a, b, a - k * (b - a), b + k * (b - a))
    return out


def fence_table(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    found = fences(df, columns, k)
    return df.sparkSession.createDataFrame(
        [(c, *(found.get(c) or (None,) * 4)) for c in columns],
        "variable string, q1 double, q3 double, lower_bound double, upper_bound double")


def _outside(column: str, f: Fence | None) -> Column:
    if f is None:
        return F.lit(False)
    return (F.col(column) < F.lit(f.low)) | (number(column) > F.lit(f.high))


def iqr_outliers(df: DataFrame, row_id: str, columns: Sequence[str], k: float = 1.5) -> Outliers:
    """Long form: row id, variable, value, bounds, Low/High; counts per column
    and the share of all cells."""
    found = fences(df, columns, k)
    if not found:
        found = {columns[0]: Fence(0.0, 0.0, float("-inf"), float("inf"))}
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), number(c).alias("value"),
                 F.lit(f.low).alias("lower_bound"), F.lit(f.high).alias("upper_bound"))
        for c, f in found.items()]))
    # plain comparisons, which a scan of double columns takes as its own filter
    near = df.filter(reduce(lambda a, b: a | b, [
        (F.col(c) < F.lit(f.low)) | (F.col(c) > F.lit(f.high)) for c, f in found.items()], F.lit(False)))
    long = near.select(row_id, cells.alias("c")).select(row_id, "c.*")
    kind = (F.when(F.col("value") < F.col("lower_bound"), "Low")
             .when(F.col("value") > F.col("upper_bound"), "High"))
    rows = long.withColumn("type", kind).filter(F.col("type").isNotNull())
    row = df.agg(*[F.count_if(_outside(c, found.get(c))).alias(f"o_{c}") for c in columns],
                 *[F.count(number(c)).alias(f"n_{c}") for c in columns])
    total = reduce(lambda a, b: a + b, [F.col(f"n_{c}") for c in columns])
    stats = F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"o_{c}").alias("outliers"), F.col(f"n_{c}").alias("count"),
                 F.try_divide(F.col(f"o_{c}") * 100.0, total).alias("outlier_cells_pct")) for c in columns]))
    return Outliers(rows, row.select(stats.alias("s")).select("s.*"))


def flag_by_iqr(df: DataFrame, columns: Sequence[str], k: float = 1.5,
                output: str = "is_iqr_outlier") -> DataFrame:
    found = fences(df, columns, k)
    return df.withColumn(output, _any([_outside(c, found.get(c)) for c in columns]))


class Consensus(NamedTuple):
    rows: DataFrame
    agreement: DataFrame
    methods: DataFrame
    overlaps: DataFrame


def consensus(found: dict[str, DataFrame], row_id: str) -> Consensus:
    """Row ids named by any method, with how many and which; counts by number
    of methods, by method and by set of methods.

    ``found`` maps a method to a frame with the ids it names.  The methods of
    one row are a handful, so the list per row is short.
    """
    order = {m: i for i, m in enumerate(found)}
    named = reduce(DataFrame.unionByName, [
        df.select(row_id).withColumn("method", F.lit(m)) for m, df in found.items()])
    per_row = named.groupBy(row_id).agg(*[
        F.max((F.col("method") == m).cast("int")).alias(f"_{i}") for m, i in order.items()])
    names = F.filter(F.array(*[F.when(F.col(f"_{i}") == 1, m) for m, i in order.items()]), lambda x: x.isNotNull())
    rows = per_row.select(row_id, F.size(names).alias("method_count"), F.array_join(names, ", ").alias("methods"))
    return Consensus(
        rows, rows.groupBy("method_count").agg(F.count(F.lit(1)).alias("rows")),
        named.groupBy("method").agg(F.countDistinct(row_id).alias("rows")),
        rows.groupBy("methods").agg(F.count(F.lit(1)).alias("rows")))


def rows_to_remove(found: dict[str, DataFrame], row_id: str, method: str = "consensus",
                   min_methods: int = 2) -> DataFrame:
    """Ids by strategy: consensus of ``min_methods``, union, or one method."""
    if method == "union":
        return consensus(found, row_id).rows.select(row_id)
    if method == "consensus":
        return consensus(found, row_id).rows.filter(F.col("method_count") >= min_methods).select(row_id)
    return found[method].select(row_id).distinct()


def without_outliers(df: DataFrame, found: dict[str, DataFrame], row_id: str, method: str = "consensus",
                     min_methods: int = 2) -> DataFrame:
    return df.join(rows_to_remove(found, row_id, method, min_methods), row_id, "left_anti")


def before_after(original: DataFrame, cleaned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, std and median before and after, with percent changes."""
    def side(df, prefix):
        s = summary(df, columns, ["mean", "std"], {"median": 0.5})
        return s.select("variable", *[F.col(c).alias(f"{prefix}_{c}") for c in ("mean", "std", "median")])
    change = lambda c: F.try_divide(
        (F.col(f"cleaned_{c}") - F.col(f"original_{c}")) * 100.0, F.col(f"original_{c}"))
    return (side(original, "original").join(side(cleaned, "cleaned"), "variable")
            .withColumns({"mean_change_pct": change("mean"), "std_change_pct": change("std")}))
