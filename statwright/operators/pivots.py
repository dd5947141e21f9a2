"""Grouped tables, pivots, scores and pair counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import half_even


def pivot_table(df: DataFrame, index: Sequence[str], column: str, levels: Sequence[str],
                measures: dict[str, Column], fill: float = 0) -> DataFrame:
    """index x level table of several measures; names are level_measure."""
    wide = (df.groupBy(*index).pivot(column, list(levels))
              .agg(*[agg.alias(name) for name, agg in measures.items()]))
    if len(measures) == 1:
        name = next(iter(measures))
        wide = wide.withColumnsRenamed({str(v): f"{v}_{name}" for v in levels})
    return wide.fillna(fill, subset=[c for c in wide.columns if c not in index])


def growth_between(df: DataFrame, index: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Percent change from each column to the next; 0 from a zero base."""
    steps = [F.coalesce(F.try_divide((F.col(b) - F.col(a)) * 100.0, F.col(a)), F.lit(0.0))
             .alias(f"growth_{a}_to_{b}_pct") for a, b in zip(columns, columns[1:])]
    return df.select(*index, *steps)


# Weight of an operating status; every other one has 0.1.
STATUS_WEIGHT = {"ACTIVE": 1.0, "INACTIVE": 0.5, "UNKNOWN": 0.25}


def _status(cell: Column) -> Column:
    return reduce(lambda w, kv: w.when(cell == kv[0], kv[1]), STATUS_WEIGHT.items(),
                  F.when(F.lit(False), 0.0)).otherwise(0.1)


def group_score(df: DataFrame, keys: Sequence[str], name: str, area: str, perimeter: str,
                length: str, status: str) -> DataFrame:
    """Plain form: the status must match in its case, missing areas do not
    count, one row has no deviation; half-even rounding to 4 places."""
    part = lambda c, by: F.coalesce(F.when(F.avg(c) > 0, F.avg(c) / by), F.lit(0.0))
    score = (0.4 * part(area, 1000) + 0.3 * part(perimeter, 100)
             + 0.3 * F.avg(_status(F.col(status))) * 100)
    return df.groupBy(*keys).agg(
        F.count(name).alias("members"), half_even(F.avg(area), 4).alias("mean_value"),
        half_even(F.stddev_samp(length), 4).alias("std_dev_length"), half_even(score, 4).alias("score"))


def group_score_sql(df: DataFrame, keys: Sequence[str], name: str, area: str, perimeter: str,
                    length: str, status: str) -> DataFrame:
    """Query form: the status is upper-cased, a missing area counts as 0 and
    the deviation of one row is 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    score = (0.4 * F.avg(zero(area)) / 1000 + 0.3 * F.avg(zero(perimeter)) / 100
             + 0.3 * F.avg(_status(F.upper(F.col(status)))) * 100)
    return df.groupBy(*keys).agg(
        F.count(name).alias("members"), F.avg(area).alias("mean_value"),
        F.coalesce(F.stddev_samp(length), F.lit(0.0)).alias("std_dev_length"), score.alias("score"))


def roll_up(groups: DataFrame, key: str) -> DataFrame:
    """Sum of counts and mean of group means one level higher."""
    return groups.groupBy(key).agg(
        F.sum("members").alias("total_members"), half_even(F.avg("mean_value"), 4).alias("avg_area"),
        half_even(F.avg("std_dev_length"), 4).alias("avg_spread"), half_even(F.avg("score"), 4).alias("avg_score"))


def top_categories(df: DataFrame, column: str, k: int) -> list:
    """The k most frequent values, ties by value: k rows on the driver."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counts.orderBy(F.col("n").desc(), column).limit(k).collect()]


def cross_counts(df: DataFrame, row: str, column: str, k: int) -> DataFrame:
    """Counts by (row, column) for the k most frequent columns."""
    return (df.filter(F.col(column).isin(top_categories(df, column, k)))
              .groupBy(row, column).agg(F.count(F.lit(1)).alias("count")))


def link_counts(df: DataFrame, source: str, target: str) -> DataFrame:
    """Pair counts with node numbers (sources first, in name order).  The
    numbering runs over the distinct names, not over rows."""
    links = (df.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
               .groupBy(source, target).agg(F.count(F.lit(1)).alias("count")))
    first = links.select(F.col(source).alias("label")).distinct().withColumn("side", F.lit(0))
    second = links.select(F.col(target).alias("label")).distinct().withColumn("side", F.lit(1))
    names = first.union(second).groupBy("label").agg(F.min("side").alias("side"))
    from ..functions.ordered import positions
    nodes = positions(names, [], ["side", "label"], "node").withColumn("node", F.col("node") - 1)
    a = nodes.select(F.col("label").alias(source), F.col("node").alias("source_node"))
    b = nodes.select(F.col("label").alias(target), F.col("node").alias("target_node"))
    return links.join(a, source).join(b, target)


def path_counts(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Counts of both levels of a hierarchy."""
    pairs = (df.filter(F.col(parent).isNotNull() & F.col(child).isNotNull())
               .groupBy(parent, child).agg(F.count(F.lit(1)).alias("count")))
    totals = df.filter(F.col(parent).isNotNull() & F.col(child).isNotNull()).groupBy(parent).agg(F.count(F.lit(1)).alias("parent_count"))
    return pairs.join(totals, parent)


def pair_frequencies(df: DataFrame, a: str, b: str, ordered: bool = True) -> DataFrame:
    """Probability of each value pair, with or without regard to order."""
    total = df.count()
    x, y = F.col(a), F.col(b)
    first, second = (x, y) if ordered else (F.least(x, y), F.greatest(x, y))
    return (df.groupBy(first.alias("first"), second.alias("second"))
              .agg(F.count(F.lit(1)).alias("count"))
              .withColumn("probability", F.col("count") / F.lit(float(max(total, 1)))))


def rounded_group_table(df: DataFrame, keys: Sequence[str], value: str, second: str) -> DataFrame:
    """count, rounded mean, max, min, deviation and sum per group, largest sum
    first."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("members"), F.round(F.avg(value), 2).alias("avg_value"),
        F.round(F.avg(second), 2).alias("avg_second"), F.max(value).alias("max_value"),
        F.min(value).alias("min_value"), F.round(F.stddev(value), 2).alias("std_value"),
        F.round(F.sum(value), 2).alias("total_value")).orderBy(F.desc("total_value"))


def deviation_from_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Group mean, mean of all rows, difference."""
    overall = df.agg(F.avg(value)).first()[0]
    return (df.groupBy(key).agg(F.avg(value).alias("group_mean"))
              .withColumn("overall_mean", F.lit(overall))
              .withColumn("deviation", F.col("group_mean") - F.col("overall_mean")))


def latest_slice(df: DataFrame, period: str) -> DataFrame:
    last = df.agg(F.max(period)).first()[0]
    return df.filter(F.col(period) == F.lit(last))
