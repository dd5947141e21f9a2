"""Median of the slopes between all pairs of points (Theil-Sen), without
listing the pairs.

Sorted by x, the pairs whose slope is below s are the pairs that y - s*x puts
in the wrong order.  Counting those for a trial s is one counting pass, so the
median is found by halving an interval of slopes for all groups at once.
Groups that fit a task (``group_rows``) do it there on numpy arrays; larger
ones are counted with distributed running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions.ordered import BLOCK_ROWS, framed, positions, running_sum
from ..functions.sizes import spread_out
from ..functions.storage import materialise

GROUP_ROWS = 100_000
ROUNDS = 120


def _below(x: np.ndarray, y: np.ndarray, s: float) -> float:
    """Pairs with x_i < x_j and slope < s."""
    v = y - s * x
    order = np.lexsort((v, x))           # equal x: ascending v, never counted
    rank = np.unique(v[order], return_inverse=True)[1]
    place = np.arange(len(rank))
    total = 0.0
    for b in range(int(len(rank) - 1).bit_length()):
        group, right = place >> (b + 1), ((place >> b) & 1).astype(bool)
        by = np.lexsort((~right, -rank, group))
        g, r = group[by], right[by]
        left = np.cumsum(~r)
        first = np.r_[True, g[1:] != g[:-1]]
        start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        total += float(np.sum(np.where(r, left - np.r_[0, left][start], 0)))
    return total


def _pairs(x: np.ndarray) -> float:
    ties = np.unique(x, return_counts=True)[1].astype(float)
    n = float(len(x))
    return n * (n - 1) / 2 - float(np.sum(ties * (ties - 1) / 2))


def median_slope(x: np.ndarray, y: np.ndarray) -> float:
    """Median pair slope of arrays, by counting."""
    pairs = _pairs(x)
    if pairs == 0:
        return float("nan")
    if len(x) <= 64:
        i, j = np.triu_indices(len(x), 1)
        dx = x[j] - x[i]
        return float(np.median((y[j] - y[i])[dx != 0] / dx[dx != 0]))
    gaps = np.diff(np.unique(x)).min()
    reach = (y.max() - y.min()) / gaps * 1.0000001 + 1e-12

    def kth(k: float) -> float:
        low, high = -reach, reach
        for _ in range(ROUNDS):
            mid = low + (high - low) / 2
            if mid in (low, high):
                break
            if _below(x, y, mid) > k:
                high = mid
            else:
                low = mid
        return low + (high - low) / 2
    half = (pairs - 1) / 2
    a = kth(np.floor(half))
    return float(a if half == np.floor(half) else (a + kth(np.ceil(half))) / 2)


def median_pair_slopes(rows: DataFrame, keys: Sequence[str], group_rows: int = GROUP_ROWS,
                       block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """keys, slope."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = sizes.filter(F.col("_n") > group_rows).drop("_n")
    names = list(keys)
    slope = F.pandas_udf(_slopes, DoubleType())

    def local(part: DataFrame) -> DataFrame:
        sets = spread_out(part.groupBy(*names).agg(F.collect_list(F.struct("x", "y")).alias("p")), *names)
        return sets.select(*names, slope(F.transform("p", lambda q: q.x), F.transform("p", lambda q: q.y)).alias("slope"))
    if large.isEmpty():
        return local(rows)
    return local(rows.join(large, names, "left_anti")).unionByName(
        _distributed(rows.join(large, names, "left_semi"), names, block_rows))


def _slopes(xs: pd.Series, ys: pd.Series) -> pd.Series:
    return pd.Series([median_slope(x, y) for x, y in zip(xs, ys)], dtype=float)


def _distributed(rows: DataFrame, keys: list[str], block_rows: int | None) -> DataFrame:
    """The same halving for groups beyond a task.  The state, one interval per
    group and wanted rank, is a table that is written once per round."""
    named = {k: f"_key{i}" for i, k in enumerate(keys)}  # the caller's names may be those used here
    points = rows.select(*[F.col(f"`{k}`").alias(c) for k, c in named.items()], "x", "y")
    keys = list(named.values())
    ties = points.groupBy(*keys, "x").agg(F.count(F.lit(1)).cast("double").alias("t"))
    fr = framed(ties, keys, ["x"], 1, 0, block_rows)
    gaps = fr.own(fr.df.withColumn("gap", F.col("x") - F.lag("x").over(fr.window)))
    stats = (gaps.groupBy(*keys).agg(F.sum("t").alias("n"), F.min("gap").alias("gap"),
                                     F.sum(F.col("t") * (F.col("t") - 1) / 2).alias("tied"))
             .join(points.groupBy(*keys).agg((F.max("y") - F.min("y")).alias("rise")), keys)
             .filter("gap IS NOT NULL"))
    half = (F.col("n") * (F.col("n") - 1) / 2 - F.col("tied") - 1) / 2
    reach = F.col("rise") / F.col("gap") * 1.0000001 + 1e-12
    state = materialise(stats.select(
        *keys, F.explode(F.array_distinct(F.array(F.floor(half).cast("double"), F.ceil(half).cast("double")))).alias("k"),
        (-reach).alias("lo"), reach.alias("hi")))
    for _ in range(ROUNDS):
        trial = state.withColumn("s", F.col("lo") + (F.col("hi") - F.col("lo")) / 2)
        if trial.filter("s <> lo AND s <> hi").isEmpty():
            break
        v = points.join(trial.select(*keys, "k", "s"), keys).withColumn("v", F.col("y") - F.col("s") * F.col("x"))
        below = _count_disorder(v, [*keys, "k"], block_rows)
        over = F.coalesce("inv", F.lit(0.0)) > F.col("k")
        state = materialise(trial.join(below, [*keys, "k"], "left").select(
            *keys, "k", F.when(over, F.col("lo")).otherwise(F.col("s")).alias("lo"),
            F.when(over, F.col("s")).otherwise(F.col("hi")).alias("hi")))
    return state.groupBy(*keys).agg(F.avg(F.col("lo") + (F.col("hi") - F.col("lo")) / 2).alias("slope")).withColumnsRenamed(
        {c: k for k, c in named.items()})


def _count_disorder(rows: DataFrame, keys: list[str], block_rows: int | None) -> DataFrame:
    """Pairs with x_i < x_j and v_i > v_j: rows are numbered in (x, v) order and
    every bit of the number gives the pairs that part at that bit."""
    placed = positions(rows.select(*keys, "x", "v"), keys, ["x", "v"], "p", block_rows).withColumn("p", F.col("p") - 1)
    top = placed.agg(F.max("p")).first()[0] or 0
    bits = F.array(*[F.lit(b) for b in range(max(1, int(top).bit_length()))])
    levels = placed.withColumn("bit", F.explode(bits))
    right = F.pmod(F.expr("shiftright(p, bit)"), F.lit(2)) == 1
    group = [*keys, "bit", "g"]
    sides = (levels.withColumn("g", F.expr("shiftright(p, bit + 1)")).groupBy(*group, (-F.col("v")).alias("down"))
             .agg(F.count_if(~right).cast("double").alias("a"), F.count_if(right).cast("double").alias("b")))
    ahead = running_sum(sides, group, ["down"], {"upto": "a"}, block_rows)
    return ahead.groupBy(*keys).agg(F.sum(F.col("b") * (F.col("upto") - F.col("a"))).alias("inv"))
