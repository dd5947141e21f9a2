"""Correlation in long form, related pairs and variance inflation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import positions, running_sum, value_counts_ranked
from ..functions.quantiles import long_form, number
from ..functions.storage import written
from .components import complete_rows

CHUNK_BITS = 18


def _pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def correlation_pairs(df: DataFrame, columns: Sequence[str], method: str = "pearson", **sizes) -> DataFrame:
    """var1, var2, r of every pair, each over the rows where both are present."""
    pairs = _pairs(list(columns))
    if method == "pearson":
        row = df.agg(*[F.corr(number(a), number(b)).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
        cells = F.explode(F.array(*[
            F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"p{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)]))
        return row.select(cells.alias("c")).select("c.*")
    if method == "spearman":
        return _rank_pairs(df, pairs, **sizes)
    if method == "kendall":
        return _kendall(_weighted_points(df, pairs), **sizes)
    raise ValueError("method must be pearson, spearman or kendall")


def correlation_matrix(df: DataFrame, columns: Sequence[str], method: str = "pearson", **sizes) -> DataFrame:
    """All ordered pairs with the unit diagonal."""
    half = correlation_pairs(df, columns, method, **sizes)
    flipped = half.select(F.col("var2").alias("var1"), F.col("var1").alias("var2"), "r")
    same = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "var1 string, var2 string, r double")
    return half.unionByName(flipped).unionByName(same)


def _weighted_points(df: DataFrame, pairs) -> DataFrame:
    """var1, var2, x, y, w: equal points of a pair counted before any shuffle."""
    cells = F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), number(a).alias("x"), number(b).alias("y"))
        for a, b in pairs]))
    return (df.select(cells.alias("c")).select("c.*").filter("x IS NOT NULL AND y IS NOT NULL")
              .groupBy("var1", "var2", "x", "y").agg(F.count(F.lit(1)).alias("w")))


PAIR = ["var1", "var2"]


def _axis_counts(points: DataFrame, axis: str) -> DataFrame:
    return points.groupBy(*PAIR, axis).agg(F.sum("w").alias("n"))


def _rank_pairs(df: DataFrame, pairs, **sizes) -> DataFrame:
    """A column without missing values has one rank per value, whatever the pair: a dictionary of its distinct values.
    Pairs with missing values rank the rows that have both, each pair by itself."""
    columns = sorted({c for pair in pairs for c in pair})
    gaps = df.agg(*[F.count_if(number(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    full = {c: i for i, c in enumerate(columns) if not gaps[i]}
    whole = [p for p in pairs if p[0] in full and p[1] in full]
    rest = [p for p in pairs if p not in whole]
    parts = []
    if rest:
        parts.append(_spearman(_weighted_points(df, rest), **sizes))
    if whole:
        rows = df.select(*[number(c).alias(f"_v{i}") for c, i in full.items()])
        counts = long_form(rows, rows.columns).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
        ranked = running_sum(counts, ["variable"], ["value"], {"upto": "n"}, **sizes)
        ranks = written(ranked.select("variable", "value", (F.col("upto") - (F.col("n") - 1) / 2.0).alias("rank")))
        for i in full.values():
            rows = rows.join(ranks.filter(F.col("variable") == f"_v{i}").select(F.col("value").alias(f"_v{i}"), F.col("rank").alias(f"_r{i}")), f"_v{i}")
        cells = F.array(*[F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"_{k}").alias("r")) for k, (a, b) in enumerate(whole)])
        row = rows.agg(*[F.nullif(F.corr(f"_r{full[a]}", f"_r{full[b]}"), F.lit(float("nan"))).alias(f"_{k}") for k, (a, b) in enumerate(whole)])
        parts.append(row.select(F.explode(cells).alias("c")).select("c.*"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _spearman(points: DataFrame, **sizes) -> DataFrame:
    out = points
    for axis in ("x", "y"):
        ranked = running_sum(_axis_counts(points, axis), PAIR, [axis], {"upto": "n"}, **sizes)
        ranked = ranked.select(*PAIR, axis, (F.col("upto") - (F.col("n") - 1) / 2.0).alias(f"r{axis}"))
        out = out.join(ranked, [*PAIR, axis])
    total = points.groupBy(*PAIR).agg(((F.sum("w") + 1) / 2.0).alias("mid"))
    a, b = F.col("rx") - F.col("mid"), F.col("ry") - F.col("mid")
    both = out.join(total, PAIR)  # as many rows as there are pairs of columns
    return both.groupBy(*PAIR).agg(F.try_divide(
        F.sum(F.col("w") * a * b), F.sqrt(F.sum(F.col("w") * a * a) * F.sum(F.col("w") * b * b))).alias("r"))


def _tied(counts: DataFrame, weight: str, name: str) -> DataFrame:
    w = F.col(weight).cast("double")
    return counts.groupBy(*PAIR).agg(F.sum(w * (w - 1) / 2).alias(name))


def _kendall(points: DataFrame, chunk_bits: int = CHUNK_BITS, **sizes) -> DataFrame:
    """tau-b.  Discordant pairs are counted, never listed: points are numbered
    in (x, y) order, and two points first part at one bit of their numbers.
    For every high bit one running sum over y counts the pairs that part
    there; pairs inside a chunk of 2**chunk_bits points are counted in numpy.
    """
    placed = positions(points, PAIR, ["x", "y"], "pos", **sizes).withColumn("pos", F.col("pos") - 1)
    top = placed.agg(F.max("pos")).first()[0] or 0
    inside = (placed.withColumn("chunk", F.shiftright("pos", chunk_bits))
              .groupBy(*PAIR, "chunk").applyInPandas(_chunk_inversions(chunk_bits), "var1 string, var2 string, inv double"))
    parts = [inside]
    bits = list(range(chunk_bits, max(chunk_bits, int(top).bit_length())))
    if bits:
        levels = placed.withColumn("bit", F.explode(F.array(*[F.lit(b) for b in bits])))
        one = F.pmod(F.expr("shiftright(pos, bit)"), F.lit(2)) == 1
        keys = [*PAIR, "bit", "group"]
        sides = (levels.withColumn("group", F.expr("shiftright(pos, bit + 1)"))
                 .groupBy(*keys, (-F.col("y")).alias("down"))
                 .agg(F.sum(F.when(~one, F.col("w")).otherwise(0)).cast("double").alias("w0"),
                      F.sum(F.when(one, F.col("w")).otherwise(0)).cast("double").alias("w1")))
        above = running_sum(sides, keys, ["down"], {"upto": "w0"}, **sizes)
        parts.append(above.groupBy(*PAIR).agg(
            F.sum(F.col("w1") * (F.col("upto") - F.col("w0"))).alias("inv")))
    inversions = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    inversions = inversions.groupBy(*PAIR).agg(F.sum("inv").alias("dis"))
    n = points.groupBy(*PAIR).agg(F.sum("w").cast("double").alias("n"))
    table = (n.join(_tied(_axis_counts(points, "x"), "n", "tx"), PAIR)
              .join(_tied(_axis_counts(points, "y"), "n", "ty"), PAIR)
              .join(_tied(points, "w", "txy"), PAIR).join(inversions, PAIR))
    whole = F.col("n") * (F.col("n") - 1) / 2
    balance = whole - F.col("tx") - F.col("ty") + F.col("txy") - 2 * F.col("dis")
    return table.select(*PAIR, F.try_divide(
        balance, F.sqrt((whole - F.col("tx")) * (whole - F.col("ty")))).alias("r"))


def _chunk_inversions(bits: int):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        pos = pdf["pos"].to_numpy() & ((1 << bits) - 1)
        y, w = pdf["y"].to_numpy(), pdf["w"].to_numpy(float)
        total = 0.0
        for b in range(int(pos.max()).bit_length()):
            group, one = pos >> (b + 1), ((pos >> b) & 1).astype(bool)
            order = np.lexsort((~one, -y, group))  # equal y: side one first, so ties do not count
            g, o, v = group[order], one[order], w[order]
            ahead = np.cumsum(np.where(o, 0.0, v))
            first = np.r_[True, g[1:] != g[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
            base = np.r_[0.0, ahead][start]
            total += float(np.sum(np.where(o, v * (ahead - base), 0.0)))
        return pd.DataFrame({"var1": [pdf["var1"].iloc[0]], "var2": [pdf["var2"].iloc[0]], "inv": [total]})
    return count


def high_pairs(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Pairs at or above the threshold in size, strongest first."""
    return (pairs.filter((F.col("var1") != F.col("var2")) & (F.abs("r") >= threshold))
                 .orderBy(F.abs("r").desc(), "var1", "var2"))


def correlation_edges(pairs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """source, target, weight, sign."""
    return pairs.filter((F.col("var1") != F.col("var2")) & (F.abs("r") >= threshold)).select(
        F.col("var1").alias("source"), F.col("var2").alias("target"), F.abs("r").alias("weight"),
        F.when(F.col("r") >= 0, "positive").otherwise("negative").alias("sign"))


def strongest_pairs(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The k strongest pairs, and the strongest of each sign (kind)."""
    name = F.concat_ws(" - ", "var1", "var2")
    top = pairs.orderBy(F.abs("r").desc(), "var1", "var2").limit(k).select(
        F.lit("top").alias("kind"), name.alias("pair"), "r")
    ends = []
    for kind, held, by in (("positive", F.col("r") > 0, F.max_by), ("negative", F.col("r") < 0, F.min_by)):
        ends.append(pairs.filter(held).agg(by(name, "r").alias("pair"), by("r", "r").alias("r"))
                    .filter("pair IS NOT NULL").select(F.lit(kind).alias("kind"), "pair", "r"))
    return top.unionByName(ends[0]).unionByName(ends[1])


def target_correlations(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.corr(number(f), number(target)).alias(f) for f in features])
    return row.unpivot([], list(features), "feature", "r")


def correlation_array(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Matrix over complete rows: columns x columns numbers."""
    columns = list(columns)
    out = np.eye(len(columns))
    for r in correlation_pairs(complete_rows(df, columns), columns).collect():
        i, j = columns.index(r.var1), columns.index(r.var2)
        out[i, j] = out[j, i] = r.r if r.r is not None else 0.0
    return out


def inflation_factors(matrix: np.ndarray) -> np.ndarray:
    """Diagonal of the inverse correlation matrix; infinite when singular."""
    if matrix.shape[0] < 2:
        return np.ones(matrix.shape[0])
    if np.linalg.cond(matrix) > 1e15:
        return np.full(matrix.shape[0], np.inf)
    return np.diag(np.linalg.inv(matrix))


def variance_inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    factors = inflation_factors(correlation_array(df, columns))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, factors)],
                                           "variable string, vif double")
