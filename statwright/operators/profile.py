"""Describing columns: moments, quantiles, histograms, distributions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import corrected_kurtosis, corrected_skew, sturges_bins
from ..functions.normal import normal_quantile
from ..functions.ordered import join_same, largest_group, positions, value_counts_ranked
from ..functions.quantiles import (SMALL_GROUP, number, quantile_columns,
                                   quantile_table)

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _moments(c: str) -> dict:
    v = number(c)
    n = F.count(v)
    return {
        "count": n, "missing": F.count_if(v.isNull()), "mean": F.avg(v), "std": F.stddev_samp(v),
        "variance": F.var_samp(v), "var_pop": F.var_pop(v), "std_pop": F.stddev_pop(v),
        "min": F.min(v), "max": F.max(v), "sum": F.sum(v),
        "skew_pop": F.when(F.var_pop(v) > 0, F.skewness(v)),
        "kurt_pop": F.when(F.var_pop(v) > 0, F.kurtosis(v)),
    }


def summary(df: DataFrame, columns: Sequence[str], wanted: Sequence[str],
            probs: dict[str, float] | None = None, keys: Sequence[str] = (),
            exact_rows: int = SMALL_GROUP) -> DataFrame:
    """keys, variable, wanted moments and named quantiles.

    Everything comes from one aggregate while the groups are small enough for
    Spark's exact percentile; beyond that the quantiles take their own route.
    """
    probs = probs or {}
    together = bool(probs) and largest_group(df, keys)[0] <= exact_rows
    aggs, fields = [], []
    for i, c in enumerate(columns):
        m = _moments(c)
        aggs += [m[w].alias(f"_{i}_{w}") for w in wanted]
        if together:
            aggs.append(F.percentile(number(c), F.array(*[F.lit(float(p)) for p in probs.values()])).alias(f"_{i}_q"))
        fields.append(F.struct(
            F.lit(c).alias("variable"), *[F.col(f"_{i}_{w}").alias(w) for w in wanted],
            *([F.col(f"_{i}_q")[j].alias(name) for j, name in enumerate(probs)] if together else [])))
    out = (df.groupBy(*keys).agg(*aggs).select(*keys, F.explode(F.array(*fields)).alias("r"))
             .select(*keys, "r.*"))
    if probs and not together:
        q = quantile_columns(df, columns, probs, keys, exact_rows=exact_rows)
        out = join_same(out, q, [*keys, "variable"], "left")
    return out


def describe(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), **sizes) -> DataFrame:
    """count, mean, sample std, min, quartiles, max (per group when keyed)."""
    return summary(df, columns, ["count", "mean", "std", "min", "max"], QUARTILES, keys, **sizes)


def advanced_statistics(df: DataFrame, columns: Sequence[str], **sizes) -> DataFrame:
    probs = {"p1": 0.01, "p5": 0.05, **QUARTILES, "p95": 0.95, "p99": 0.99}
    base = summary(df, columns, ["count", "missing", "mean", "std", "min", "max", "skew_pop", "kurt_pop"],
                   probs, **sizes)
    n = F.col("count").cast("double")
    return base.select(
        "variable", "count", "missing", "mean", "std", "min", *probs, "max",
        corrected_skew(n, F.col("skew_pop")).alias("skewness"),
        corrected_kurtosis(n, F.col("kurt_pop")).alias("kurtosis"),
        F.try_divide("std", "mean").alias("cv"), (F.col("max") - F.col("min")).alias("range"),
        (F.col("q75") - F.col("q25")).alias("iqr"))


MAD_SCALE = 1.4826


def median_deviation(df: DataFrame, columns: Sequence[str], scale: float = 1.0,
                     **sizes) -> dict[str, float | None]:
    """Median of the distance from the median, times ``scale``."""
    mid = quantile_table(df, columns, [0.5], **sizes)
    known = [c for c in columns if mid.get((c, 0.5)) is not None]
    away = df.select(*[F.abs(number(c) - F.lit(mid[c, 0.5])).alias(c) for c in known])
    mad = quantile_table(away, known, [0.5], **sizes) if known else {}
    return {c: (mad[c, 0.5] * scale if (c, 0.5) in mad else None) for c in columns}


def descriptive_table(df: DataFrame, columns: Sequence[str], **sizes) -> DataFrame:
    """All statistics of a numeric column in one row per column."""
    probs = {"p1": 0.01, "p5": 0.05, "p10": 0.1, **QUARTILES, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    base = summary(df, columns, ["count", "missing", "mean", "std", "variance", "min", "max", "sum",
                                 "skew_pop", "kurt_pop"], probs, **sizes)
    mad = median_deviation(df, columns, MAD_SCALE, **sizes)
    mads = F.create_map(*[x for c, v in mad.items() for x in (F.lit(c), F.lit(v).cast("double"))])
    n = F.col("count").cast("double")
    return base.select(
        "variable", "count", "missing", "mean", F.col("q50").alias("median"), "std", "variance", "sum",
        "min", *probs, "max", (F.col("max") - F.col("min")).alias("range"),
        (F.col("q75") - F.col("q25")).alias("iqr"),
        corrected_skew(n, F.col("skew_pop")).alias("skewness"),
        corrected_kurtosis(n, F.col("kurt_pop")).alias("kurtosis"),
        F.try_divide("std", "mean").alias("cv"), F.element_at(mads, F.col("variable")).alias("mad"))


def column_statistics(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, median, quartiles, both variances and deviations."""
    base = summary(df, [column], ["count", "mean", "var_pop", "std_pop", "variance", "std", "min", "max"],
                   QUARTILES)
    return base.withColumnRenamed("q50", "median")


def modes(df: DataFrame, column: str) -> DataFrame:
    """Every value of the highest frequency, one row each."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("frequency"))
    top = counts.agg(F.max("frequency")).first()[0]
    return counts.filter(F.col("frequency") == F.lit(top))


def distribution_moments(df: DataFrame, column: str) -> DataFrame:
    """Population mean, variance, skewness and excess kurtosis; NULL below 3 values."""
    base = summary(df, [column], ["count", "mean", "var_pop", "skew_pop", "kurt_pop"])
    enough = F.col("count") >= 3
    return base.select("variable", *[F.when(enough, F.col(c)).alias(new) for c, new in [
        ("mean", "mean"), ("var_pop", "variance"), ("skew_pop", "skewness"), ("kurt_pop", "kurtosis")]])


def skewed_columns(df: DataFrame, columns: Sequence[str], threshold: float = 0.5) -> DataFrame:
    base = summary(df, columns, ["count", "skew_pop"])
    skew = corrected_skew(F.col("count").cast("double"), F.col("skew_pop"))
    return (base.select("variable", skew.alias("skewness")).filter(F.abs("skewness") > threshold)
                .orderBy(F.abs("skewness").desc(), "variable"))


def value_share(df: DataFrame, *columns: str) -> DataFrame:
    """Count and percent of every value; the total is one number, read first."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))
    total = df.count()
    return counts.withColumn("percent", F.col("count") * 100.0 / F.lit(float(max(total, 1))))


# ---- histograms -------------------------------------------------------------

def bin_rules(df: DataFrame, column: str) -> DataFrame:
    """rule, bin_width, bin_count, chosen, fallback: the three rules and which
    of them the automatic choice takes.  Where the quartiles coincide, the
    first rule has no width and takes Sturges' instead (``fallback``)."""
    s = summary(df, [column], ["count", "min", "max"], QUARTILES).first()
    n, spread, iqr = s["count"], s["max"] - s["min"], s.q75 - s.q25
    k = sturges_bins(n)
    sturges = (spread / k, k)
    width = 2 * iqr / n ** (1 / 3)
    first = (width, max(1, int(spread / width))) if width > 0 else sturges
    chosen = ("Freedman-Diaconis" if iqr > 0.1 * spread else "Square Root" if n < 100 else "Sturges")
    rows = [("Freedman-Diaconis", *first, width <= 0), ("Square Root", spread / n ** 0.5, int(n ** 0.5), False),
            ("Sturges", *sturges, False)]
    return df.sparkSession.createDataFrame(
        [(r, float(w), int(c), r == chosen, f) for r, w, c, f in rows],
        "rule string, bin_width double, bin_count int, chosen boolean, fallback boolean")


def histogram(df: DataFrame, column: str, rule: str | None = None, bin_count: int | None = None,
              bin_width: float | None = None) -> DataFrame:
    """bin, low, high, count with empty bins; the last bin holds the maximum."""
    v = number(column)
    edge = df.agg(F.min(v).alias("low"), F.max(v).alias("high")).first()
    if bin_count is None and bin_width is None:
        picked = bin_rules(df, column).filter(F.col("rule") == rule if rule else F.col("chosen")).first()
        bin_count = picked.bin_count
    if bin_count is None:
        bin_count = max(1, int(-(-(edge.high - edge.low) // bin_width)))
    width = bin_width or (edge.high - edge.low) / bin_count or 1.0
    place = F.least(F.floor((v - F.lit(edge.low)) / F.lit(width)), F.lit(bin_count - 1)).cast("int")
    counts = df.filter(v.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    bins = df.sparkSession.range(bin_count).select(F.col("id").cast("int").alias("bin"))
    return bins.join(counts, "bin", "left").select(
        "bin", (F.lit(edge.low) + F.col("bin") * F.lit(width)).alias("low"),
        (F.lit(edge.low) + (F.col("bin") + 1) * F.lit(width)).alias("high"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_summary(df: DataFrame, column: str, keys: Sequence[str] = (), k: float = 1.5, **sizes) -> DataFrame:
    """q1, median, q3, whisker ends (last values inside the fences), outliers."""
    q = quantile_columns(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys, **sizes)
    fence = F.lit(k) * (F.col("q3") - F.col("q1"))
    q = q.withColumns({"_lo": F.col("q1") - fence, "_hi": F.col("q3") + fence})
    rows = df.select(*keys, number(column).alias("_v")).filter(F.col("_v").isNotNull())
    if keys:
        both = join_same(rows, q, keys)
    else:
        row = q.first()
        both = rows.withColumns({c: F.lit(row[c]) for c in q.columns})
    group = [*keys, "variable", "q1", "median", "q3"]
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return both.groupBy(*group).agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"), F.count("_v").alias("count"))


def ecdf(df: DataFrame, column: str, **sizes) -> DataFrame:
    """value, share of values at or below it (one row per distinct value)."""
    rows = df.select(number(column).alias("value"))
    total = rows.filter(F.col("value").isNotNull()).count()
    ranked = value_counts_ranked(rows, [], "value", **sizes)
    return ranked.select("value", "n", (F.col("upto") / F.lit(float(max(total, 1)))).alias("ecdf"))


def qq_points(df: DataFrame, column: str, distribution: str = "norm", **sizes) -> DataFrame:
    """theoretical, ordered: every value against the quantile of its rank, with
    order-statistic medians as plotting positions."""
    rows = df.select(number(column).alias("ordered")).filter(F.col("ordered").isNotNull())
    n = rows.count()
    placed = positions(rows, [], ["ordered"], "_pos", **sizes)
    i = F.col("_pos")
    p = (F.when(i == 1, 1 - 0.5 ** (1 / n)).when(i == n, 0.5 ** (1 / n))
          .otherwise((i - 0.3175) / (n + 0.365)))
    if distribution == "norm":
        placed = placed.withColumn("_p", p)
        theory = normal_quantile(F.col("_p"))
    elif distribution == "uniform":
        theory = p
    elif distribution == "expon":
        theory = -F.log1p(-p)
    else:
        raise ValueError("distribution must be norm, uniform or expon")
    return placed.select(theory.alias("theoretical"), "ordered")


def quantile_bins(df: DataFrame, column: str, levels: int, output: str = "bin", **sizes) -> DataFrame:
    """Bin number 0.. by quantile edges: right-closed, the lowest value
    included, repeated edges merged; adds the edges of the bin as well."""
    probs = [i / levels for i in range(levels + 1)]
    table = quantile_table(df, [column], probs, **sizes)
    edges = sorted({table[column, p] for p in probs})
    v = number(column)
    inner = edges[1:-1]
    spot = reduce(lambda a, b: a + b, [F.when(v > F.lit(e), 1).otherwise(0) for e in inner], F.lit(0))
    cuts = F.array(*[F.lit(e) for e in edges])
    return (df.withColumn(output, F.when(v.isNotNull(), spot))
              .withColumn(f"{output}_low", F.get(cuts, F.col(output)))
              .withColumn(f"{output}_high", F.get(cuts, F.col(output) + 1)))


def conditional_statistics(df: DataFrame, x: str, y: str, z: str, levels: int = 4) -> DataFrame:
    """Per quantile level of z: count, means of x and y and their correlation."""
    binned = quantile_bins(df, z, levels).filter(F.col("bin").isNotNull())
    return binned.groupBy("bin", "bin_low", "bin_high").agg(
        F.count(F.lit(1)).alias("count"), F.avg(number(x)).alias("mean_x"), F.avg(number(y)).alias("mean_y"),
        F.corr(number(x), number(y)).alias("corr"))


def scaled_group_profile(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Group means scaled to 0..1 over the groups; 0.5 where they are all equal.
    The second window spans the groups, whose number the first step reduced."""
    means = df.groupBy(key).agg(*[F.avg(number(c)).alias(c) for c in columns])
    span = means.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    return means.select(key, *[
        (F.lit(0.5) if span[f"hi_{c}"] == span[f"lo_{c}"]
         else (F.col(c) - F.lit(span[f"lo_{c}"])) / F.lit(span[f"hi_{c}"] - span[f"lo_{c}"])).alias(c)
        for c in columns])


def long_measures(df: DataFrame, category: str, measures: Sequence[str]) -> DataFrame:
    """category, measure, value: sums behind stacked and clustered bars."""
    sums = df.groupBy(category).agg(*[F.sum(number(m)).alias(m) for m in measures])
    return sums.unpivot([category], list(measures), "measure", "value")


def with_share(df: DataFrame, within: Sequence[str], value: str, output: str = "share") -> DataFrame:
    """Share of a group total; meant for aggregated (small) tables."""
    return df.withColumn(output, F.try_divide(F.col(value), F.sum(value).over(Window.partitionBy(*within))))
