"""Normality tests for any number of values and groups.

Shapiro-Wilk's W is a ratio of sums over the ordered values.  Every value gets
its position (ordered work is split into blocks where a group is large), the
position gives its weight, and one aggregate per group gives the sums: no
value leaves the executors and no number of rows changes the test.  The
p-value is the published approximation, which its author checked up to 5000
values; beyond, it is the same formula.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.normal import erfc, normal_quantile, polynomial
from ..functions.ordered import join_same, positions

TESTS = ("shapiro", "dagostino", "auto")
#: From this size on, "auto" takes D'Agostino's K squared.
AUTO_ROWS = 5000

# Coefficients of the published approximation, highest power first.
LAST_WEIGHT = [-2.706056, 4.434685, -2.071190, -0.147981, 0.221157]
SECOND_WEIGHT = [-3.582633, 5.682633, -1.752461, -0.293762, 0.042981]
SMALL_MEAN = [-0.0006714, 0.025054, -0.39978, 0.5440]
SMALL_SPREAD = [-0.0020322, 0.062767, -0.77857, 1.3822]
LARGE_MEAN = [0.0038915, -0.083751, -0.31082, -1.5861]
LARGE_SPREAD = [0.0030302, -0.082676, -0.4803]


def upper_tail(z: Column) -> Column:
    return 0.5 * erfc(z * F.lit(0.5 ** 0.5))


def shapiro_wilk(rows: DataFrame, keys: Sequence[str], value: str, **sizes) -> DataFrame:
    """keys, n, statistic, p_value; NULL below 3 values."""
    rows = rows.select(*keys, F.col(value).alias("_v")).filter(F.col("_v").isNotNull())
    about = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.avg("_v").alias("_mean"))
    placed = positions(rows, keys, ["_v"], "_i", **sizes)
    placed = join_same(placed, about, keys) if keys else placed.crossJoin(F.broadcast(about))  # one row
    i, n, x = F.col("_i"), F.col("_n"), F.col("_x")
    placed = (placed.withColumns({"_p": (i - 0.375) / (n + 0.25), "_x": F.col("_v") - F.col("_mean")})
              .withColumn("_m", normal_quantile(F.col("_p"))))
    weighted = F.col("_m") * x
    sums = placed.groupBy(*keys).agg(
        F.max(n).alias("n"), F.sum(F.col("_m") * F.col("_m")).alias("mm"), F.sum(x * x).alias("ss"),
        F.sum(F.when((i > 1) & (i < n), weighted)).alias("inner1"), F.sum(F.when((i > 2) & (i < n - 1), weighted)).alias("inner2"),
        F.max(F.when(i == n, x)).alias("high1"), F.max(F.when(i == n - 1, x)).alias("high2"),
        F.max(F.when(i == 1, x)).alias("low1"), F.max(F.when(i == 2, x)).alias("low2"))
    n = F.col("n")
    sums = sums.withColumns({"p1": (n - 0.375) / (n + 0.25), "p2": (n - 1.375) / (n + 0.25), "u": 1 / F.sqrt(n)})
    sums = sums.withColumns({"m1": normal_quantile(F.col("p1")), "m2": normal_quantile(F.col("p2"))})
    u, mm = F.col("u"), F.col("mm")
    sums = sums.withColumns({
        "a1": polynomial(u, LAST_WEIGHT) * u + F.col("m1") / F.sqrt(mm), "a2": polynomial(u, SECOND_WEIGHT) * u + F.col("m2") / F.sqrt(mm)})
    a1, a2, far, near = F.col("a1"), F.col("a2"), F.col("high1") - F.col("low1"), F.col("high2") - F.col("low2")
    rest1 = (mm - 2 * F.col("m1") ** 2) / (1 - 2 * a1 * a1)
    rest2 = (mm - 2 * F.col("m1") ** 2 - 2 * F.col("m2") ** 2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)
    slope = (F.when(n == 3, F.lit(math.sqrt(0.5)) * far).when(n <= 5, F.col("inner1") / F.sqrt(rest1) + a1 * far)
             .otherwise(F.col("inner2") / F.sqrt(rest2) + a1 * far + a2 * near))
    w = F.when(n >= 3, F.when(F.col("ss") == 0, 1.0).otherwise(F.least(F.lit(1.0), slope * slope / F.col("ss"))))
    return _royston(sums.withColumn("statistic", w)).select(*keys, "n", "statistic", "p_value")


def _royston(sums: DataFrame) -> DataFrame:
    """Adds the p-value of W."""
    n, w = F.col("n"), F.col("statistic")
    y, log_n, gamma = F.ln(1 - w), F.ln(n), -2.273 + 0.459 * n
    small = (-F.ln(gamma - y) - polynomial(n, SMALL_MEAN)) / F.exp(polynomial(n, SMALL_SPREAD))
    large = (y - polynomial(log_n, LARGE_MEAN)) / F.exp(polynomial(log_n, LARGE_SPREAD))
    three = 6 / math.pi * (F.asin(F.sqrt(w)) - math.asin(math.sqrt(0.75)))
    sums = sums.withColumn("_z", F.when(w < 1, F.when(n <= 11, F.when(y < gamma, small)).otherwise(large)))
    return sums.withColumn("p_value", F.when(w.isNull(), F.lit(None).cast("double")).when((n == 3) & (F.col("ss") > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), three)))
                           .when(w >= 1, F.lit(1.0)).when(F.col("_z").isNull(), F.lit(0.0)).otherwise(upper_tail(F.col("_z"))))


def k_squared(n: Column, skew: Column, kurt: Column) -> tuple[Column, Column]:
    """D'Agostino's K squared and its p-value from the size, the population skewness and the excess kurtosis; NULL below 8 values."""
    n = n.cast("double")
    y = skew * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta2 - 1))
    z1 = F.asinh(y / F.sqrt(2 / (w2 - 1))) / F.sqrt(0.5 * F.ln(w2))
    x = (kurt + 3 - 3 * (n - 1) / (n + 1)) / F.sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5)))
    root = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / root * (2 / root + F.sqrt(1 + 4 / (root * root)))
    below = 1 + x * F.sqrt(2 / (a - 4))
    z2 = (1 - 2 / (9 * a) - F.signum(below) * F.cbrt(F.abs((1 - 2 / a) / below))) / F.sqrt(2 / (9 * a))
    k2 = F.when(n >= 8, z1 * z1 + z2 * z2)
    return k2, F.exp(-k2 / 2)


def dagostino(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, n, statistic, p_value from moments; NULL below 8 values and without spread."""
    v = F.col(value)
    s = rows.filter(v.isNotNull()).groupBy(*keys).agg(F.count(v).alias("n"), F.var_pop(v).alias("_var"), F.skewness(v).alias("_skew"), F.kurtosis(v).alias("_kurt"))
    spread = F.col("_var") > 0
    k2, p = k_squared(F.col("n"), F.when(spread, F.col("_skew")), F.when(spread, F.col("_kurt")))
    return s.select(*keys, "n", k2.alias("statistic"), p.alias("p_value"))


def group_tests(rows: DataFrame, keys: Sequence[str], value: str, test: str = "shapiro", **sizes) -> DataFrame:
    """keys, n, test, statistic, p_value of every group.  ``test`` is "shapiro" (at any size), "dagostino",
    or "auto": Shapiro-Wilk below 5000 values and K squared from there on."""
    if test not in TESTS:
        raise ValueError(f"test must be one of {', '.join(TESTS)}")
    named = {"shapiro": "Shapiro-Wilk", "dagostino": "D'Agostino's K^2"}

    def shaped(name: str, found: DataFrame) -> DataFrame:
        return found.select(*keys, "n", F.lit(named[name]).alias("test"), "statistic", "p_value")
    if test == "shapiro":
        return shaped(test, shapiro_wilk(rows, keys, value, **sizes))
    moments = shaped("dagostino", dagostino(rows, keys, value))
    if test == "dagostino":
        return moments
    few = rows.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < AUTO_ROWS).drop("_n")
    small = shaped("shapiro", shapiro_wilk(join_same(rows, few, keys, "left_semi"), keys, value, **sizes))
    return small.unionByName(moments.filter(F.col("n") >= AUTO_ROWS))
