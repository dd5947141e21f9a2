"""Intervals, tests and group comparisons.  Spark reduces the data to counts,
moments and rank sums; the distribution of the final statistic is looked up on
the driver."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import special
from ..functions.normal import normal_cdf
from ..functions.ordered import join_same, value_counts_ranked
from ..functions.quantiles import long_form, number, quantile_table, quantiles
from ..functions.sizes import broadcast_if_small
from ..functions.storage import materialise
from .normality import group_tests, upper_tail
from .profile import summary


def _one(df: DataFrame, row: tuple, schema: str) -> DataFrame:
    return df.sparkSession.createDataFrame([row], schema)


# ---- one sample -------------------------------------------------------------

def _interval(n: int, mean: float, var: float, confidence: float) -> tuple:
    half = special.t_ppf((1 + confidence) / 2, n - 1) * math.sqrt(var / n)
    low = (n - 1) * var / special.chi2_ppf((1 + confidence) / 2, n - 1)
    high = (n - 1) * var / special.chi2_ppf((1 - confidence) / 2, n - 1)
    return mean - half, mean + half, low, high


def confidence_interval(df: DataFrame, column: str, confidence: float = 0.95) -> DataFrame:
    """Mean with its t interval, variance with its chi-square interval."""
    s = summary(df, [column], ["count", "mean", "variance"]).first()
    return _one(df, (s["count"], s["mean"], s.variance, *_interval(s["count"], s["mean"], s.variance, confidence)),
                "count long, mean double, variance double, mean_low double, mean_high double, "
                "variance_low double, variance_high double")


def _t_statistic(n: int, mean: float, var: float, mu: float) -> float:
    if var > 0:
        return (mean - mu) / math.sqrt(var / n)
    return 0.0 if mean == mu else math.copysign(math.inf, mean - mu)


def t_test(df: DataFrame, column: str, mu: float, alpha: float = 0.05) -> DataFrame:
    """statistic, critical value, two-sided p, decision."""
    s = summary(df, [column], ["count", "mean", "variance"]).first()
    w = _t_statistic(s["count"], s["mean"], s.variance, mu)
    return _one(df, (w, special.t_ppf(1 - alpha / 2, s["count"] - 1),
                     special.t_two_sided(w, s["count"] - 1),
                     special.t_two_sided(w, s["count"] - 1) < alpha),
                "statistic double, critical double, p_value double, reject boolean")


def _order_number(row_id: str, *salt) -> Column:
    """Repeatable pseudo-random number of a row, exact in a double."""
    return F.shiftrightunsigned(F.xxhash64(F.col(row_id), *salt), 12).cast("double")


def split_sample(df: DataFrame, row_id: str, n: int | None = None, fraction: float | None = None,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Exactly n rows (or a fraction) and the rest.  Rows are ordered by a hash
    of their id; the n-th smallest hash is the cut, so both sides are filters."""
    total = df.count()
    wanted = int(round(fraction * total)) if n is None else n
    if wanted >= total:
        return df, df.limit(0)
    if wanted <= 0:
        return df.limit(0), df
    spot = _order_number(row_id, F.lit(seed))
    prob = (wanted - 0.5) / (total - 1)
    cut = quantile_table(df.select(spot.alias("h")), ["h"], [prob])["h", prob]
    return df.filter(spot < F.lit(cut)), df.filter(spot >= F.lit(cut))


def repeated_samples(df: DataFrame, row_id: str, column: str, runs: int, sample_size: int,
                     mu: float, confidence: float = 0.95, seed: int = 42) -> DataFrame:
    """Per run: a sample without replacement, its mean, variance, interval and
    t statistic.  A run takes the rows with the smallest hashes; only rows
    under a cut that surely holds enough of them leave the scan."""
    values = df.select(row_id, number(column).alias("v")).filter("v IS NOT NULL")
    total = values.count()
    if total < sample_size:
        raise ValueError("the sample is larger than the data")
    expected = sample_size + 8 * math.sqrt(sample_size) + 32
    top = float(2 ** 52)
    while True:
        cut = top * min(1.0, expected / total)
        order = lambda r: F.shiftrightunsigned(F.xxhash64(F.col(row_id), r, F.lit(seed)), 12).cast("double")
        hits = F.filter(F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda r: F.struct(r.alias("run"), order(r).alias("h"))),
                        lambda s: s.h < F.lit(cut))
        near = values.select(row_id, "v", F.explode(hits).alias("s")).select(row_id, "v", "s.run", "s.h")
        sizes = near.groupBy("run").count().agg(F.min("count").alias("low"), F.count(F.lit(1)).alias("runs")).first()
        if cut >= top or (sizes.runs == runs and sizes.low >= sample_size):
            break
        expected *= 2
    place = F.row_number().over(Window.partitionBy("run").orderBy("h", row_id))
    stats = (near.withColumn("place", place).filter(F.col("place") <= sample_size)
             .groupBy("run").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.var_samp("v").alias("variance")))
    t = special.t_ppf((1 + confidence) / 2, sample_size - 1)
    chi_low = special.chi2_ppf((1 - confidence) / 2, sample_size - 1)
    chi_high = special.chi2_ppf((1 + confidence) / 2, sample_size - 1)
    half = F.sqrt(F.col("variance") / F.col("n")) * t
    spread = (F.col("n") - 1) * F.col("variance")
    return stats.withColumns({
        "mean_low": F.col("mean") - half, "mean_high": F.col("mean") + half,
        "variance_low": spread / chi_high, "variance_high": spread / chi_low,
        "statistic": F.try_divide(F.col("mean") - mu, F.sqrt(F.col("variance") / F.col("n")))})


# ---- distributions ----------------------------------------------------------

def normality(df: DataFrame, columns: Sequence[str], alpha: float = 0.05, test: str = "shapiro", **sizes) -> DataFrame:
    """variable, test, statistic, p_value, fits: one row per column, of whole columns of any size; see
    ``normality.group_tests`` for the tests.  Columns without values have none."""
    named = {f"_{i}": c for i, c in enumerate(columns)}
    rows = long_form(df.select(*[number(c).alias(k) for k, c in named.items()]), list(named))
    found = group_tests(rows, ["variable"], "value", test, **sizes)
    names = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    known = found.select(F.element_at(names, F.col("variable")).alias("variable"), "test", "statistic", "p_value", (F.col("p_value") > alpha).alias("fits"))
    return join_same(df.sparkSession.createDataFrame([(c,) for c in columns], "variable string"), known, ["variable"], "left")


def _cdf(name: str, v: Column, p: dict[str, float]) -> Column:
    if name == "uniform":
        return F.when(F.lit(p["scale"]) > 0, (v - F.lit(p["loc"])) / F.lit(p["scale"])).otherwise(F.lit(1.0))
    if name == "expon":
        return F.when(v <= 0, F.lit(0.0)).otherwise(1 - F.exp(-v / F.lit(p["scale"])))
    if name == "norm":
        return normal_cdf(F.col("z"))
    return F.when(v <= 0, F.lit(0.0)).otherwise(normal_cdf(F.col("z")))


def _standard(name: str, v: Column, p: dict[str, float]) -> Column:
    """The value (or its logarithm) less the mean, over the spread, for the normal forms."""
    if name == "norm":
        return F.try_divide(v - F.lit(p["loc"]), F.lit(p["scale"]))
    if name == "lognorm":
        return F.try_divide(F.ln(F.when(v > 0, v)) - F.lit(p["loc"]), F.lit(p["scale"]))
    return F.lit(None).cast("double")


def _parameters(df: DataFrame, column: str, name: str) -> dict[str, float]:
    v = number(column)
    logs = F.when(v > 0, F.ln(v))
    s = df.agg(F.min(v).alias("low"), F.max(v).alias("high"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"),
               F.avg(logs).alias("log_mean"), F.stddev_pop(logs).alias("log_std")).first()
    if name == "uniform":
        return {"loc": s.low, "scale": s.high - s.low}
    if name == "expon":
        return {"loc": 0.0, "scale": s["mean"]}
    if name == "norm":
        return {"loc": s["mean"], "scale": s["std"]}
    if name == "lognorm":
        return {"loc": s.log_mean, "scale": s.log_std}
    raise ValueError("distribution must be uniform, expon, norm or lognorm")


def _ks(df: DataFrame, column: str, name: str, **sizes) -> tuple[float, float, int, dict]:
    p = _parameters(df, column, name)
    ranked = value_counts_ranked(df.select(number(column).alias("v")), [], "v", **sizes)
    n = df.agg(F.count(number(column))).first()[0]
    f = F.col("f")
    below, at = (F.col("upto") - F.col("n")) / F.lit(float(n)), F.col("upto") / F.lit(float(n))
    d = (ranked.withColumn("z", _standard(name, F.col("v"), p)).withColumn("f", _cdf(name, F.col("v"), p))
         .agg(F.max(F.greatest(at - f, f - below))).first()[0])
    return float(d), special.kolmogorov_sf(d, n), n, p


def kolmogorov_smirnov(df: DataFrame, column: str, distribution: str, alpha: float = 0.05, **sizes) -> DataFrame:
    d, p, n, fitted = _ks(df, column, distribution, **sizes)
    return _one(df, (distribution, "Kolmogorov-Smirnov", d, p, p > alpha, fitted["loc"], fitted["scale"]),
                "distribution string, test string, statistic double, p_value double, fits boolean, loc double, scale double")


# Critical values at 15, 10, 5, 2.5 and 1 percent.
ANDERSON_LEVELS = [0.15, 0.10, 0.05, 0.025, 0.01]
ANDERSON_NORMAL = [0.576, 0.656, 0.787, 0.918, 1.092]
ANDERSON_EXPONENTIAL = [0.922, 1.078, 1.341, 1.606, 1.957]


def _anderson(df: DataFrame, column: str, name: str, alpha: float, **sizes) -> tuple:
    v = F.ln(F.when(number(column) > 0, number(column))) if name == "lognorm" else number(column)
    values = df.select(v.alias("v")).filter("v IS NOT NULL")
    s = values.agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std")).first()
    n = s.n
    ranked = value_counts_ranked(values, [], "v", **sizes)
    if name == "expon":
        low = 1 - F.exp(-F.col("v") / F.lit(s["mean"]))
        log_f, log_rest = F.ln(F.greatest(low, F.lit(1e-300))), -F.col("v") / F.lit(s["mean"])
        critical = [c / (1 + 0.6 / n) for c in ANDERSON_EXPONENTIAL]
    else:
        z = F.col("z")
        ranked = (ranked.withColumn("z", (F.col("v") - F.lit(s["mean"])) / F.lit(s["std"]))
                  .withColumns({"lo": normal_cdf(z), "hi": normal_cdf(-z)}))
        log_f, log_rest = F.ln(F.greatest("lo", F.lit(1e-300))), F.ln(F.greatest("hi", F.lit(1e-300)))
        critical = [c / (1 + 4 / n - 25 / n / n) for c in ANDERSON_NORMAL]
    # equal values share their ranks: sums of 2i-1 and 2n+1-2i over the run
    upto, before = F.col("upto").cast("double"), (F.col("upto") - F.col("n")).cast("double")
    first = upto * upto - before * before
    second = (n - before) * (n - before) - (n - upto) * (n - upto)
    total = ranked.agg(F.sum(first * log_f + second * log_rest)).first()[0]
    stat = -n - total / n
    nearest = int(np.argmin([abs(level - alpha) for level in ANDERSON_LEVELS]))
    return float(stat), float(critical[nearest]), ANDERSON_LEVELS[nearest]


def anderson_darling(df: DataFrame, column: str, distribution: str = "norm", alpha: float = 0.05, **sizes) -> DataFrame:
    stat, critical, level = _anderson(df, column, distribution, alpha, **sizes)
    return _one(df, (distribution, "Anderson-Darling", stat, critical, level, stat < critical),
                "distribution string, test string, statistic double, critical double, level double, fits boolean")


def distribution_fits(df: DataFrame, column: str, alpha: float = 0.05,
                      names: Sequence[str] = ("norm", "uniform", "expon", "lognorm"), normal_test: str = "shapiro", **sizes) -> DataFrame:
    """One row per candidate; ``best`` has the highest p-value, or the lowest
    statistic where no candidate has one.  ``normal_test`` is the test of the normal candidate."""
    rows = []
    for name in names:
        if name == "norm":
            r = normality(df, [column], alpha, normal_test, **sizes).first()
            rows.append((name, r.test, r.statistic, r.p_value, None, r.fits))
        elif name in ("uniform", "expon"):
            d, p, _, _ = _ks(df, column, name, **sizes)
            rows.append((name, "Kolmogorov-Smirnov", d, p, None, p > alpha))
        else:
            stat, critical, _ = _anderson(df, column, name, alpha, **sizes)
            rows.append((name, "Anderson-Darling", stat, None, critical, stat < critical))
    with_p = [r for r in rows if r[3] is not None]
    best = max(with_p, key=lambda r: r[3]) if with_p else min(rows, key=lambda r: r[2])
    return df.sparkSession.createDataFrame(
        [(column, *r, r is best) for r in rows],
        "variable string, distribution string, test string, statistic double, p_value double, critical double, "
        "fits boolean, best boolean")


def analyse_distributions(df: DataFrame, columns: Sequence[str], alpha: float = 0.05, **sizes) -> DataFrame:
    out = [distribution_fits(df, c, alpha, **sizes) for c in columns]
    for part in out[1:]:
        out[0] = out[0].unionByName(part)
    return out[0]


# ---- groups -----------------------------------------------------------------

RESULT = "test string, statistic double, p_value double, df1 double, df2 double"


def _group_table(df: DataFrame, value: str, group: str) -> DataFrame:
    """group, n, mean, var of every group with values."""
    v = number(value)
    return (df.filter(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var")).filter("n > 0"))


def _two_groups(df: DataFrame, value: str, group: str, groups: Sequence | None) -> DataFrame:
    """Rows of the two named groups; without names there must be exactly two."""
    if groups is not None:
        if len(set(groups)) != 2:
            raise ValueError("two groups are needed")
        return df.filter(F.col(group).isin(list(groups)))
    found = df.filter(F.col(group).isNotNull() & number(value).isNotNull()).select(group).distinct().limit(3).count()
    if found != 2:
        raise ValueError("at least two groups are needed" if found < 2 else "more than two groups: name the two to compare")
    return df


def two_group_t(df: DataFrame, value: str, group: str, groups: Sequence | None = None) -> DataFrame:
    """Pooled-variance t test of the two groups, in name order; without spread there is no statistic."""
    found = _group_table(_two_groups(df, value, group, groups), value, group).orderBy(group).collect()
    if len(found) < 2:
        raise ValueError("at least two groups are needed")
    a, b = found
    dof = a.n + b.n - 2
    spread = (a.n - 1) * (a["var"] or 0.0) + (b.n - 1) * (b["var"] or 0.0)
    if not spread:
        return _one(df, ("t-test", None, None, float(dof), None), RESULT)
    t = (a["mean"] - b["mean"]) / math.sqrt(spread / dof * (1 / a.n + 1 / b.n))
    return _one(df, ("t-test", t, special.t_two_sided(t, dof), float(dof), None), RESULT)


def _f_test(df: DataFrame, value: str, group: str) -> tuple[float, float, int, int, float]:
    """Sums of squares from the group table, whatever the number of groups."""
    grand = df.filter(F.col(group).isNotNull()).agg(F.avg(number(value))).first()[0]
    away = F.col("mean") - F.lit(grand)
    s = _group_table(df, value, group).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * away * away).alias("between"),
        F.sum((F.col("n") - 1) * F.coalesce("var", F.lit(0.0))).alias("within")).first()
    if s.k < 2:
        raise ValueError("at least two groups are needed")
    d1, d2 = s.k - 1, s.n - s.k
    f = math.inf if s.within == 0 else (s.between / d1) / (s.within / d2)
    return f, special.f_sf(f, d1, d2) if f < math.inf else 0.0, d1, d2, s.within / d2


def anova(df: DataFrame, value: str, group: str) -> DataFrame:
    f, p, d1, d2, _ = _f_test(df, value, group)
    return _one(df, ("One-way ANOVA", f, p, float(d1), float(d2)), RESULT)


def levene(df: DataFrame, value: str, group: str, **sizes) -> DataFrame:
    """Equal spread: ANOVA of the distances from the group medians."""
    kept = df.filter(F.col(group).isNotNull()).select(group, number(value).alias("v")).filter("v IS NOT NULL")
    middle = quantiles(kept, ["v"], [0.5], [group], **sizes).select(F.col(group).alias("_g"), F.col("value").alias("_m"))
    away = kept.join(broadcast_if_small(middle), F.col(group) == F.col("_g")).select(
        group, F.abs(F.col("v") - F.col("_m")).alias("v"))
    f, p, d1, d2, _ = _f_test(away, "v", group)
    return _one(df, ("Levene", f, p, float(d1), float(d2)), RESULT)


PAIRWISE = "group1 string, group2 string, difference double, statistic double, p_value double, reject boolean"


def _pairs(groups: DataFrame, name: str, *columns: str) -> DataFrame:
    """Every pair of groups once, in name order: a table of pairs is the result, so this join makes no more than that."""
    groups = materialise(groups.select(name, *columns))
    a = groups.select(F.col(name).alias("_a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    b = groups.select(F.col(name).alias("_b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return a.join(b, F.col("_a") < F.col("_b")).withColumns({"group1": F.col("_a").cast("string"), "group2": F.col("_b").cast("string")})


def tukey(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """All pairs of groups against the studentised range."""
    _, _, k, dof, mse = _f_test(df, value, group)
    q = F.abs("difference") / F.sqrt(F.lit(mse / 2) * (1 / F.col("n_a") + 1 / F.col("n_b"))) if mse else F.lit(None).cast("double")
    pairs = _pairs(_group_table(df, value, group), group, "n", "mean").withColumn("difference", F.col("mean_b") - F.col("mean_a")).withColumn("statistic", q)

    def tails(q: pd.Series) -> pd.Series:
        return q.map(lambda x: None if pd.isna(x) else float(special.studentized_range_sf(x, k + 1, dof))).astype(float)
    p = F.pandas_udf(tails, "double")(F.col("statistic"))
    return pairs.withColumn("p_value", p if mse else F.lit(None).cast("double")).select(
        "group1", "group2", "difference", "statistic", "p_value", (F.col("p_value") < alpha).alias("reject"))


def _rank_sums(df: DataFrame, value: str, group: str, **sizes) -> tuple[DataFrame, float, int]:
    """Per group its size and rank sum; the tie term and count of all values.
    Rows are first counted by (value, group), so repeated values cost nothing."""
    kept = df.filter(F.col(group).isNotNull()).select(F.col(group).alias("g"), number(value).alias("v")).filter("v IS NOT NULL")
    cells = kept.groupBy("v", "g").agg(F.count(F.lit(1)).alias("c"))
    ranked = value_counts_ranked(kept, [], "v", **sizes)
    sums = (cells.join(ranked, "v").groupBy("g")
            .agg(F.sum("c").alias("n"), F.sum(F.col("c") * (F.col("upto") - (F.col("n") - 1) / 2.0)).alias("ranks")))
    w = F.col("n").cast("double")
    s = ranked.agg(F.sum(w * w * w - w).alias("ties"), F.sum("n").alias("n")).first()
    return sums, s.ties, s.n


def _exact_mann_whitney(u: float, n1: int, n2: int) -> float:
    counts = np.zeros(n1 * n2 + 1)
    counts[0] = 1.0  # coefficients of the Gaussian binomial
    for i in range(1, n1 + 1):
        up, down = n2 + i, i
        counts[up:] = counts[up:] - counts[:-up]  # times 1 - x^up
        whole = np.zeros(-(-len(counts) // down) * down)
        whole[:len(counts)] = counts
        counts = whole.reshape(-1, down).cumsum(axis=0).ravel()[:len(counts)]  # over 1 - x^down
    tail = counts[int(math.ceil(u)):].sum() / counts.sum()
    return float(min(1.0, 2 * tail))


def mann_whitney(df: DataFrame, value: str, group: str, groups: Sequence | None = None, exact: bool | None = None, **sizes) -> DataFrame:
    """U of the first of two groups in name order, two-sided, tie-corrected.
    The exact p-value is for values without ties whose smaller group has at
    most 8, unless ``exact`` says which to use."""
    sums, ties, n = _rank_sums(_two_groups(df, value, group, groups), value, group, **sizes)
    found = sums.orderBy("g").collect()
    if len(found) < 2:
        raise ValueError("at least two groups are needed")
    a, b = found
    u1 = a.ranks - a.n * (a.n + 1) / 2
    u = max(u1, a.n * b.n - u1)
    if exact if exact is not None else ties == 0 and min(a.n, b.n) <= 8:
        p = _exact_mann_whitney(u, a.n, b.n)
    else:
        scale = math.sqrt(a.n * b.n / 12 * (n + 1 - ties / (n * (n - 1))))
        p = min(1.0, 2 * special.norm_sf((u - a.n * b.n / 2 - 0.5) / scale)) if scale else 1.0
    return _one(df, ("Mann-Whitney U test", u1, p, None, None), RESULT)


def kruskal(df: DataFrame, value: str, group: str, **sizes) -> DataFrame:
    sums, ties, n = _rank_sums(df, value, group, **sizes)
    s = sums.agg(F.count(F.lit(1)).alias("k"), F.sum(F.col("ranks") * F.col("ranks") / F.col("n")).alias("s")).first()
    if s.k < 2:
        raise ValueError("at least two groups are needed")
    if ties / (n ** 3 - n) >= 1:  # one value only
        return _one(df, ("Kruskal-Wallis H test", None, None, float(s.k - 1), None), RESULT)
    h = (12 / (n * (n + 1)) * s.s - 3 * (n + 1)) / (1 - ties / (n ** 3 - n))
    return _one(df, ("Kruskal-Wallis H test", h, special.chi2_sf(h, s.k - 1), float(s.k - 1), None), RESULT)


def dunn(df: DataFrame, value: str, group: str, alpha: float = 0.05, **sizes) -> DataFrame:
    """Pairwise z of mean ranks, tie-corrected, Bonferroni-adjusted."""
    sums, ties, n = _rank_sums(df, value, group, **sizes)
    base = n * (n + 1) / 12 - ties / (12 * (n - 1)) if n > 1 else 0.0
    means = materialise(sums.select("g", "n", (F.col("ranks") / F.col("n")).alias("mean")))
    k = means.count()
    z = F.abs("difference") / F.sqrt(F.lit(float(base)) * (1 / F.col("n_a") + 1 / F.col("n_b"))) if base > 0 else F.lit(None).cast("double")
    pairs = _pairs(means, "g", "n", "mean").withColumn("difference", F.col("mean_a") - F.col("mean_b")).withColumn("statistic", z)
    p = F.least(F.lit(1.0), 2 * upper_tail(F.col("statistic")) * F.lit(k * (k - 1) / 2))
    return pairs.withColumn("p_value", F.when(F.col("statistic").isNotNull(), p)).select(
        "group1", "group2", "difference", "statistic", "p_value", (F.col("p_value") < alpha).alias("reject"))


def group_normality(df: DataFrame, value: str, group: str, alpha: float = 0.05, test: str = "shapiro", **sizes) -> DataFrame:
    """group, test, statistic, p_value, normal; groups below 8 values are not tested."""
    kept = df.filter(F.col(group).isNotNull()).select(F.col(group).alias("g"), number(value).alias("v")).filter("v IS NOT NULL")
    found = group_tests(kept, ["g"], "v", test, **sizes)
    enough = F.col("n") >= 8
    return found.select(
        F.col("g").cast("string").alias("group"), F.when(enough, F.col("test")).otherwise("fewer than 8 values").alias("test"),
        F.when(enough, F.col("statistic")).alias("statistic"), F.when(enough, F.col("p_value")).alias("p_value"),
        F.when(enough, F.col("p_value") > alpha).alias("normal"))


def compare_groups(df: DataFrame, value: str, group: str, test: str = "auto", alpha: float = 0.05,
                   normal_test: str = "shapiro", **sizes) -> DataFrame:
    """The named test, or the one that normality (by ``normal_test``) and the
    number of groups ask for; a two-group t test always pools the variance."""
    if test == "auto":
        checks = group_normality(df, value, group, alpha, normal_test, **sizes).agg(
            F.count(F.lit(1)).alias("k"), F.bool_and(F.coalesce("normal", F.lit(False))).alias("normal")).first()
        normal, two = checks.normal, checks.k == 2
        test = ("ttest" if normal else "mannwhitney") if two else ("anova" if normal else "kruskal")
    run = {"ttest": two_group_t, "anova": anova}
    if test in run:
        return run[test](df, value, group)
    return {"mannwhitney": mann_whitney, "kruskal": kruskal}[test](df, value, group, **sizes)


def post_hoc(df: DataFrame, value: str, group: str, test: str, alpha: float = 0.05, **sizes) -> DataFrame:
    """Pairwise table after a significant ANOVA or Kruskal-Wallis, else empty."""
    overall = compare_groups(df, value, group, test, alpha, **sizes).first()
    if overall.p_value is None or overall.p_value >= alpha:
        return df.sparkSession.createDataFrame([], PAIRWISE)
    return tukey(df, value, group, alpha) if test == "anova" else dunn(df, value, group, alpha, **sizes)
