"""Outliers, distribution tests, group comparisons and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components, correlation, inference, outliers
from . import normal_sql as NS
from . import workflows
from .registry import query

COLS = ["l_quantity", "l_extendedprice", "l_discount"]
EVENT = ["value", "user_id"]


def lines(t):
    """Line items with an id of their own."""
    return t("lineitem").withColumn("row_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))


_ROW = "concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS row_id"
_Z = "(value - avg(value) OVER ()) / stddev_samp(value) OVER ()"
_ZU = "(user_id - avg(user_id) OVER ()) / stddev_samp(user_id) OVER ()"


@query("f01_z_scores", f"SELECT event_id, round({_Z}, 6) AS value_zscore, round({_ZU}, 6) AS user_id_zscore FROM events")
def _(t):
    return outliers.z_scores(t("events"), EVENT).select("event_id", "value_zscore", "user_id_zscore")


@query("f02_z_score_flag", f"SELECT event_id, abs({_Z}) > 2 OR abs({_ZU}) > 2 AS is_outlier FROM events")
def _(t):
    return outliers.flag_by_z_score(t("events"), EVENT, 2.0).select("event_id", "is_outlier")


@query("f03_z_score_outliers", f"""
SELECT event_id, value, round(zv, 6) AS value_zscore, abs(zv) > 3 AS value_is_outlier, round(zu, 6) AS user_id_zscore, abs(zu) > 3 AS user_id_is_outlier
FROM (SELECT event_id, value, {_Z} AS zv, {_ZU} AS zu FROM events) WHERE abs(zv) > 3 OR abs(zu) > 3""")
def _(t):
    return outliers.z_score_outliers(t("events").select("event_id", *EVENT), EVENT).rows.drop("user_id")


@query("f04_z_score_long", f"""
SELECT 'value' AS variable, event_id, value, round(z, 6) AS zscore FROM (SELECT *, {_Z} AS z FROM events) WHERE abs(z) > 3
UNION ALL SELECT 'user_id', event_id, user_id, round(z, 6) FROM (SELECT *, {_ZU} AS z FROM events) WHERE abs(z) > 3""")
def _(t):
    return outliers.z_score_outliers_long(t("events"), "event_id", EVENT).rows


@query("f04_z_score_columns", " UNION ALL ".join(f"""
SELECT '{c}' AS variable, count(*) FILTER (abs(z) > 2) AS outliers, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min(z), 6) AS min_zscore, round(max(z), 6) AS max_zscore, round(count(*) FILTER (abs(z) > 2) * 100.0 / count({c}), 6) AS outlier_pct
FROM (SELECT *, ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS z FROM events)""" for c in EVENT))
def _(t):
    return outliers.z_score_outliers_long(t("events"), "event_id", EVENT, 2.0).columns


@query("f05_iterative_bounds")
def _(t):
    return outliers.iterative_bounds(t("events"), "value")


@query("f06_adaptive_lower_bound", "SELECT round(greatest(quantile_cont(value, 0.1), 1.0), 6) AS lower_bound FROM events")
def _(t):
    return outliers.adaptive_lower_bound(t("events"), "value")


_FENCE = """(SELECT quantile_cont({c}, .25) AS q1, quantile_cont({c}, .75) AS q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM {s})"""


@query("f07_fences", " UNION ALL ".join(f"""
SELECT '{c}' AS variable, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound FROM {_FENCE.format(c=c, s='lineitem')}"""
    for c in COLS))
def _(t):
    return outliers.fence_table(t("lineitem"), COLS)


@query("f08_iqr_outliers", " UNION ALL ".join(f"""
SELECT event_id, '{c}' AS variable, CAST({c} AS DOUBLE) AS value, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound, CASE WHEN {c} < lo THEN 'Low' ELSE 'High' END AS type
FROM events, {_FENCE.format(c=c, s='events')} WHERE {c} < lo OR {c} > hi""" for c in EVENT))
def _(t):
    return outliers.iqr_outliers(t("events"), "event_id", EVENT).rows


@query("f08_iqr_columns", f"""
WITH o AS (SELECT count(*) FILTER (value < v.lo OR value > v.hi) AS ov, count(*) FILTER (user_id < u.lo OR user_id > u.hi) AS ou, count(value) AS nv, count(user_id) AS nu
  FROM events, {_FENCE.format(c='value', s='events')} v, {_FENCE.format(c='user_id', s='events')} u)
SELECT 'value' AS variable, ov AS outliers, nv AS count, round(ov * 100.0 / (nv + nu), 6) AS outlier_cells_pct FROM o
UNION ALL SELECT 'user_id', ou, nu, round(ou * 100.0 / (nv + nu), 6) FROM o""")
def _(t):
    return outliers.iqr_outliers(t("events"), "event_id", EVENT).columns


@query("f09_iqr_flag", f"""
SELECT event_id, value < v.lo OR value > v.hi OR user_id < u.lo OR user_id > u.hi AS is_iqr_outlier
FROM events, {_FENCE.format(c='value', s='events')} v, {_FENCE.format(c='user_id', s='events')} u""")
def _(t):
    return outliers.flag_by_iqr(t("events"), EVENT).select("event_id", "is_iqr_outlier")


PCA = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("f10_pca_variance")
def _(t):
    return components.explained(t("lineitem").sparkSession, components.fit(t("lineitem"), PCA))


@query("f10_pca_scores")
def _(t):
    li = lines(t)
    model = components.fit(li, PCA, 2)
    return components.scores(li, model).select("row_id", "PC1", "PC2")


@query("f10_pca_loadings")
def _(t):
    return components.loadings(t("lineitem").sparkSession, components.fit(t("lineitem"), PCA), 3)


@query("f11_kaiser")
def _(t):
    return components.explained(t("lineitem").sparkSession, components.fit(t("lineitem"), PCA)).filter("kaiser")


@query("f12_importance")
def _(t):
    return components.importance(t("lineitem").sparkSession, components.fit(t("lineitem"), PCA))


# With two standardised columns both components are kept, and the squared
# distance in component space is the sum of the squared scores.
_DIST = """(SELECT event_id, pow((value - avg(value) OVER ()) / stddev_pop(value) OVER (), 2) + pow((user_id - avg(user_id) OVER ()) / stddev_pop(user_id) OVER (), 2) AS d FROM events)"""


@query("f13_pca_outliers", f"SELECT event_id, round(d, 5) AS distance FROM {_DIST} WHERE d > (SELECT median(d) + 3 * mad(d) FROM {_DIST})", digits=5)
def _(t):
    return components.distance_outliers(t("events"), EVENT, 2).rows.select("event_id", "distance")


_FOUND = f"""(SELECT event_id, 'zscore' AS method FROM (SELECT event_id, {_Z} AS z, {_ZU} AS zu FROM events) WHERE abs(z) > 3 OR abs(zu) > 3
UNION ALL SELECT event_id, 'iqr' FROM events, {_FENCE.format(c='value', s='events')} v, {_FENCE.format(c='user_id', s='events')} u
  WHERE value < v.lo OR value > v.hi OR user_id < u.lo OR user_id > u.hi)"""


def found(t):
    e = t("events")
    return {"zscore": outliers.z_score_outliers(e, EVENT).rows,
            "iqr": outliers.flag_by_iqr(e, EVENT).filter("is_iqr_outlier")}


_METHODS = f"(SELECT event_id, CAST(count(*) AS INT) AS method_count, CASE WHEN count(*) = 2 THEN 'zscore, iqr' ELSE min(method) END AS methods FROM {_FOUND} GROUP BY 1)"


@query("f14_consensus", f"SELECT * FROM {_METHODS}")
def _(t):
    return outliers.consensus(found(t), "event_id").rows


@query("f14_agreement", f"SELECT method_count, count(*) AS rows FROM {_METHODS} GROUP BY 1")
def _(t):
    return outliers.consensus(found(t), "event_id").agreement


@query("f14_overlaps", f"SELECT methods, count(*) AS rows FROM {_METHODS} GROUP BY 1")
def _(t):
    return outliers.consensus(found(t), "event_id").overlaps


@query("f15_cleaned_by_consensus", f"SELECT event_id, value FROM events WHERE event_id NOT IN (SELECT event_id FROM {_METHODS} WHERE method_count >= 2)")
def _(t):
    return outliers.without_outliers(t("events"), found(t), "event_id").select("event_id", "value")


@query("f15_cleaned_by_union", f"SELECT event_id, value FROM events WHERE event_id NOT IN (SELECT event_id FROM {_METHODS})")
def _(t):
    return outliers.without_outliers(t("events"), found(t), "event_id", "union").select("event_id", "value")


@query("f16_outlier_workflow")
def _(t):
    w = workflows.outlier_workflow(t("events").select("event_id", *EVENT), "event_id", EVENT)
    return w.second.consensus.rows


@query("f37_before_after", " UNION ALL ".join(f"""
SELECT '{c}' AS variable, round(a.m, 6) AS original_mean, round(a.s, 6) AS original_std, round(a.d, 6) AS original_median, round(b.m, 6) AS cleaned_mean,
  round(b.s, 6) AS cleaned_std, round(b.d, 6) AS cleaned_median, round((b.m - a.m) * 100 / a.m, 6) AS mean_change_pct, round((b.s - a.s) * 100 / a.s, 6) AS std_change_pct
FROM (SELECT avg({c}) AS m, stddev_samp({c}) AS s, median({c}) AS d FROM events) a,
  (SELECT avg({c}) AS m, stddev_samp({c}) AS s, median({c}) AS d FROM events WHERE event_id NOT IN (SELECT event_id FROM {_FOUND} WHERE method = 'iqr')) b""" for c in EVENT))
def _(t):
    e = t("events")
    return outliers.before_after(e, outliers.without_outliers(e, found(t), "event_id", "iqr"), EVENT)


# ---- inference --------------------------------------------------------------

@query("f17_confidence_interval")
def _(t):
    return inference.confidence_interval(t("orders"), "o_totalprice")


@query("f17_interval_centre", "SELECT count(o_totalprice) AS count, round(avg(o_totalprice), 4) AS mean, round(var_samp(o_totalprice), 0) AS variance FROM orders", digits=4)
def _(t):
    out = inference.confidence_interval(t("orders"), "o_totalprice")
    return out.select("count", "mean", F.round("variance", 0).alias("variance"))


@query("f18_t_test", "SELECT round((avg(value) - 50) / sqrt(var_samp(value) / count(value)), 6) AS statistic FROM events")
def _(t):
    return inference.t_test(t("events"), "value", 50.0).select("statistic")


@query("f18_t_test_decision")
def _(t):
    return inference.t_test(t("events"), "value", 50.0)


@query("f19_repeated_samples")
def _(t):
    return inference.repeated_samples(t("events"), "event_id", "value", 50, 30, 50.0)


@query("f20_split_sample", "SELECT CAST(round_even(count(*) * 0.7, 0) AS BIGINT) AS train, count(*) - CAST(round_even(count(*) * 0.7, 0) AS BIGINT) AS test FROM orders")
def _(t):
    a, b = inference.split_sample(t("orders"), "o_orderkey", fraction=0.7)
    side = lambda df, n: df.select(F.lit(n).alias("side"))
    both = side(a, 1).unionByName(side(b, 0))
    return both.agg(F.count_if(F.col("side") == 1).alias("train"), F.count_if(F.col("side") == 0).alias("test"))


def _shapiro(rows):
    return f"""SELECT variable, 'Shapiro-Wilk' AS test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, p_value > 0.05 AS fits FROM {NS.shapiro(rows)}"""


_EVENT_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS variable, {c}::DOUBLE AS v FROM events" for c in EVENT)


@query("f21_normality", _shapiro(_EVENT_ROWS))
def _(t):
    return inference.normality(t("events"), EVENT)


@query("f21_dagostino", """
SELECT variable, 'D''Agostino''s K^2' AS test, round(k2, 6) AS statistic, round(exp(-k2 / 2), 6) AS p_value, exp(-k2 / 2) > 0.05 AS fits FROM (
  SELECT variable, z1 * z1 + z2 * z2 AS k2 FROM (
    SELECT variable, asinh(skew * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) / sqrt(2 / (w - 1))) / sqrt(0.5 * ln(w)) AS z1,
      (1 - 2 / (9 * a) - sign(below) * cbrt(abs((1 - 2 / a) / below))) / sqrt(2 / (9 * a)) AS z2 FROM (
      SELECT *, 1 + (kurt + 3 - 3 * (n - 1) / (n + 1)) / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) * sqrt(2 / (a - 4)) AS below FROM (
        SELECT *, 6 + 8 / root * (2 / root + sqrt(1 + 4 / (root * root))) AS a FROM (
          SELECT *, -1 + sqrt(2 * (3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) - 1)) AS w,
            6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS root FROM (
            SELECT variable, any_value(n) AS n, avg(pow(x, 3)) / pow(avg(x * x), 1.5) AS skew, avg(pow(x, 4)) / pow(avg(x * x), 2) - 3 AS kurt FROM (
              SELECT variable, v - avg(v) OVER (PARTITION BY variable) AS x, count(*) OVER (PARTITION BY variable)::DOUBLE AS n FROM (""" + _EVENT_ROWS + """)) GROUP BY variable)))))) """)
def _(t):
    return inference.normality(t("events"), EVENT, test="dagostino")


@query("f21_normality_small", _shapiro("SELECT 's_acctbal' AS variable, s_acctbal::DOUBLE AS v FROM supplier"))
def _(t):
    return inference.normality(t("supplier"), ["s_acctbal"])


_KS = """
WITH r AS (SELECT value, count(*) AS c FROM events GROUP BY value), s AS (SELECT value, sum(c) OVER (ORDER BY value) AS upto, c, sum(c) OVER () AS n,
  (SELECT min(value) FROM events) AS lo, (SELECT max(value) FROM events) AS hi, (SELECT avg(value) FROM events) AS mean FROM r)
SELECT round(max(greatest(upto / n - f, f - (upto - c) / n)), 6) AS statistic FROM (SELECT *, {f} AS f FROM s)"""


@query("f22_ks_uniform", _KS.format(f="(value - lo) / (hi - lo)"))
def _(t):
    return inference.kolmogorov_smirnov(t("events"), "value", "uniform").select("statistic")


@query("f22_ks_exponential", _KS.format(f="1 - exp(-value / mean)"))
def _(t):
    return inference.kolmogorov_smirnov(t("events"), "value", "expon").select("statistic")


_KS_NORMAL = """
WITH r AS (SELECT {v} AS v, count(*) AS c FROM events WHERE value > {least} GROUP BY v),
s AS (SELECT *, sum(c) OVER (ORDER BY v) AS upto, (SELECT count(value) FROM events)::DOUBLE AS n, (v - (SELECT avg({v}) FROM events WHERE value > {least})) / (SELECT stddev_pop({v}) FROM events WHERE value > {least}) AS z FROM r),
d AS (SELECT max(greatest(upto / n - f, f - (upto - c) / n)) AS d, any_value(n) AS n FROM (SELECT *, {cdf} AS f FROM s))
SELECT '{name}' AS distribution, 'Kolmogorov-Smirnov' AS test, round(d, 6) AS statistic, round({tail}, 6) AS p_value, {tail} > 0.05 AS fits,
  round((SELECT avg({v}) FROM events WHERE value > {least}), 6) AS loc, round((SELECT stddev_pop({v}) FROM events WHERE value > {least}), 6) AS scale FROM d"""


@query("f22_ks_normal", _KS_NORMAL.format(name="norm", v="value", least="-1e300", cdf=NS.cdf("z"), tail=NS.kolmogorov_tail("d", "n")))
def _(t):
    return inference.kolmogorov_smirnov(t("events"), "value", "norm")


@query("f22_ks_lognormal", _KS_NORMAL.format(name="lognorm", v="ln(value)", least="0", cdf=NS.cdf("z"), tail=NS.kolmogorov_tail("d", "n")))
def _(t):
    return inference.kolmogorov_smirnov(t("events"), "value", "lognorm")


@query("f23_anderson_exponential", """
SELECT round(-n - total / n, 5) AS statistic FROM (SELECT any_value(n) AS n, sum((2 * i - 1) * (ln(1 - exp(-value / m)) - up / m)) AS total FROM (
  SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n, avg(value) OVER () AS m,
    lead(value, 0) OVER (ORDER BY value) AS v0, nth_up AS up FROM (
      SELECT a.value, b.value AS nth_up FROM (SELECT value, row_number() OVER (ORDER BY value) AS i FROM events) a
      JOIN (SELECT value, row_number() OVER (ORDER BY value DESC) AS i FROM events) b ON a.i = b.i)))""", digits=5)
def _(t):
    return inference.anderson_darling(t("events"), "value", "expon").select("statistic")


_ANDERSON = """(SELECT -n - total / n AS statistic, 0.787 / (1 + 4 / n - 25 / n / n) AS critical FROM (
  SELECT any_value(n) AS n, sum((2 * i - 1) * ln(greatest(lo, 1e-300)) + (2 * (n - i) + 1) * ln(greatest(hi, 1e-300))) AS total FROM (
    SELECT i, n, {lo} AS lo, {hi} AS hi FROM (
      SELECT row_number() OVER (ORDER BY v) AS i, count(*) OVER ()::DOUBLE AS n, (v - avg(v) OVER ()) / stddev_samp(v) OVER () AS z FROM (SELECT {v} AS v FROM events WHERE value > {least}))))
)""".format(lo=NS.cdf("z"), hi=NS.tail("z"), v="{v}", least="{least}")


@query("f23_anderson_normal", f"""
SELECT 'norm' AS distribution, 'Anderson-Darling' AS test, round(statistic, 5) AS statistic, round(critical, 5) AS critical, 0.05::DOUBLE AS level, statistic < critical AS fits
FROM {_ANDERSON.format(v='value', least='-1e300')}""", digits=5)
def _(t):
    return inference.anderson_darling(t("events"), "value", "norm")


_KS_PLAIN = f"""
SELECT '{{name}}' AS distribution, 'Kolmogorov-Smirnov' AS test, d AS statistic, {NS.kolmogorov_tail("d", "n")} AS p_value, NULL::DOUBLE AS critical, {NS.kolmogorov_tail("d", "n")} > 0.05 AS fits FROM (
  SELECT max(greatest(upto / n - f, f - (upto - c) / n)) AS d, any_value(n) AS n FROM (SELECT *, {{f}} AS f FROM (
    SELECT value, c, sum(c) OVER (ORDER BY value) AS upto, sum(c) OVER ()::DOUBLE AS n, (SELECT min(value) FROM events) AS lo, (SELECT max(value) FROM events) AS hi,
      (SELECT avg(value) FROM events) AS mean FROM (SELECT value, count(*) AS c FROM events GROUP BY value))))"""


@query("f24_distribution_fits", f"""
SELECT 'value' AS variable, distribution, test, round(statistic, 5) AS statistic, round(p_value, 5) AS p_value, round(critical, 5) AS critical, fits,
  coalesce(p_value = max(p_value) OVER (), false) AND row_number() OVER (PARTITION BY p_value ORDER BY place) = 1 AS best FROM (
  SELECT 1 AS place, 'norm' AS distribution, 'Shapiro-Wilk' AS test, statistic, p_value, NULL::DOUBLE AS critical, p_value > 0.05 AS fits FROM {NS.shapiro("SELECT 'value' AS variable, value::DOUBLE AS v FROM events")}
  UNION ALL SELECT 2, * FROM ({_KS_PLAIN.format(name="uniform", f="(value - lo) / (hi - lo)")})
  UNION ALL SELECT 3, * FROM ({_KS_PLAIN.format(name="expon", f="1 - exp(-value / mean)")})
  UNION ALL SELECT 4, 'lognorm', 'Anderson-Darling', statistic, NULL, critical, statistic < critical FROM {_ANDERSON.format(v='ln(value)', least='0')})""", digits=5)
def _(t):
    return inference.analyse_distributions(t("events"), ["value"])


_TWO = "(SELECT value, event_type AS g FROM events WHERE event_type IN ('click', 'view'))"


def two(t):
    return t("events").filter(F.col("event_type").isin("click", "view"))


@query("f25_two_group_t", f"""
SELECT round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2) * (1.0 / na + 1.0 / nb)), 6) AS statistic FROM (SELECT
  avg(value) FILTER (g = 'click') AS ma, avg(value) FILTER (g = 'view') AS mb, var_samp(value) FILTER (g = 'click') AS va, var_samp(value) FILTER (g = 'view') AS vb,
  count(*) FILTER (g = 'click') AS na, count(*) FILTER (g = 'view') AS nb FROM {_TWO})""")
def _(t):
    return inference.two_group_t(two(t), "value", "event_type").select("statistic")


_F = """SELECT round((sum(n * pow(m - grand, 2)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 6) AS statistic
FROM (SELECT *, sum(n * m) OVER () / sum(n) OVER () AS grand FROM (SELECT g, count(v) AS n, avg(v) AS m, var_samp(v) AS v FROM {src} GROUP BY g))"""


@query("f25_levene", _F.format(src="(SELECT g, abs(value - median(value) OVER (PARTITION BY g)) AS v FROM (SELECT event_type AS g, value FROM events))"))
def _(t):
    return inference.levene(t("events"), "value", "event_type").select("statistic")


@query("f26_anova", _F.format(src="(SELECT event_type AS g, value AS v FROM events)"))
def _(t):
    return inference.anova(t("events"), "value", "event_type").select("statistic")


@query("f26_tukey")
def _(t):
    return inference.tukey(t("events"), "value", "event_type")


@query("f26_tukey_ranges", """
WITH g AS (SELECT event_type AS g, count(value) AS n, avg(value) AS m, var_samp(value) AS v FROM events GROUP BY event_type)
SELECT a.g AS group1, b.g AS group2, round(b.m - a.m, 6) AS difference,
  round(abs(b.m - a.m) / sqrt((SELECT sum((n - 1) * v) / (sum(n) - count(*)) FROM g) / 2 * (1.0 / a.n + 1.0 / b.n)), 6) AS statistic
FROM g a JOIN g b ON a.g < b.g""")
def _(t):
    return inference.tukey(t("events"), "value", "event_type").select("group1", "group2", "difference", "statistic")


_RANKED = "(SELECT g, value, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2 AS r FROM {src})"


@query("f27_mann_whitney", f"""
SELECT round(sum(r) FILTER (g = 'click') - count(*) FILTER (g = 'click') * (count(*) FILTER (g = 'click') + 1) / 2, 6) AS statistic FROM {_RANKED.format(src=_TWO)}""")
def _(t):
    return inference.mann_whitney(two(t), "value", "event_type").select("statistic")


_ALL = "(SELECT event_type AS g, value FROM events)"


@query("f28_kruskal", f"""
SELECT round((12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (pow(n, 3) - n)), 6) AS statistic FROM
  (SELECT sum(n) AS n, sum(r * r / n) AS s FROM (SELECT g, CAST(count(*) AS DOUBLE) AS n, sum(r) AS r FROM {_RANKED.format(src=_ALL)} GROUP BY g)),
  (SELECT sum(pow(c, 3) - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM events GROUP BY value))""")
def _(t):
    return inference.kruskal(t("events"), "value", "event_type").select("statistic")


_DUNN = f"""
WITH g AS (SELECT g, CAST(count(*) AS DOUBLE) AS n, sum(r) / count(*) AS m FROM {_RANKED.format(src=_ALL)} GROUP BY g),
base AS (SELECT n * (n + 1) / 12 - ties / (12 * (n - 1)) AS base FROM (SELECT sum(n) AS n FROM g), (SELECT sum(pow(c, 3) - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM events GROUP BY value))),
z AS (SELECT a.g AS group1, b.g AS group2, a.m - b.m AS difference, abs(a.m - b.m) / sqrt(base * (1 / a.n + 1 / b.n)) AS z, (SELECT count(*) * (count(*) - 1) / 2 FROM g) AS pairs FROM g a JOIN g b ON a.g < b.g, base)
SELECT group1, group2, round(difference, 6) AS difference, round(z, 6) AS statistic, round(least(1.0, 2 * {NS.tail('z')} * pairs), 6) AS p_value, least(1.0, 2 * {NS.tail('z')} * pairs) < 0.05 AS reject FROM z"""


@query("f28_dunn", _DUNN)
def _(t):
    return inference.dunn(t("events"), "value", "event_type")


_NORMAL_GROUPS = f"(SELECT bool_and(p_value > 0.05) FROM {NS.shapiro('SELECT event_type AS variable, value::DOUBLE AS v FROM events')})"
_CHI4 = "exp(-h / 2) * list_sum(list_transform(range(0, k // 2), lambda j: pow(h / 2, j) / gamma(j + 1)))"


@query("f29_automatic_test", f"""
SELECT CASE WHEN {_NORMAL_GROUPS} THEN 'One-way ANOVA' ELSE 'Kruskal-Wallis H test' END AS test, round(h, 6) AS statistic,
  round({_CHI4}, 6) AS p_value, k::DOUBLE AS df1, NULL::DOUBLE AS df2 FROM (
  SELECT k - 1 AS k, (12.0 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - ties / (pow(n, 3) - n)) AS h FROM
    (SELECT count(*) AS k, sum(n) AS n, sum(r * r / n) AS s FROM (SELECT g, CAST(count(*) AS DOUBLE) AS n, sum(r) AS r FROM {_RANKED.format(src=_ALL)} GROUP BY g)),
    (SELECT sum(pow(c, 3) - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM events GROUP BY value)))""")
def _(t):
    return inference.compare_groups(t("events"), "value", "event_type")


# ---- correlation ------------------------------------------------------------

CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(cols, agg, src):
    return " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, {agg.format(a=a, b=b)} AS r FROM {src.format(a=a, b=b)}"
                              for i, a in enumerate(cols) for b in cols[i + 1:])


_PEARSON = _pairs_sql(CORR, "corr({a}, {b})", "lineitem")


@query("f30_pearson_matrix", f"""
SELECT var1, var2, round(r, 6) AS r FROM ({_PEARSON}) UNION ALL SELECT var2, var1, round(r, 6) FROM ({_PEARSON})
UNION ALL SELECT c, c, 1.0 FROM (VALUES {', '.join(f"('{c}')" for c in CORR)}) AS v(c)""")
def _(t):
    return correlation.correlation_matrix(t("lineitem"), CORR)


_AVG_RANK = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2"


@query("f30_spearman", f"SELECT var1, var2, round(r, 6) AS r FROM (" + _pairs_sql(
    CORR, "corr(x, y)",
    "(SELECT " + _AVG_RANK.format(c="{a}") + " AS x, " + _AVG_RANK.format(c="{b}") + " AS y FROM lineitem)") + ")")
def _(t):
    return correlation.correlation_pairs(t("lineitem"), CORR, "spearman")


@query("f30_kendall", "SELECT var1, var2, round(r, 6) AS r FROM (" + _pairs_sql(
    ["c_acctbal", "c_nationkey"],
    "(SELECT sum(sign(p.{a} - q.{a}) * sign(p.{b} - q.{b})) / sqrt(CAST(sum(abs(sign(p.{a} - q.{a}))) AS DOUBLE) * sum(abs(sign(p.{b} - q.{b})))) FROM customer p, customer q WHERE p.c_custkey < q.c_custkey)",
    "(SELECT 1)") + ")")
def _(t):
    return correlation.correlation_pairs(t("customer"), ["c_acctbal", "c_nationkey"], "kendall")


_STEPS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
_CELLS = "(SELECT {a} AS x, {b} AS y, count(*)::DOUBLE AS w FROM lineitem GROUP BY ALL)"


@query("f30_kendall_lineitem", " UNION ALL ".join(f"""
SELECT '{a}' AS var1, '{b}' AS var2, round((SELECT sum(p.w * q.w * sign(p.x - q.x) * sign(p.y - q.y)) FROM {_CELLS.format(a=a, b=b)} p, {_CELLS.format(a=a, b=b)} q)
  / sqrt((SELECT sum(p.w * q.w) FROM {_CELLS.format(a=a, b=b)} p, {_CELLS.format(a=a, b=b)} q WHERE p.x <> q.x) * (SELECT sum(p.w * q.w) FROM {_CELLS.format(a=a, b=b)} p, {_CELLS.format(a=a, b=b)} q WHERE p.y <> q.y)), 6) AS r"""
    for i, a in enumerate(_STEPS) for b in _STEPS[i + 1:]))
def _(t):
    return correlation.correlation_pairs(t("lineitem"), _STEPS, "kendall")


@query("f31_high_pairs", f"SELECT var1, var2, round(r, 6) AS r FROM ({_PEARSON}) WHERE abs(r) >= 0.001")
def _(t):
    return correlation.high_pairs(correlation.correlation_pairs(t("lineitem"), CORR), 0.001)


@query("f32_correlation_edges", f"SELECT var1 AS source, var2 AS target, round(abs(r), 6) AS weight, CASE WHEN r >= 0 THEN 'positive' ELSE 'negative' END AS sign FROM ({_PEARSON}) WHERE abs(r) >= 0.001")
def _(t):
    return correlation.correlation_edges(correlation.correlation_pairs(t("lineitem"), CORR), 0.001)


@query("f33_strongest_pairs", f"""
WITH p AS (SELECT var1 || ' - ' || var2 AS pair, r FROM ({_PEARSON}))
SELECT 'top' AS kind, pair, round(r, 6) AS r FROM (SELECT * FROM p ORDER BY abs(r) DESC LIMIT 5)
UNION ALL SELECT 'positive', pair, round(r, 6) FROM (SELECT * FROM p WHERE r > 0 ORDER BY r DESC LIMIT 1)
UNION ALL SELECT 'negative', pair, round(r, 6) FROM (SELECT * FROM p WHERE r < 0 ORDER BY r LIMIT 1)""")
def _(t):
    return correlation.strongest_pairs(correlation.correlation_pairs(t("lineitem"), CORR))


@query("f36_target_correlations", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr({c}, l_extendedprice), 6) AS r FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def _(t):
    return correlation.target_correlations(t("lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])


@query("f34_inflation_two", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(1 / (1 - pow(corr(l_quantity, l_extendedprice), 2)), 6) AS vif FROM lineitem" for c in ("l_quantity", "l_extendedprice")))
def _(t):
    return correlation.variance_inflation(t("lineitem"), ["l_quantity", "l_extendedprice"])


@query("f34_inflation")
def _(t):
    return correlation.variance_inflation(t("lineitem"), CORR)


@query("f35_correlation_report", f"SELECT var1, var2, round(r, 6) AS r FROM ({_PEARSON}) WHERE abs(r) >= 0.001")
def _(t):
    return workflows.correlation_report(t("lineitem"), CORR, threshold=0.001).high
