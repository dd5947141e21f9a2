"""Regression, projection and clustering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import components, regression
from .inference_queries import lines
from .registry import query

X = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("g01_simple_fits", " UNION ALL ".join(f"""
SELECT '{c}' AS predictor, regr_count(l_extendedprice, {c}) AS n, round(regr_intercept(l_extendedprice, {c}), 4) AS b0, round(regr_slope(l_extendedprice, {c}), 4) AS b1,
  round(regr_r2(l_extendedprice, {c}), 4) AS r2 FROM lineitem""" for c in X[:3]), digits=4)
def _(t):
    return regression.simple_fits(t("lineitem"), "l_extendedprice", X[:3]).select("predictor", "n", "b0", "b1", "r2")


@query("g01_simple_fit_tests")
def _(t):
    return regression.simple_fits(t("lineitem"), "l_extendedprice", X)


# Two predictors: the normal equations by hand.
_TWO = """(SELECT covar_pop(y, a) AS ya, covar_pop(y, b) AS yb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, avg(y) AS my, avg(a) AS ma, avg(b) AS mb
  FROM (SELECT l_extendedprice AS y, l_quantity AS a, l_discount AS b FROM lineitem))"""


@query("g02_multiple_fit", f"""
WITH s AS (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS b1, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS b2 FROM {_TWO})
SELECT 'l_quantity' AS term, round(b1, 4) AS coefficient FROM s UNION ALL SELECT 'l_discount', round(b2, 4) FROM s
UNION ALL SELECT '(intercept)', round(my - b1 * ma - b2 * mb, 4) FROM s""", digits=4)
def _(t):
    return regression.multiple_fit(t("lineitem"), "l_extendedprice", X[:2]).coefficients.select("term", "coefficient")


@query("g02_multiple_fit_model")
def _(t):
    return regression.multiple_fit(t("lineitem"), "l_extendedprice", X).model


@query("g03_stepwise")
def _(t):
    return regression.stepwise(t("lineitem"), "l_extendedprice", X).coefficients


@query("g04_log_trend", """
SELECT regr_count(l_extendedprice, ln(l_quantity)) AS n, round(regr_slope(l_extendedprice, ln(l_quantity)), 4) AS slope, round(regr_intercept(l_extendedprice, ln(l_quantity)), 4) AS intercept,
  round(corr(l_extendedprice, ln(l_quantity)), 4) AS r,
  round(sqrt((regr_syy(l_extendedprice, ln(l_quantity)) - pow(regr_slope(l_extendedprice, ln(l_quantity)), 2) * regr_sxx(l_extendedprice, ln(l_quantity))) / (regr_count(l_extendedprice, ln(l_quantity)) - 2) / regr_sxx(l_extendedprice, ln(l_quantity))), 4) AS std_error
FROM lineitem""", digits=4)
def _(t):
    return regression.trend(t("lineitem"), "l_quantity", "l_extendedprice", logarithmic=True).drop("p_value")


@query("g05_standardised_split_fit")
def _(t):
    return regression.split_fit(lines(t), "row_id", "l_extendedprice", X, 25, standardise=True).coefficients


@query("g06_forest_importance")
def _(t):
    return regression.forest_importance(t("orders").withColumn("yr", F.year("o_orderdate")), "o_orderkey", "o_totalprice", ["o_custkey", "yr"], trees=100).coefficients


_YEARLY = "(SELECT c_nationkey, CAST(year(o_orderdate) AS INT) AS yr, avg(o_totalprice) AS price FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"


def yearly(t):
    o = t("orders").withColumnRenamed("o_custkey", "c_custkey").join(t("customer"), "c_custkey")
    return o.groupBy("c_nationkey", F.year("o_orderdate").alias("yr")).agg(F.avg("o_totalprice").alias("price"))


@query("g07_project_linear", f"""
SELECT c_nationkey, CAST(last + k AS INT) AS yr, round(a + b * (last + k), 3) AS projected FROM (SELECT c_nationkey, regr_slope(price, yr) AS b, regr_intercept(price, yr) AS a,
  max(yr) AS last FROM {_YEARLY} GROUP BY c_nationkey HAVING count(*) >= 3), (SELECT unnest(range(1, 6)) AS k)""", digits=3)
def _(t):
    return regression.project_linear(yearly(t), "c_nationkey", "yr", "price")


@query("g08_project_quadratic", f"""
WITH p AS (SELECT *, yr - avg(yr) OVER (PARTITION BY c_nationkey) AS t, avg(yr) OVER (PARTITION BY c_nationkey) AS m FROM {_YEARLY}),
q AS (SELECT *, t * t - avg(t * t) OVER (PARTITION BY c_nationkey) AS z FROM p),
o AS (SELECT *, z - t * sum(z * t) OVER (PARTITION BY c_nationkey) / sum(t * t) OVER (PARTITION BY c_nationkey) AS w FROM q),
f AS (SELECT c_nationkey, m, max(yr) AS last, avg(price) AS my, avg(t * t) AS mtt, sum(t * price) / sum(t * t) AS b1, sum(z * t) / sum(t * t) AS zt, sum(w * price) / sum(w * w) AS b2 FROM o GROUP BY c_nationkey, m HAVING count(*) >= 3)
SELECT c_nationkey, CAST(yr AS INT) AS yr, round(my + b1 * (yr - m) + b2 * (pow(yr - m, 2) - mtt - zt * (yr - m)), 3) AS fitted FROM f JOIN
  (SELECT c_nationkey, yr FROM {_YEARLY} UNION ALL SELECT c_nationkey, last + k FROM f, (SELECT unnest(range(1, 11)) AS k)) USING (c_nationkey)""", digits=3)
def _(t):
    return regression.project_quadratic(yearly(t), "c_nationkey", "yr", "price")


FEATURES = [f"e{i}" for i in range(64)]


def vectors(t):
    return t("embeddings").select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(len(FEATURES))])


@query("g09_cluster_profile")
def _(t):
    return regression.clusters(vectors(t), FEATURES, 4, elbow=[]).profile


@query("g09_elbow")
def _(t):
    return regression.clusters(vectors(t), FEATURES, 4, starts=2).elbow


@query("g10_cluster_projection")
def _(t):
    rows = regression.clusters(vectors(t), FEATURES, 4, elbow=[]).rows
    return components.scores(rows, components.fit(rows, FEATURES, 2)).select("vec_id", "cluster", "PC1", "PC2")


@query("g11_split_fit_errors")
def _(t):
    return regression.split_fit(lines(t), "row_id", "l_extendedprice", X, 30).model


@query("g12_share_sweep")
def _(t):
    return regression.share_sweep(lines(t), "row_id", "l_extendedprice", X)


@query("g13_errors", """
SELECT count(*) AS n, round(avg(pow(y - p, 2)), 2) AS mse, round(avg(abs(y - p)), 4) AS mae, round(1 - avg(pow(y - p, 2)) / var_pop(y), 6) AS r2
FROM (SELECT l_extendedprice AS y, l_quantity * 1400 + 300 AS p FROM lineitem)""")
def _(t):
    li = t("lineitem").withColumn("p", F.col("l_quantity") * 1400 + 300)
    return regression.errors(li, "l_extendedprice", "p").withColumns({"mse": F.round("mse", 2), "mae": F.round("mae", 4)})
