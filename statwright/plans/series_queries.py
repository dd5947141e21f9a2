"""Ordered-series queries: events of a user in time order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series
from .registry import query

ARGS = (["user_id"], "ts", "value")
_P = "(SELECT user_id, epoch_us(ts) / 1e6 AS x, value AS y FROM events)"
_W = "WINDOW w AS (PARTITION BY user_id ORDER BY x, y)"
_CENTRAL = f"(SELECT * FROM (SELECT user_id, x, y, (lead(y) OVER w - lag(y) OVER w) / (lead(x) OVER w - lag(x) OVER w) AS g FROM {_P} {_W}) WHERE g IS NOT NULL)"


@query("h01_gradient_central", f"SELECT user_id, round(x, 3) AS x, round(g, 6) AS gradient FROM {_CENTRAL}")
def _(t):
    return series.gradient(t("events"), *ARGS).withColumn("x", F.round("x", 3))


@query("h01_gradient_forward", f"""
SELECT user_id, round(x, 3) AS x, round(g, 6) AS gradient FROM (SELECT user_id, x, (lead(y) OVER w - y) / (lead(x) OVER w - x) AS g FROM {_P} {_W}) WHERE g IS NOT NULL""")
def _(t):
    return series.gradient(t("events"), *ARGS, method="forward").withColumn("x", F.round("x", 3))


@query("h01_gradient_backward", f"""
SELECT user_id, round(x, 3) AS x, round(g, 6) AS gradient FROM (SELECT user_id, x, (y - lag(y) OVER w) / (x - lag(x) OVER w) AS g FROM {_P} {_W}) WHERE g IS NOT NULL""")
def _(t):
    return series.gradient(t("events"), *ARGS, method="backward").withColumn("x", F.round("x", 3))


# Weights of a cubic fitted to five evenly numbered points: centre and ends.
_SG = {"c": (-3, 12, 17, 12, -3, 35), "0": (69, 4, -6, 4, -1, 70), "1": (2, 27, 12, -8, 2, 35)}


def _sg(row, places):
    *w, d = _SG[row]
    return "(" + " + ".join(f"{v} * {p}" for v, p in zip(w, places)) + f") / {d}"


def _at(k):
    return "g" if k == 0 else f"lead(g, {k}) OVER w" if k > 0 else f"lag(g, {-k}) OVER w"


@query("h02_gradient_smoothed", f"""
SELECT user_id, round(x, 3) AS x, round(CASE WHEN n < 5 THEN g WHEN i = 1 THEN {_sg('0', [_at(k) for k in range(5)])} WHEN i = 2 THEN {_sg('1', [_at(k - 1) for k in range(5)])}
  WHEN i = n THEN {_sg('0', [_at(-k) for k in range(5)])} WHEN i = n - 1 THEN {_sg('1', [_at(1 - k) for k in range(5)])} ELSE {_sg('c', [_at(k) for k in range(-2, 3)])} END, 6) AS gradient
FROM (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY user_id) AS n FROM {_CENTRAL} {_W}) {_W}""")
def _(t):
    return series.gradient(t("events"), *ARGS, smooth=5).withColumn("x", F.round("x", 3))


_SECOND = f"(SELECT * FROM (SELECT user_id, x, y, g, (lead(g) OVER w - lag(g) OVER w) / (lead(x) OVER w - lag(x) OVER w) AS h FROM {_CENTRAL} {_W}) WHERE h IS NOT NULL)"


@query("h03_second_derivative", f"SELECT user_id, round(x, 3) AS x, round(h * 1e6, 6) AS second FROM {_SECOND}")
def _(t):
    return series.second_derivative(t("events"), *ARGS).withColumns({"x": F.round("x", 3), "second": F.col("second") * 1e6})


@query("h04_gradient_outliers", f"""
SELECT user_id, round(x, 3) AS x, round(g, 6) AS gradient, round(z, 6) AS zscore FROM (
  SELECT *, (g - avg(g) OVER (PARTITION BY user_id)) / nullif(stddev_pop(g) OVER (PARTITION BY user_id), 0) AS z FROM {_CENTRAL}) WHERE abs(z) > 2.5""")
def _(t):
    return series.gradient_outliers(t("events"), *ARGS, threshold=2.5).withColumn("x", F.round("x", 3))


# The middle points of a series of four have only each other: their second derivative is the difference of the two.
_ALL = "(SELECT user_id, epoch_us(ts) / 1e6 AS x, value AS y FROM events)"
_DERIV = f"""d1 AS (SELECT *, (lead(y) OVER w - lag(y) OVER w) / (lead(x) OVER w - lag(x) OVER w) AS d1 FROM {_ALL} {_W}),
d2 AS (SELECT *, CASE WHEN lag(d1) OVER w IS NOT NULL THEN (lead(d1) OVER w - lag(d1) OVER w) / (lead(x) OVER w - lag(x) OVER w)
  WHEN lead(d1, 2) OVER w IS NULL THEN (lead(d1) OVER w - d1) / (lead(x) OVER w - x) END AS d2 FROM d1 {_W}),
n AS (SELECT *, lead(x) OVER w - x AS dx, lead(y) OVER w - y AS dy, lead(d1) OVER w AS e1, lead(d2) OVER w AS e2,
  coalesce(d2, lead(d2) OVER w, lag(d2) OVER w) AS here, coalesce(lead(d2) OVER w, lead(d2, 2) OVER w, d2) AS nxt FROM d2 {_W}),
k AS (SELECT *, CASE WHEN abs(e2 - d2) > 1e-10 THEN -d2 / (e2 - d2) ELSE 0 END AS t2, CASE WHEN abs(e1 - d1) > 1e-10 THEN -d1 / (e1 - d1) ELSE 0 END AS t1 FROM n)"""


@query("h05_turning_points", f"""
WITH {_DERIV}
SELECT user_id, 'inflection' AS type, round(x + t2 * dx, 3) AS x, round(y + t2 * dy, 6) AS y FROM k WHERE d2 * e2 <= 0 AND abs(d2) < 1e-6
UNION ALL SELECT user_id, CASE WHEN (CASE WHEN t1 = 0 THEN here ELSE nxt END) < 0 THEN 'maximum' ELSE 'minimum' END, round(x + t1 * dx, 3), round(y + t1 * dy, 6)
FROM k WHERE d1 * e1 <= 0 AND abs(d1) < 0.01 AND (CASE WHEN t1 = 0 THEN here ELSE nxt END) IS NOT NULL""")
def _(t):
    out = series.turning_points(t("events"), *ARGS, inflection_threshold=1e-6, extrema_threshold=0.01)
    return out.withColumn("x", F.round("x", 3))


_SEG = f"""(SELECT user_id, x - 1704067200 AS x, y, pos, CAST(least((pos - 1) // (n // 4), 3) AS INT) AS segment FROM
  (SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY user_id) AS n FROM {_P} {_W}) WHERE n >= 8)"""


def seconds(t):
    """Events with seconds since the first of January 2024."""
    return t("events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 - 1704067200)


@query("h06_piecewise_linear", f"""
SELECT user_id, segment, round(min(x), 3) AS start_x, round(max(x), 3) AS end_x, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 4) AS intercept
FROM {_SEG} GROUP BY ALL""")
def _(t):
    out = series.piecewise_slopes(seconds(t), ["user_id"], "s", "value", 4)
    return out.withColumns({"start_x": F.round("start_x", 3), "end_x": F.round("end_x", 3), "intercept": F.round("intercept", 4)})


@query("h06_piecewise_ends", f"""
SELECT user_id, segment, round(min(x), 3) AS start_x, round(max(x), 3) AS end_x, round((max_by(y, pos) - min_by(y, pos)) / (max(x) - min(x)), 6) AS slope,
  round(min_by(y, pos) - (max_by(y, pos) - min_by(y, pos)) / (max(x) - min(x)) * min(x), 4) AS intercept FROM {_SEG} GROUP BY ALL""")
def _(t):
    out = series.piecewise_slopes(seconds(t), ["user_id"], "s", "value", 4, "ends")
    return out.withColumns({"start_x": F.round("start_x", 3), "end_x": F.round("end_x", 3), "intercept": F.round("intercept", 4)})


@query("h06_piecewise_robust", f"""
WITH s AS (SELECT a.user_id, a.segment, median((b.y - a.y) / (b.x - a.x)) AS slope FROM {_SEG} a JOIN {_SEG} b
  ON a.user_id = b.user_id AND a.segment = b.segment AND a.x < b.x GROUP BY ALL)
SELECT user_id, segment, round(slope, 6) AS slope FROM s""")
def _(t):
    return series.piecewise_slopes(seconds(t), ["user_id"], "s", "value", 4, "robust").select("user_id", "segment", "slope")


@query("h07_slope_breaks", f"""
SELECT user_id, round(mx, 3) AS x, round(my, 6) AS y, round(s1, 6) AS slope1, round(s2, 6) AS slope2, round(ratio, 2) AS ratio FROM (
  SELECT *, CASE WHEN abs(s1) < 1e-10 AND abs(s2) < 1e-10 THEN 1.0 WHEN abs(s1) < 1e-10 THEN 3.0 WHEN s1 * s2 < 0 THEN greatest(abs(s2 / s1), 3.0) ELSE abs(s2 / s1) END AS ratio
  FROM (SELECT user_id, coalesce(regr_slope(y, x) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), 0) AS s1,
    coalesce(regr_slope(y, x) OVER (w ROWS BETWEEN 5 FOLLOWING AND 9 FOLLOWING), 0) AS s2, lead(x, 9) OVER w AS full_x,
    (lead(x, 4) OVER w + lead(x, 5) OVER w) / 2 AS mx, (lead(y, 4) OVER w + lead(y, 5) OVER w) / 2 AS my
    FROM (SELECT user_id, x - 1704067200 AS x, y FROM {_P}) {_W}) WHERE full_x IS NOT NULL) WHERE ratio > 2 OR ratio < 0.5""")
def _(t):
    out = series.slope_breaks(seconds(t), ["user_id"], "s", "value", 5, 2.0)
    return out.withColumns({"x": F.round("x", 3), "ratio": F.round("ratio", 2)})


@query("h08_series_summary")
def _(t):
    e = t("events").withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    return series.series_summary(e, ["user_id"], "ts", ["value", "k"])
