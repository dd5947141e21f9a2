"""Joins, grouped tables, pivots and column profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells
from ..functions.quantiles import quantile_table
from ..operators import joins, pivots, profile
from . import normal_sql as NS
from .registry import query

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
STATUSES = ["F", "O", "P"]


# ---- joins ------------------------------------------------------------------

@query("d01_inner_join", """
SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    c = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return joins.join_on(t("orders"), c, "o_custkey").select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


@query("d02_join_with_predicates", """
SELECT c_name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'""")
def _(t):
    o = t("orders").filter("o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    return joins.join_on(t("customer"), o, "c_custkey").select("c_name", "o_orderkey")


_OLD = "SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00'"


def recent_orders(t):
    return t("orders").filter(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz"))


@query("d03_anti_join", f"SELECT c_custkey, c_name FROM customer LEFT JOIN ({_OLD}) ON c_custkey = o_custkey WHERE o_custkey IS NULL")
def _(t):
    return joins.rows_without(t("customer"), recent_orders(t), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("d04_semi_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_OLD})")
def _(t):
    return joins.rows_in(t("customer"), recent_orders(t), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("d05_not_in", f"""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS k FROM orders
  WHERE k IS NOT NULL)""")
def _(t):
    o = t("orders").select(F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("k"))
    return joins.rows_not_in(t("customer"), o, "c_custkey", "k").select("c_custkey")


@query("d06_dimension_join", """
SELECT c_custkey, n_name, round((n_nationkey + 1) * 1000.0 / (n_regionkey + 1), 0) AS ratio,
  round(c_acctbal / ((n_nationkey + 1) * 1000) * 1000000, 4) AS density FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t):
    n = t("nation").withColumn("population", (F.col("n_nationkey") + 1) * 1000)
    out = joins.with_dimension(t("customer").withColumn("n_nationkey", F.col("c_nationkey")), n, "n_nationkey")
    return out.select("c_custkey", "n_name",
                      F.round(F.col("population") / (F.col("n_regionkey") + 1), 0).alias("ratio"),
                      F.round(F.col("c_acctbal") / F.col("population") * 1000000, 4).alias("density"))


@query("d07_cte_join_group", """
SELECT CAST(year(o_orderdate) AS INT) AS yr, CASE WHEN n_name IN ('NATION_7', 'NATION_8') THEN 'South' ELSE 'North' END AS area, round(avg(o_totalprice), 4) AS avg_price
FROM orders, customer, nation WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey
  AND n_name IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_7', 'NATION_8') GROUP BY ALL""", digits=4)
def _(t):
    areas = {"NATION_1": "North", "NATION_2": "North", "NATION_3": "North", "NATION_7": "South", "NATION_8": "South"}
    nations = cells.lookup_recode(t("nation").select("n_nationkey", "n_name"), "n_name", areas, "area").filter("area in ('North', 'South')")
    buyers = t("customer").join(F.broadcast(nations), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "area")
    sold = t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    return sold.groupBy(F.year("o_orderdate").alias("yr"), "area").agg(F.avg("o_totalprice").alias("avg_price"))


@query("d08_derived_table", """
SELECT c_mktsegment, min(o_totalprice) AS low, round(sum(o_totalprice) / count(o_totalprice), 4) AS mean, max(o_totalprice) AS high
FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment IS NOT NULL GROUP BY c_mktsegment""", digits=4)
def _(t):
    segments = t("customer").filter("c_mktsegment is not null").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return t("orders").join(segments, "o_custkey").groupBy("c_mktsegment").agg(
        F.min("o_totalprice").alias("low"), F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("high"))


# ---- profiles ---------------------------------------------------------------

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def per_column(columns, template, source="lineitem"):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, {template.replace('$', c)} FROM {source}" for c in columns)


_Q = ", ".join(f"round(quantile_cont($, {p}), 4) AS {n}" for n, p in
               [("p1", .01), ("p5", .05), ("p10", .1), ("q25", .25), ("q50", .5), ("q75", .75), ("p90", .9), ("p95", .95), ("p99", .99)])


@query("e01_describe", per_column(NUMBERS, """count($) AS count, round(avg($), 4) AS mean, round(stddev_samp($), 4) AS std, min($) AS min,
  round(quantile_cont($, .25), 4) AS q25, round(quantile_cont($, .5), 4) AS q50, round(quantile_cont($, .75), 4) AS q75, max($) AS max"""), digits=4)
def _(t):
    return profile.describe(t("lineitem"), NUMBERS)


_SHAPE = """round(skewness($), 4) AS skewness, round(kurtosis($), 4) AS kurtosis, round(stddev_samp($) / avg($), 4) AS cv,
  round(max($) - min($), 4) AS "range", round(quantile_cont($, .75) - quantile_cont($, .25), 4) AS iqr"""


@query("e02_advanced_statistics", "SELECT * EXCLUDE (p10, p90) FROM (" + per_column(NUMBERS, f"""count($) AS count,
  count(*) - count($) AS missing, round(avg($), 4) AS mean, round(stddev_samp($), 4) AS std, min($) AS min, {_Q}, max($) AS max, {_SHAPE}""") + ")", digits=4)
def _(t):
    return profile.advanced_statistics(t("lineitem"), NUMBERS)


@query("e03_descriptive_table", per_column(NUMBERS, f"""count($) AS count, count(*) - count($) AS missing,
  round(avg($), 4) AS mean, round(median($), 4) AS median, round(stddev_samp($), 4) AS std, round(var_samp($), 2) AS variance, round(sum($), 2) AS "sum",
  min($) AS min, {_Q}, max($) AS max, {_SHAPE}, round(mad($) * 1.4826, 4) AS mad"""), digits=4)
def _(t):
    out = profile.descriptive_table(t("lineitem"), NUMBERS)
    return out.withColumns({"variance": F.round("variance", 2), "sum": F.round("sum", 2)})


@query("e04_column_statistics", """
SELECT 'value' AS variable, count(value) AS count, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS var_pop,
  round(stddev_pop(value), 6) AS std_pop, round(var_samp(value), 6) AS variance, round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max,
  round(quantile_cont(value, .25), 6) AS q25, round(median(value), 6) AS median, round(quantile_cont(value, .75), 6) AS q75 FROM events""")
def _(t):
    return profile.column_statistics(t("events"), "value")


@query("e04_modes", """
SELECT l_quantity, n AS frequency FROM (SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1)
WHERE n = (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_quantity))""")
def _(t):
    return profile.modes(t("lineitem"), "l_quantity")


@query("e05_distribution_moments", """
SELECT 'value' AS variable, round(avg(value), 6) AS mean, round(var_pop(value), 6) AS variance,
  round(skewness(value) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6) AS skewness, round(kurtosis_pop(value), 6) AS kurtosis FROM events""")
def _(t):
    return profile.distribution_moments(t("events"), "value")


@query("e06_group_describe", """
SELECT event_type, 'value' AS variable, count(value) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std, min(value) AS min,
  round(quantile_cont(value, .25), 4) AS q25, round(quantile_cont(value, .5), 4) AS q50, round(quantile_cont(value, .75), 4) AS q75, max(value) AS max
FROM events GROUP BY event_type""", digits=4)
def _(t):
    return profile.describe(t("events"), ["value"], ["event_type"])


@query("e07_rounded_group_table", """
SELECT l_returnflag, l_linestatus, count(*) AS members, round(avg(l_extendedprice), 2) AS avg_value, round(avg(l_quantity), 2) AS avg_second,
  max(l_extendedprice) AS max_value, min(l_extendedprice) AS min_value, round(stddev_samp(l_extendedprice), 2) AS std_value,
  round(sum(l_extendedprice), 2) AS total_value FROM lineitem GROUP BY ALL ORDER BY total_value DESC""", digits=None)
def _(t):
    return pivots.rounded_group_table(t("lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", "l_quantity")


@query("e08_group_query", """
SELECT o_orderpriority, count(o_totalprice) AS orders, round(sum(o_totalprice) / count(o_totalprice), 2) AS mean_price,
  round(max(o_totalprice), 2) AS highest, round(min(o_totalprice), 2) AS lowest
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority HAVING count(o_totalprice) > 0""", digits=None)
def _(t):
    price = F.col("o_totalprice").cast("double")
    return t("orders").dropna(subset=["o_totalprice", "o_orderpriority"]).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.avg(price), 2).alias("mean_price"), F.round(F.max(price), 2).alias("highest"),
        F.round(F.min(price), 2).alias("lowest")).orderBy(F.desc("mean_price"))


@query("e09_conditional_counts", """
SELECT o_orderpriority, count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS filled, round(avg(o_totalprice), 2) AS mean_price,
  round(sum(o_totalprice), 2) AS turnover, round(100 * avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 1) AS filled_share
FROM orders WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY ALL""", digits=None)
def _(t):
    filled = F.count_if(F.col("o_orderstatus") == "F")
    return t("orders").dropna(subset=["o_totalprice", "o_orderpriority"]).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), filled.alias("filled"), F.round(F.avg("o_totalprice"), 2).alias("mean_price"),
        F.round(F.sum("o_totalprice"), 2).alias("turnover"), F.round(filled * 100.0 / F.count(F.lit(1)), 1).alias("filled_share")).orderBy(F.desc("turnover"))


@query("e10_distinct_and_extent", """
SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT year(o_orderdate)) AS years, CAST(min(year(o_orderdate)) AS INT) AS first_year,
  CAST(max(year(o_orderdate)) AS INT) AS last_year FROM orders""")
def _(t):
    y = F.year("o_orderdate")
    return t("orders").agg(F.countDistinct("o_custkey").alias("customers"), F.countDistinct(y).alias("years"),
                           F.min(y).alias("first_year"), F.max(y).alias("last_year"))


@query("e11_correlation_query", """
SELECT round(covar_pop(l_extendedprice, l_quantity) / (stddev_pop(l_extendedprice) * stddev_pop(l_quantity)), 3) AS with_quantity,
  round(covar_pop(l_extendedprice, l_discount) / (stddev_pop(l_extendedprice) * stddev_pop(l_discount)), 3) AS with_discount,
  round(covar_pop(l_extendedprice, l_tax) / (stddev_pop(l_extendedprice) * stddev_pop(l_tax)), 3) AS with_tax,
  round(covar_pop(l_extendedprice, l_linenumber) / (stddev_pop(l_extendedprice) * stddev_pop(l_linenumber)), 3) AS with_linenumber,
  round(covar_pop(l_extendedprice, l_suppkey) / (stddev_pop(l_extendedprice) * stddev_pop(l_suppkey)), 3) AS with_suppkey FROM lineitem""", digits=None)
def _(t):
    return t("lineitem").agg(*[F.round(F.corr("l_extendedprice", f"l_{c}"), 3).alias(f"with_{c}") for c in ("quantity", "discount", "tax", "linenumber", "suppkey")])


@query("e12_gap_top_10", """
SELECT l_suppkey, round(avg(l_extendedprice) - 1000 * avg(l_quantity), 4) AS gap, round(avg(l_extendedprice), 4) AS mean_price,
  round(avg(l_quantity), 4) AS mean_quantity
FROM lineitem WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY l_suppkey
QUALIFY row_number() OVER (ORDER BY avg(l_extendedprice) - 1000 * avg(l_quantity) DESC, l_suppkey) <= 10""", digits=4)
def _(t):
    lines = t("lineitem").dropna(subset=["l_extendedprice", "l_quantity"])
    return lines.groupBy("l_suppkey").agg(
        F.avg(F.col("l_extendedprice") - F.col("l_quantity") * 1000).alias("gap"), F.avg("l_extendedprice").alias("mean_price"),
        F.avg("l_quantity").alias("mean_quantity")).orderBy(F.desc("gap"), "l_suppkey").limit(10)


@query("e13_having_top_10", """
SELECT l_suppkey, round(mean_price, 4) AS mean_price, round(mean_quantity, 4) AS mean_quantity FROM (
  SELECT *, row_number() OVER (ORDER BY mean_quantity DESC, l_suppkey) AS place FROM (
    SELECT l_suppkey, avg(l_extendedprice) AS mean_price, avg(l_quantity) AS mean_quantity FROM lineitem
    WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL GROUP BY l_suppkey) WHERE mean_quantity > 25 AND mean_price > 38000)
WHERE place <= 10""", digits=4)
def _(t):
    means = t("lineitem").dropna(subset=["l_extendedprice", "l_quantity"]).groupBy("l_suppkey").agg(
        F.avg("l_extendedprice").alias("mean_price"), F.avg("l_quantity").alias("mean_quantity"))
    return means.filter("mean_quantity > 25 and mean_price > 38000").orderBy(F.desc("mean_quantity"), "l_suppkey").limit(10)


@query("e14_cost_by_city", """
SELECT n_name, min(c_acctbal) AS min_cost, round(avg(c_acctbal), 6) AS mean_cost, max(c_acctbal) AS max_cost
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name IS NOT NULL AND c_acctbal IS NOT NULL GROUP BY n_name ORDER BY mean_cost""")
def _(t):
    c = t("customer").withColumnRenamed("c_nationkey", "n_nationkey").filter("c_acctbal IS NOT NULL")
    both = joins.with_dimension(c, t("nation"), "n_nationkey")
    return both.groupBy("n_name").agg(F.min("c_acctbal").alias("min_cost"), F.avg("c_acctbal").alias("mean_cost"),
                                      F.max("c_acctbal").alias("max_cost")).orderBy("mean_cost")


def yearly(t):
    return t("orders").withColumn("yr", F.year("o_orderdate"))


@query("e15_trend", """
SELECT CAST(year(o_orderdate) AS INT) AS yr, o_orderpriority, round(avg(o_totalprice), 4) AS avg_price FROM orders GROUP BY ALL""", digits=4)
def _(t):
    return yearly(t).groupBy("yr", "o_orderpriority").agg(F.avg("o_totalprice").alias("avg_price"))


@query("e15_latest_slice", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS yr FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)""")
def _(t):
    return pivots.latest_slice(yearly(t), "yr").select("o_orderkey", "yr")


@query("e15_deviation_from_mean", """
SELECT o_orderpriority, round(avg(o_totalprice), 4) AS group_mean, round((SELECT avg(o_totalprice) FROM orders), 4) AS overall_mean,
  round(avg(o_totalprice) - (SELECT avg(o_totalprice) FROM orders), 4) AS deviation FROM orders GROUP BY 1""", digits=4)
def _(t):
    return pivots.deviation_from_mean(t("orders"), "o_orderpriority", "o_totalprice")


@query("e16_value_share", """
SELECT source, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY source""")
def _(t):
    return profile.value_share(t("documents"), "source")


@query("e17_top_cross_counts", """
SELECT lang, source, count(*) AS count FROM documents WHERE source IN
  (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 5) GROUP BY ALL""")
def _(t):
    return pivots.cross_counts(t("documents"), "lang", "source", 5)


@query("e18_link_counts", """
WITH links AS (SELECT lang, source, count(*) AS count FROM documents GROUP BY ALL),
nodes AS (SELECT label, row_number() OVER (ORDER BY side, label) - 1 AS node FROM
  (SELECT label, min(side) AS side FROM (SELECT lang AS label, 0 AS side FROM links UNION ALL SELECT source, 1 FROM links) GROUP BY label))
SELECT lang, source, count, a.node AS source_node, b.node AS target_node FROM links JOIN nodes a ON a.label = lang JOIN nodes b ON b.label = source""")
def _(t):
    return pivots.link_counts(t("documents"), "lang", "source")


@query("e18_path_counts", """
SELECT lang, source, n AS count, CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) AS parent_count
FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL)""")
def _(t):
    return pivots.path_counts(t("documents"), "lang", "source")


@query("e19_sum_by_recoded_place", """
SELECT p_name, total, CASE WHEN p_name LIKE '%ring%' THEN 'round' WHEN p_name LIKE '%bolt%' THEN 'long' END AS country
FROM (SELECT p_name, CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY p_name) WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%'""")
def _(t):
    sums = t("part").groupBy("p_name").agg(F.sum("p_size").alias("total"))
    return sums.withColumn("country", cells.keyword_recode(F.col("p_name"), {"ring": "round", "bolt": "long"})).dropna(subset=["country"])


@query("e20_ordered_pairs", """
SELECT l_returnflag AS "first", l_linestatus AS "second", count(*) AS count, round(count(*) * 1.0 / (SELECT count(*) FROM lineitem), 6) AS probability FROM lineitem GROUP BY ALL""")
def _(t):
    return pivots.pair_frequencies(t("lineitem"), "l_returnflag", "l_linestatus")


@query("e20_unordered_pairs", """
SELECT least(l_returnflag, l_linestatus) AS "first", greatest(l_returnflag, l_linestatus) AS "second", count(*) AS count,
  round(count(*) * 1.0 / (SELECT count(*) FROM lineitem), 6) AS probability FROM lineitem GROUP BY ALL""")
def _(t):
    return pivots.pair_frequencies(t("lineitem"), "l_returnflag", "l_linestatus", ordered=False)


@query("e21_multi_value_pivot", "SELECT o_orderpriority, CAST(year(o_orderdate) AS INT) AS yr, " + ", ".join(
    f"count(*) FILTER (o_orderstatus = '{s}') AS \"{s}_count\", round(coalesce(avg(o_totalprice) FILTER (o_orderstatus = '{s}'), 0), 4) AS \"{s}_mean\""
    for s in STATUSES) + " FROM orders GROUP BY ALL", digits=4)
def _(t):
    return pivots.pivot_table(yearly(t), ["o_orderpriority", "yr"], "o_orderstatus", STATUSES,
                              {"count": F.count(F.lit(1)), "mean": F.avg("o_totalprice")})


_DEC = "CASE WHEN year(o_orderdate) < 2000 THEN '1990s' ELSE '2000s' END"
_SIZE = "CASE WHEN o_totalprice / 100 < 500 THEN 'Small' WHEN o_totalprice / 100 <= 2000 THEN 'Medium' ELSE 'Large' END"


def decade_pivot(t):
    o = t("orders").withColumnRenamed("o_custkey", "c_custkey")
    both = joins.join_on(o, t("customer").select("c_custkey", "c_nationkey"), "c_custkey")
    both = both.withColumns({"decade": cells.decade(F.year("o_orderdate")), "size": cells.size_class(F.col("o_totalprice") / 100)})
    return pivots.pivot_table(both, ["c_nationkey", "size"], "decade", ["1990s", "2000s", "2010s"], {"n": F.count(F.lit(1))})


_PIVOT = f"""SELECT c_nationkey, {_SIZE} AS size, count(*) FILTER ({_DEC} = '1990s') AS "1990s_n", count(*) FILTER ({_DEC} = '2000s') AS "2000s_n",
  CAST(0 AS BIGINT) AS "2010s_n" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


@query("e22_pivot_by_decade", _PIVOT)
def _(t):
    return decade_pivot(t)


@query("e23_growth", f"""
SELECT c_nationkey, size, round(coalesce(("2000s_n" - "1990s_n") * 100.0 / nullif("1990s_n", 0), 0), 6) AS "growth_1990s_n_to_2000s_n_pct",
  round(coalesce(("2010s_n" - "2000s_n") * 100.0 / nullif("2000s_n", 0), 0), 6) AS "growth_2000s_n_to_2010s_n_pct" FROM ({_PIVOT})""")
def _(t):
    return pivots.growth_between(decade_pivot(t), ["c_nationkey", "size"], ["1990s_n", "2000s_n", "2010s_n"])


# Bases of the score queries: parts with a status text and gaps in the area.
_BASES = """(SELECT p_brand, p_type, p_name, CASE WHEN p_partkey % 6 <> 0 THEN p_retailprice END AS area, p_size * 10.0 AS perimeter,
  p_size * 1.5 AS len, CASE p_partkey % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'Active' WHEN 2 THEN 'INACTIVE' ELSE 'closed' END AS status FROM part)"""


def bases(t):
    k = F.col("p_partkey")
    return t("part").select(
        "p_brand", "p_type", "p_name", F.when(k % 6 != 0, F.col("p_retailprice")).alias("area"),
        (F.col("p_size") * 10.0).alias("perimeter"), (F.col("p_size") * 1.5).alias("len"),
        F.when(k % 4 == 0, "ACTIVE").when(k % 4 == 1, "Active").when(k % 4 == 2, "INACTIVE").otherwise("closed").alias("status"))


_PLAIN = f"""SELECT p_brand, p_type, count(p_name) AS members, round_even(avg(area), 4) AS mean_value, round_even(stddev_samp(len), 4) AS std_dev_length,
  round_even(0.4 * coalesce(avg(area) / 1000, 0) + 0.3 * avg(perimeter) / 100 + 0.3 * avg(CASE status WHEN 'ACTIVE' THEN 1.0 WHEN 'INACTIVE' THEN 0.5
    WHEN 'UNKNOWN' THEN 0.25 ELSE 0.1 END) * 100, 4) AS score FROM {_BASES} GROUP BY ALL"""
_GROUPS = dict(name="p_name", area="area", perimeter="perimeter", length="len", status="status")


@query("e24_group_score", _PLAIN)
def _(t):
    return pivots.group_score(bases(t), ["p_brand", "p_type"], **_GROUPS)


@query("e25_group_score_sql", f"""
SELECT p_brand, p_type, count(p_name) AS members, round(avg(area), 4) AS mean_value, round(coalesce(stddev_samp(len), 0), 4) AS std_dev_length,
  round(0.4 * avg(coalesce(area, 0)) / 1000 + 0.3 * avg(coalesce(perimeter, 0)) / 100 + 0.3 * avg(CAST(CASE upper(status) WHEN 'ACTIVE' THEN 1.0 WHEN 'INACTIVE' THEN 0.5
    WHEN 'UNKNOWN' THEN 0.25 ELSE 0.1 END AS DOUBLE)) * 100, 4) AS score FROM {_BASES} GROUP BY ALL""", digits=4)
def _(t):
    return pivots.group_score_sql(bases(t), ["p_brand", "p_type"], **_GROUPS)


@query("e26_roll_up", f"""
SELECT p_type, CAST(sum(members) AS BIGINT) AS total_members, round_even(avg(mean_value), 4) AS avg_area, round_even(avg(std_dev_length), 4) AS avg_spread,
  round_even(avg(score), 4) AS avg_score FROM ({_PLAIN}) GROUP BY p_type""")
def _(t):
    return pivots.roll_up(pivots.group_score(bases(t), ["p_brand", "p_type"], **_GROUPS), "p_type")


# ---- histograms and distributions -------------------------------------------

@query("e27_bin_rules", """
WITH s AS (SELECT count(value) AS n, max(value) - min(value) AS r, quantile_cont(value, .75) - quantile_cont(value, .25) AS iqr FROM events)
SELECT 'Freedman-Diaconis' AS rule, round(2 * iqr / pow(n, 1.0 / 3), 6) AS bin_width, greatest(1, CAST(floor(r / (2 * iqr / pow(n, 1.0 / 3))) AS INT)) AS bin_count,
  iqr > 0.1 * r AS chosen, false AS fallback FROM s
UNION ALL SELECT 'Square Root', round(r / sqrt(n), 6), CAST(floor(sqrt(n)) AS INT), iqr <= 0.1 * r AND n < 100, false FROM s
UNION ALL SELECT 'Sturges', round(r / (ceil(log2(n)) + 1), 6), CAST(ceil(log2(n)) + 1 AS INT), iqr <= 0.1 * r AND n >= 100, false FROM s""")
def _(t):
    return profile.bin_rules(t("events"), "value")


_HIST = """
WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / {k} AS w, {k} AS k FROM events),
c AS (SELECT CAST(least(floor((value - lo) / w), k - 1) AS INT) AS bin, count(*) AS count FROM events, s GROUP BY 1)
SELECT CAST(b AS INT) AS bin, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high, coalesce(count, 0) AS count
FROM (SELECT unnest(range(CAST((SELECT k FROM s) AS BIGINT))) AS b), s LEFT JOIN c ON c.bin = b"""


@query("e28_histogram", _HIST.format(k=40))
def _(t):
    return profile.histogram(t("events"), "value", bin_count=40)


@query("e28_histogram_by_rule", _HIST.format(k="(SELECT ceil(log2(count(value))) + 1 FROM events)"))
def _(t):
    return profile.histogram(t("events"), "value", rule="Sturges")


_BOX = """
WITH q AS (SELECT {keys} quantile_cont({v}, .25) AS q1, quantile_cont({v}, .5) AS med, quantile_cont({v}, .75) AS q3 FROM {src} {grp}),
r AS (SELECT {qk} q1, med, q3, {v} AS v, {v} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM {src} {join})
SELECT {keys} '{v}' AS variable, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, min(v) FILTER (inside) AS whisker_low,
  max(v) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers, count(*) AS count FROM r GROUP BY {keys} q1, med, q3"""


@query("e29_box_summary", _BOX.format(keys="", qk="", v="l_extendedprice", src="lineitem", grp="", join=", q"))
def _(t):
    return profile.box_summary(t("lineitem"), "l_extendedprice")


@query("e29_box_by_group", _BOX.format(keys="event_type,", qk="event_type,", v="value", src="events", grp="GROUP BY event_type", join="JOIN q USING (event_type)"))
def _(t):
    return profile.box_summary(t("events"), "value", ["event_type"])


@query("e30_ecdf", """
SELECT value, n, round(CAST(sum(n) OVER (ORDER BY value) AS DOUBLE) / (SELECT count(value) FROM events), 6) AS ecdf
FROM (SELECT value, count(*) AS n FROM events GROUP BY value)""")
def _(t):
    return profile.ecdf(t("events"), "value")


@query("e31_qq_normal", f"""
SELECT value AS ordered, round({NS.quantile('p')}, 6) AS theoretical FROM (SELECT value, CASE i WHEN 1 THEN 1 - pow(0.5, 1.0 / n) WHEN n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p
FROM (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events))""")
def _(t):
    return profile.qq_points(t("events"), "value", "norm")


@query("e31_qq_exponential", """
SELECT value AS ordered, round(-ln(1 - CASE i WHEN 1 THEN 1 - pow(0.5, 1.0 / n) WHEN n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END), 6) AS theoretical
FROM (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events)""")
def _(t):
    return profile.qq_points(t("events"), "value", "expon")


def _edges(t):
    q = quantile_table(t("lineitem"), ["l_extendedprice"], [0, .25, .5, .75, 1])
    return [q["l_extendedprice", p] for p in (0, .25, .5, .75, 1)]


_BINS = "(SELECT *, (l_extendedprice > e1)::INT + (l_extendedprice > e2)::INT + (l_extendedprice > e3)::INT AS bin FROM lineitem, (SELECT " + ", ".join(
    f"quantile_cont(l_extendedprice, {i / 4}) AS e{i}" for i in range(5)) + " FROM lineitem))"


@query("e32_quantile_bins", f"""
SELECT l_orderkey, l_linenumber, bin, round(CASE bin WHEN 0 THEN e0 WHEN 1 THEN e1 WHEN 2 THEN e2 ELSE e3 END, 6) AS bin_low,
  round(CASE bin WHEN 0 THEN e1 WHEN 1 THEN e2 WHEN 2 THEN e3 ELSE e4 END, 6) AS bin_high FROM {_BINS}""")
def _(t):
    return profile.quantile_bins(t("lineitem"), "l_extendedprice", 4).select("l_orderkey", "l_linenumber", "bin", "bin_low", "bin_high")


@query("e32_conditional_groups", f"""
SELECT bin, round(CASE bin WHEN 0 THEN e0 WHEN 1 THEN e1 WHEN 2 THEN e2 ELSE e3 END, 6) AS bin_low,
  round(CASE bin WHEN 0 THEN e1 WHEN 1 THEN e2 WHEN 2 THEN e3 ELSE e4 END, 6) AS bin_high, count(*) AS count,
  round(avg(l_quantity), 6) AS mean_x, round(avg(l_discount), 6) AS mean_y, round(corr(l_quantity, l_discount), 6) AS "corr" FROM {_BINS} GROUP BY ALL""")
def _(t):
    return profile.conditional_statistics(t("lineitem"), "l_quantity", "l_discount", "l_extendedprice")


@query("e33_skewed_columns", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, round(skewness({c}), 6) AS skewness FROM events" for c in ("value", "user_id", "event_id")) + ") WHERE abs(skewness) > 0.5")
def _(t):
    return profile.skewed_columns(t("events"), ["value", "user_id", "event_id"])


@query("e34_scaled_profile", """
SELECT event_type, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 6) AS value, round((u - min(u) OVER ()) / (max(u) OVER () - min(u) OVER ()), 6) AS user_id,
  CAST(0.5 AS DOUBLE) AS flat FROM (SELECT event_type, avg(value) AS v, avg(user_id) AS u FROM events GROUP BY 1)""")
def _(t):
    return profile.scaled_group_profile(t("events").withColumn("flat", F.lit(3)), "event_type", ["value", "user_id", "flat"])


@query("e35_bar_table", " UNION ALL ".join(
    f"SELECT l_returnflag, '{c}' AS measure, round(sum({c}), 2) AS value FROM lineitem GROUP BY 1" for c in ("l_quantity", "l_discount", "l_tax")), digits=2)
def _(t):
    return profile.long_measures(t("lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"])
