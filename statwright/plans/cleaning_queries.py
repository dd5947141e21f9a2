"""Validation, profiling of missing cells, filters and cell functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cells
from ..operators import filters, quality, units
from .registry import query

# A table with injected gaps: every seventh balance and every fifth segment.
GAPS_SQL = """(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal END AS balance,
  CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment,
  CASE WHEN c_custkey % 10 >= 6 THEN c_nationkey END AS nation FROM customer)"""


def with_gaps(t):
    c = t("customer")
    k = F.col("c_custkey")
    return c.select(
        "c_custkey",
        F.when(k % 7 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal")).alias("balance"),
        F.when(k % 5 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(k % 10 >= 6, F.col("c_nationkey")).alias("nation"))


RULES = {"balance": lambda c: c >= 5000, "segment": cells.is_not_empty}


@query("b01_validate_skip", f"""
SELECT c_custkey, round(balance, 6) AS balance, segment, nation FROM {GAPS_SQL}
WHERE balance IS NULL OR balance >= 5000""")
def _(t):
    return quality.validate(with_gaps(t).withColumn("balance", filters.number("balance")), RULES).rows


@query("b01_validate_report", """
SELECT 'o_totalprice' AS "column", count(*) FILTER (o_totalprice < 1000) AS failures FROM orders
UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority NOT LIKE '%-%') FROM orders
UNION ALL SELECT '(any)', count(*) FILTER (o_totalprice < 1000 OR o_orderpriority NOT LIKE '%-%') FROM orders""")
def _(t):
    return quality.validate(t("orders"), {"o_totalprice": lambda c: c >= 1000,
                                          "o_orderpriority": lambda c: c.contains("-")}, "log").report


@query("b02_validators", r"""
SELECT doc_id, regexp_full_match(split_part(CAST(n_chars * 37 AS VARCHAR), '.', 1), '[0-9]{5}') AS zip_ok,
  length(regexp_replace('(' || source || ') 555-' || CAST(n_chars AS VARCHAR), '[^0-9]', '', 'g')) = 10 AS phone_ok,
  length(trim(text)) > 0 AS filled, try_cast('2024-01-' || CAST(doc_id % 40 AS VARCHAR) AS TIMESTAMP) IS NOT NULL AS date_ok,
  doc_id % 3 IN (0, 1) AS bool_ok, n_chars - 400 >= 0 AS positive_ok
FROM documents""")
def _(t):
    d = t("documents")
    return d.select(
        "doc_id", cells.is_zipcode((F.col("n_chars") * 37).cast("string")).alias("zip_ok"),
        cells.is_phone(F.concat(F.lit("("), "source", F.lit(") 555-"), F.col("n_chars").cast("string"))).alias("phone_ok"),
        cells.is_not_empty(F.col("text")).alias("filled"),
        cells.is_date(F.concat(F.lit("2024-01-"), F.lpad((F.col("doc_id") % 40).cast("string"), 2, "0"))).alias("date_ok"),
        cells.is_zero_one((F.col("doc_id") % 3).cast("string")).alias("bool_ok"),
        cells.is_non_negative((F.col("n_chars") - 400).cast("string")).alias("positive_ok"))


@query("b03_boolean_text", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS flag FROM orders""")
def _(t):
    text = F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "FALSE").otherwise("maybe")
    return t("orders").select("o_orderkey", cells.true_false(text).alias("flag"))


@query("b04_constraints", """
SELECT 'orders' AS "table", 'CHECK o_totalprice >= 1000' AS "constraint", count(*) FILTER (o_totalprice < 1000) AS violations FROM orders
UNION ALL SELECT 'orders', 'NOT NULL o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders
UNION ALL SELECT 'lineitem', 'CHECK l_quantity <= 45', count(*) FILTER (l_quantity > 45) FROM lineitem
UNION ALL SELECT 'orders', 'UNIQUE o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'UNIQUE l_orderkey, l_linenumber', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'lineitem', 'FOREIGN KEY l_orderkey -> orders', count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'orders', 'FOREIGN KEY o_custkey -> customer', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'labels', 'FOREIGN KEY doc_id -> documents', count(*) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)""")
def _(t):
    names = ["orders", "lineitem", "customer", "labels", "documents"]
    R = quality.Reference
    return quality.constraint_report(
        {n: t(n) for n in names},
        {("orders", "o_totalprice >= 1000"): F.col("o_totalprice") >= 1000,
         ("lineitem", "l_quantity <= 45"): F.col("l_quantity") <= 45},
        [("orders", "o_custkey")],
        [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"])],
        [R("lineitem", "l_orderkey", "orders", "o_orderkey"), R("orders", "o_custkey", "customer", "c_custkey"),
         R("labels", "doc_id", "documents", "doc_id")])


@query("b05_relationships", """
SELECT 'region -> nation' AS relationship, 'One-to-Many' AS kind, CAST(NULL AS VARCHAR) AS junction, 'n_regionkey' AS "key",
  (SELECT max(n) FROM (SELECT count(*) AS n FROM nation GROUP BY n_regionkey)) AS max_per_parent
UNION ALL SELECT 'orders <-> part', 'Many-to-Many', 'order_part', 'l_orderkey', (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey))
UNION ALL SELECT 'orders <-> part', 'Many-to-Many', 'order_part', 'l_partkey', (SELECT max(n) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey))""")
def _(t):
    R = quality.Reference
    link = t("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return quality.relationship_report(
        {"nation": t("nation"), "order_part": link},
        [R("nation", "n_regionkey", "region", "r_regionkey"), R("order_part", "l_orderkey", "orders", "o_orderkey"),
         R("order_part", "l_partkey", "part", "p_partkey")], {"nation": ["n_nationkey"]})


_MISS = "CAST(balance IS NULL AS INT) + CAST(segment IS NULL AS INT) + CAST(nation IS NULL AS INT)"


@query("b07_missing_summary", f"""
SELECT CAST(sum(m) AS BIGINT) AS total_missing, round_even(sum(m) * 100.0 / (count(*) * 4), 2) AS missing_pct,
  count(*) FILTER (m > 0) AS rows_with_missing, CAST(0 AS BIGINT) AS empty_rows, 1 AS complete_columns
FROM (SELECT {_MISS} AS m FROM {GAPS_SQL})""")
def _(t):
    return quality.missing_profile(with_gaps(t)).summary


@query("b07_missing_columns", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{k}' AS type, count(*) FILTER ({c} IS NULL) AS missing,
  round_even(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 2) AS missing_pct FROM {GAPS_SQL}"""
    for c, k in [("c_custkey", "bigint"), ("balance", "double"), ("segment", "string"), ("nation", "int")]))
def _(t):
    return quality.missing_profile(with_gaps(t)).columns


@query("b08_high_missing", f"""
SELECT 'nation' AS "column", 'int' AS type, count(*) FILTER (nation IS NULL) AS missing,
  round_even(count(*) FILTER (nation IS NULL) * 100.0 / count(*), 2) AS missing_pct FROM {GAPS_SQL}""")
def _(t):
    return quality.high_missing_columns(with_gaps(t))


@query("b09_missing_per_row", f"SELECT c_custkey, {_MISS} AS missing_cells FROM {GAPS_SQL}")
def _(t):
    return quality.missing_per_row(with_gaps(t)).select("c_custkey", "missing_cells")


@query("b10_constant_columns", """
SELECT 'one' AS "column" FROM orders GROUP BY ALL HAVING min(7) = max(7)""")
def _(t):
    return quality.constant_columns(t("orders").withColumn("one", F.lit(7)))


@query("b11_duplicate_columns", """
SELECT 'l_quantity' AS "first", 'quantity_again' AS "second" FROM lineitem
HAVING bool_and(l_quantity IS NOT DISTINCT FROM l_quantity)""")
def _(t):
    return quality.duplicate_columns(t("lineitem").withColumn("quantity_again", F.col("l_quantity")))


@query("b12_duplicate_rows", """
SELECT CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag)""")
def _(t):
    return quality.duplicate_rows(t("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")).summary


@query("b12_distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def _(t):
    return quality.duplicate_rows(t("documents").select("text", "lang")).rows


@query("b13_column_kinds", """
SELECT 'p_size' AS "column", bool_and(try_cast(CAST(p_size AS VARCHAR) AS DOUBLE) IS NOT NULL) AS numeric FROM part
UNION ALL SELECT 'p_brand', bool_and(try_cast(p_brand AS DOUBLE) IS NOT NULL) FROM part
UNION ALL SELECT 'p_retailprice', true""")
def _(t):
    return quality.column_kinds(t("part").select(F.col("p_size").cast("string").alias("p_size"), "p_brand", "p_retailprice"))


# ---- filters ----------------------------------------------------------------

@query("c01_band_stop_keeps_bounds", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 10 OR l_quantity >= 40""")
def _(t):
    return filters.threshold_filter(t("lineitem"), "l_quantity", "band_stop", (10, 40)).select(
        "l_orderkey", "l_linenumber", "l_quantity")


@query("c01_band_pass", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 10 AND l_quantity < 40")
def _(t):
    return filters.threshold_filter(t("lineitem"), "l_quantity", "band_pass", (10, 40), inclusive=False).select(
        "l_orderkey", "l_quantity")


@query("c02_keep_missing_summary", f"""
SELECT o AS original_count, f AS filtered_count, o - f AS removed_count, round(f * 100.0 / o, 6) AS filtered_percentage,
  round((o - f) * 100.0 / o, 6) AS removed_percentage, m AS nan_count,
  round((f - m) * 100.0 / (o - m), 6) AS non_nan_filtered_percentage
FROM (SELECT count(*) AS o, count(*) FILTER (balance IS NULL OR balance < 2000 OR balance > 8000) AS f,
  count(*) FILTER (balance IS NULL) AS m FROM {GAPS_SQL})""")
def _(t):
    return filters.threshold_filter_keep_missing(with_gaps(t), "balance", "band_stop", (2000, 8000)).summary


@query("c02_keep_missing_rows", f"""
SELECT c_custkey FROM {GAPS_SQL} WHERE balance IS NULL OR balance < 2000 OR balance > 8000""")
def _(t):
    return filters.threshold_filter_keep_missing(with_gaps(t), "balance", "band_stop", (2000, 8000)).rows.select("c_custkey")


@query("c03_default_filters", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{k}' AS filter_type, round(q, 6) AS low, round(q, 6) AS high, f AS filtered_count,
  n AS original_count, n - f AS removed_count, round(f * 100.0 / n, 6) AS kept_percentage
FROM (SELECT any_value(q) AS q, count(*) AS n, count(*) FILTER ({c} {op} q) AS f
      FROM lineitem, (SELECT quantile_cont({c}, {p}) AS q FROM lineitem))"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") for k, op, p in (("low_pass", "<=", 0.9), ("high_pass", ">=", 0.1))))
def _(t):
    li = t("lineitem")
    return filters.filter_statistics(li, filters.default_filters(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("c04_threshold_sweep", " UNION ALL ".join(f"""
SELECT CAST({p} AS DOUBLE) AS prob, '{k}' AS filter_type, round(any_value(q), 6) AS threshold,
  count(*) FILTER (l_extendedprice {op} q) AS filtered_count,
  round(count(*) FILTER (l_extendedprice {op} q) * 100.0 / count(*), 6) AS kept_percentage
FROM lineitem, (SELECT quantile_cont(l_extendedprice, {p}) AS q FROM lineitem)"""
    for p in (0.1, 0.25, 0.5, 0.75, 0.9) for k, op in (("low_pass", "<="), ("high_pass", ">="))))
def _(t):
    return filters.threshold_sweep(t("lineitem"), "l_extendedprice")


# ---- cells ------------------------------------------------------------------

@query("c05_clean_text", """
SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE substring(trim(text), 1, 40) END AS cut,
  CASE WHEN length(trim(text)) > 30 THEN substring(trim(text), 1, 27) || '...' ELSE trim(text) END AS dotted
FROM documents""")
def _(t):
    d = t("documents")
    marked = F.when(F.col("doc_id") % 9 == 0, F.lit(" None ")).otherwise(F.col("text"))
    return d.select("doc_id", cells.clean_text(marked, 40).alias("cut"),
                    cells.clean_text(F.col("text"), 30, dots=True).alias("dotted"))


@query("c06_clean_number", """
SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS plain,
  round(o_totalprice, 2) AS comma FROM orders""", digits=2)
def _(t):
    o = t("orders")
    text = F.format_number("o_totalprice", 2)
    plain = F.when(F.col("o_orderkey") % 11 == 0, F.lit("n.a.")).otherwise(text)
    comma = F.translate(text, ".,", ",.")
    return o.select("o_orderkey", cells.clean_number(plain).alias("plain"),
                    cells.clean_number(comma, decimal_comma=True).alias("comma"))


@query("c07_clip_upper", """
SELECT event_id, round(least(value * v, q * 10), 6) AS value FROM (
  SELECT event_id, value, CASE WHEN event_id % 500 = 0 THEN 1000 ELSE 1 END AS v FROM events),
  (SELECT quantile_cont(value * CASE WHEN event_id % 500 = 0 THEN 1000 ELSE 1 END, 0.99) AS q FROM events)""")
def _(t):
    e = t("events").select("event_id", (F.col("value") * F.when(F.col("event_id") % 500 == 0, 1000).otherwise(1)).alias("value"))
    return filters.clip_upper(e, ["value"])


@query("c08_fill_missing", f"""
SELECT c_custkey, coalesce(balance, 0) AS balance, coalesce(segment, 'Unknown') AS segment, coalesce(nation, 0) AS nation
FROM {GAPS_SQL}""")
def _(t):
    return filters.fill_missing(with_gaps(t))


@query("c08_drop_missing", f"SELECT c_custkey FROM {GAPS_SQL} WHERE balance IS NOT NULL AND nation IS NOT NULL")
def _(t):
    return with_gaps(t).dropna(subset=["balance", "nation"]).select("c_custkey")


@query("c09_typed", """
SELECT CAST(p_size AS INT) AS p_size, p_retailprice, p_partkey, p_name
FROM (SELECT p_size, round(p_retailprice, 6) AS p_retailprice, CAST(p_partkey AS VARCHAR) AS p_partkey, p_name FROM part)""")
def _(t):
    text = t("part").select(F.col("p_size").cast("string").alias("p_size"),
                            F.col("p_retailprice").cast("string").alias("p_retailprice"), "p_partkey", "p_name")
    return filters.typed(text, ["p_size"], ["p_retailprice"], ["p_partkey", "p_name"])


NATION_REGION = {"NATION_1": "West", "NATION_2": "West", "Nation_3": "South", "nation_4": "South", "NATION_5": "North"}


@query("c10_lookup_recode", """
SELECT n_nationkey, CASE WHEN n_nationkey % 6 = 0 THEN 'Unknown' WHEN n_name IN ('NATION_1', 'NATION_2') THEN 'West'
  WHEN n_name IN ('NATION_3', 'NATION_4') THEN 'South' WHEN n_name = 'NATION_5' THEN 'North' ELSE 'Other' END AS area FROM nation""")
def _(t):
    n = t("nation").withColumn("n_name", F.when(F.col("n_nationkey") % 6 == 0, "").otherwise(F.col("n_name")))
    return cells.lookup_recode(n, "n_name", NATION_REGION, "area").select("n_nationkey", "area")


@query("c11_keyword_recode", """
SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'round' WHEN p_name LIKE '%bolt%' THEN 'long'
  WHEN p_name LIKE '%gear%' THEN 'toothed' END AS shape,
  CASE WHEN p_name LIKE '%small%' THEN 'small' ELSE 'unknown' END AS zone FROM part""")
def _(t):
    name = F.upper("p_name")
    return t("part").select("p_partkey", cells.keyword_recode(name, {"ring": "round", "Bolt": "long", "gear": "toothed"}).alias("shape"),
                            cells.keyword_recode(name, {"small": "small"}, "unknown").alias("zone"))


@query("c12_range_categories", """
SELECT o_orderkey, CASE WHEN m < 500 THEN 'Small' WHEN m <= 2000 THEN 'Medium' ELSE 'Large' END AS size,
  CASE WHEN y < 2000 THEN '1990s' ELSE '2000s' END AS decade,
  CASE WHEN m < 1000 THEN 'Low Income' WHEN m < 4000 THEN 'Lower-Middle Income' WHEN m < 12000 THEN 'Upper-Middle Income' ELSE 'High Income' END AS income
FROM (SELECT o_orderkey, o_totalprice / 100 AS m, year(o_orderdate) AS y FROM orders)""")
def _(t):
    m = F.col("o_totalprice") / 100
    return t("orders").select("o_orderkey", cells.size_class(m).alias("size"),
                              cells.decade(F.year("o_orderdate")).alias("decade"), cells.income_class(m).alias("income"))


_AREA = "CASE WHEN p_retailprice > 950 THEN 'Very Large' WHEN p_retailprice > 930 THEN 'Large' WHEN p_retailprice > 910 THEN 'Medium' ELSE 'Small' END"


@query("c13_rules_and_flags", """
SELECT p_partkey, category, round(p_retailprice / p_size, 3) AS efficiency, p_type = 'ECONOMY' AS is_economy,
  CASE WHEN p_type = 'ECONOMY' THEN 1 WHEN category = 'Very Large' THEN 2 WHEN p_type IN ('SMALL', 'PROMO', 'LARGE') THEN 3 ELSE 4 END AS priority
FROM (SELECT *, CASE WHEN a > 250 THEN 'Very Large' WHEN a > 150 THEN 'Large' WHEN a > 100 THEN 'Medium' ELSE 'Small' END AS category
      FROM (SELECT *, p_retailprice - 850 AS a FROM part) WHERE p_name LIKE '%ring%' AND a > 100)""")
def _(t):
    p = t("part").withColumn("a", F.col("p_retailprice") - 850)
    out = (p.filter(F.col("p_name").contains("ring") & (F.col("a") > 100))
            .withColumn("category", cells.area_class(F.col("a")))
            .withColumn("efficiency", F.round(F.col("p_retailprice") / F.col("p_size"), 3))
            .withColumn("is_economy", F.col("p_type") == "ECONOMY")
            .withColumn("priority", F.when(F.col("p_type") == "ECONOMY", 1).when(F.col("category") == "Very Large", 2)
                        .when(F.col("p_type").isin("SMALL", "PROMO", "LARGE"), 3).otherwise(4)))
    return out.select("p_partkey", "category", "efficiency", "is_economy", "priority")


@query("c14_case_top_20", """
WITH banded AS (SELECT p_partkey, p_retailprice, CASE WHEN p_size < 10 THEN 'hand' WHEN p_size < 30 THEN 'shelf' ELSE 'floor' END AS place FROM part)
SELECT p_partkey, p_retailprice, place FROM (SELECT *, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS i FROM banded WHERE place <> 'hand') WHERE i <= 20""")
def _(t):
    size = F.col("p_size")
    banded = t("part").select("p_partkey", "p_retailprice", F.when(size < 10, "hand").when(size < 30, "shelf").otherwise("floor").alias("place"))
    return banded.filter("place <> 'hand'").orderBy(F.desc("p_retailprice"), "p_partkey").limit(20)


@query("c15_ratio_over_time", """
SELECT day, round(n_signup * 1.0 / n_view, 6) AS effectiveness FROM (
  SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'signup') AS n_signup, count(*) FILTER (event_type = 'view') AS n_view
  FROM events GROUP BY 1) WHERE n_view > 0""")
def _(t):
    day = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")  # arrives as text
    e = t("events").withColumn("day", F.try_to_timestamp(day).cast("date")).filter(F.col("day").isNotNull())
    per = e.groupBy("day").agg(F.count_if(F.col("event_type") == "signup").alias("s"),
                               F.count_if(F.col("event_type") == "view").alias("v")).filter("v > 0")
    return per.select("day", F.try_divide(F.col("s").cast("double"), F.col("v")).alias("effectiveness")).orderBy("day")


@query("c16_difference", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice - l_quantity * 1000, 6) AS gap FROM lineitem""")
def _(t):
    return t("lineitem").select("l_orderkey", "l_linenumber",
                                (F.col("l_extendedprice") - F.col("l_quantity") * 1000).alias("gap"))


@query("c17_tolerance_search", "SELECT p_name, p_partkey FROM part WHERE p_retailprice BETWEEN 950 * 0.98 AND 950 * 1.02")
def _(t):
    return filters.within_tolerance(t("part"), "p_retailprice", 950, 2, "percentage").select("p_name", "p_partkey")


@query("c17_tolerance_negative", """
SELECT c_custkey FROM (SELECT c_custkey, -c_acctbal AS b FROM customer) WHERE b BETWEEN -5000 * 0.9 AND -5000 * 1.1""")
def _(t):
    c = t("customer").select("c_custkey", (-F.col("c_acctbal")).alias("b"))
    return filters.within_tolerance(c, "b", -5000, 10, "percentage").select("c_custkey")


@query("c18_point_lookup", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey = 7 AND l_returnflag = 'A'")
def _(t):
    return filters.lookup(t("lineitem"), l_suppkey=7, l_returnflag="A", l_linestatus=None).select("l_orderkey", "l_linenumber", "l_partkey")


@query("c19_parameter_select", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1999-06-30 00:00:00' AND o_orderstatus = 'O'")
def _(t):
    o = t("orders")
    return o.sparkSession.sql(
        "SELECT o_orderkey, o_orderdate FROM {orders} WHERE o_orderdate > to_timestamp_ntz(:after) AND o_orderstatus = :status",
        args={"after": "1999-06-30 00:00:00", "status": "O"}, orders=o)


@query("c19_distinct_pairs", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem WHERE l_suppkey = 3")
def _(t):
    return t("lineitem").filter("l_suppkey = 3").select("l_returnflag", "l_linestatus").distinct()


@query("c20_junk_exclusion", "SELECT doc_id, source FROM documents WHERE source <> 'src3' AND doc_id % 4 <> 1")
def _(t):
    owner = (F.when(F.col("source") == "src3", "Unknown").when(F.col("doc_id") % 4 == 1, F.concat("source", F.lit(";x")))
              .otherwise(F.col("source")))
    d = t("documents").withColumn("owner", owner)
    return d.filter(~F.upper("owner").isin(cells.JUNK_NAMES) & ~F.col("owner").contains(";")).select("doc_id", "source")


@query("c21_text_assembly", """
SELECT s_suppkey, concat_ws(' / ', s_name, nullif('nation ' || s_nationkey, 'nation 0'), CASE WHEN s_acctbal >= 0 THEN 'credit' END) AS label,
  s_name || ' (' || CASE WHEN s_suppkey % 3 = 0 THEN 'no balance' ELSE CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR) END || ')' AS shown,
  CASE WHEN s_acctbal >= 0 THEN s_name || ': credit' END AS whole FROM supplier""")
def _(t):
    nation = F.when(F.col("s_nationkey") != 0, F.concat(F.lit("nation "), F.col("s_nationkey").cast("string")))
    credit = F.when(F.col("s_acctbal") >= 0, F.lit("credit"))
    balance = F.when(F.col("s_suppkey") % 3 != 0, F.floor("s_acctbal").cast("string"))
    return t("supplier").select(
        "s_suppkey", F.concat_ws(" / ", "s_name", nation, credit).alias("label"),
        F.concat("s_name", F.lit(" ("), F.coalesce(balance, F.lit("no balance")), F.lit(")")).alias("shown"),
        F.concat("s_name", F.lit(": "), credit).alias("whole"))


@query("c22_currency", """
SELECT o_orderkey, '$' || format('{:,.2f}', o_totalprice) AS price, round_even(o_totalprice / 7, 3) AS even, round(o_totalprice / 7, 3) AS up FROM orders""")
def _(t):
    return t("orders").select("o_orderkey", cells.currency(F.col("o_totalprice")).alias("price"),
                              F.bround(F.col("o_totalprice") / 7, 3).alias("even"), F.round(F.col("o_totalprice") / 7, 3).alias("up"))


@query("c23_unit_conversion", """
SELECT l_orderkey, l_linenumber, round(l_quantity * CASE l_returnflag WHEN 'A' THEN 0.30478512648 WHEN 'N' THEN 1000.0 END / 0.02539876054, 4) AS inches
FROM lineitem""", digits=4)
def _(t):
    li = t("lineitem").withColumn("unit", F.when(F.col("l_returnflag") == "A", "foot").when(F.col("l_returnflag") == "N", "kilometers").otherwise("furlong"))
    u = units.length_units(li.sparkSession)
    return units.convert(li, "l_quantity", "unit", "inch", u, "inches").select("l_orderkey", "l_linenumber", "inches")


@query("c24_measurements", """
SELECT p_partkey, round(p_retailprice * 0.30478512648 + p_size * 1000.0, 6) AS total, 'm' AS unit FROM part""")
def _(t):
    p = t("part").select("p_partkey", F.concat(F.col("p_retailprice").cast("string"), F.lit(" ft")).alias("a"),
                         F.concat(F.col("p_size").cast("string"), F.lit(" km")).alias("b"))
    return units.add_measurements(p, "a", "b", units.length_units(p.sparkSession)).select("p_partkey", "total", "unit")


@query("c25_reynolds", """
SELECT l_orderkey, l_linenumber, round(re, 4) AS re, CASE WHEN re < 2300 THEN 'laminar' WHEN re < 4000 THEN 'transitional' WHEN re IS NOT NULL THEN 'turbulent' END AS flow
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0 AND l_tax > 0 THEN l_quantity * l_discount * 8 / l_tax END AS re FROM lineitem)""", digits=4)
def _(t):
    re = cells.reynolds(F.col("l_quantity"), F.col("l_discount"), F.lit(8.0), F.col("l_tax"))
    good = F.when(F.col("l_discount") > 0, re)
    return t("lineitem").select("l_orderkey", "l_linenumber", good.alias("re"), cells.flow_class(good).alias("flow"))


@query("c26_distance", """
SELECT event_id, round(sqrt(pow((radians(lon) - radians(plon)) * cos((radians(lat) + radians(plat)) / 2), 2) + pow(radians(lat) - radians(plat), 2)) * 6371000, 3) AS metres
FROM (SELECT event_id, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
  FROM (SELECT event_id, user_id, ts, event_id % 90 AS lat, event_id % 180 AS lon FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts))
WHERE plat IS NOT NULL""", digits=3)
def _(t):
    from ..functions.ordered import framed
    e = t("events").select("event_id", "user_id", "ts", (F.col("event_id") % 90).alias("lat"), (F.col("event_id") % 180).alias("lon"))
    fr = framed(e, ["user_id"], ["ts", "event_id"], 1, 0)
    d = fr.df.withColumns({"plat": F.lag("lat").over(fr.window), "plon": F.lag("lon").over(fr.window)})
    metres = cells.equirectangular(F.col("plat"), F.col("plon"), F.col("lat"), F.col("lon"))
    return fr.own(d).filter("plat IS NOT NULL").select("event_id", metres.alias("metres"))


@query("c27_family", """
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'NACA' WHEN p_size % 4 = 1 THEN 'Wortmann FX' WHEN p_size % 4 = 2 THEN 'Selig'
  WHEN p_type LIKE '%LAM%' THEN 'Laminar' ELSE 'Other' END AS family FROM part""")
def _(t):
    s = F.col("p_size") % 4
    num = F.col("p_size").cast("string")
    name = (F.when(s == 0, F.concat(F.lit("naca"), num)).when(s == 1, F.concat(F.lit("fx "), num, F.lit("-"), num))
             .when(s == 2, F.concat(F.lit("S"), num)).otherwise(F.concat(F.lit("x s"), num)))
    return t("part").select("p_partkey", cells.profile_family(name, F.col("p_type")).alias("family"))


@query("c28_line_count", r"""
SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 0 ELSE len(string_split(regexp_replace(text, '^\s+|\s+$', '', 'g'), chr(10))) END AS lines FROM documents""")
def _(t):
    return t("documents").select("doc_id", cells.line_count(F.col("text")).cast("long").alias("lines"))


@query("c29_transform_skew", """
SELECT 'original' AS transformation, round(skewness(l_extendedprice), 6) AS skewness FROM lineitem
UNION ALL SELECT 'log', round(skewness(ln(l_extendedprice)), 6) FROM lineitem
UNION ALL SELECT 'sqrt', round(skewness(sqrt(l_extendedprice)), 6) FROM lineitem
UNION ALL SELECT 'reciprocal', round(skewness(1 / l_extendedprice), 6) FROM lineitem""")
def _(t):
    v = F.col("value")
    values = t("lineitem").select(filters.number("l_extendedprice").alias("value"))
    plain = {"original": (v, None), "log": (F.ln(v), None), "sqrt": (F.sqrt(v), None), "reciprocal": (1 / v, None)}
    return filters.skew_of(values, plain).select("transformation", "skewness")


@query("c29_transform_report")
def _(t):
    return filters.transformation_report(t("lineitem"), "l_extendedprice")


_PRIORITIES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("c30_one_hot", "SELECT o_orderkey, " + ", ".join(
    f"CAST(o_orderpriority = '{p}' AS INT) AS \"o_orderpriority_{p}\"" for p in _PRIORITIES) + " FROM orders")
def _(t):
    return filters.one_hot(t("orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])


@query("c30_one_hot_long", """
SELECT o_orderkey, 'o_orderpriority' AS "column", o_orderpriority AS level FROM orders WHERE o_orderpriority <> (SELECT min(o_orderpriority) FROM orders)
UNION ALL SELECT o_orderkey, 'o_custkey', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_custkey <> (SELECT min(o_custkey) FROM orders)""")
def _(t):
    return filters.one_hot_long(t("orders"), "o_orderkey", ["o_orderpriority", "o_custkey"])
