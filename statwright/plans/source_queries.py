"""Readers and writers over copies of the tables in the shared folder."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import cells
from ..functions.storage import scratch_path
from ..sources import readers, writers
from .registry import query


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@query("a01_csv_missing_markers", """
SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_name END AS c_name, CASE WHEN c_custkey % 4 <> 0 THEN round(c_acctbal, 6) END AS account_balance FROM customer""")
def _(t):
    c = t("customer")
    k = F.col("c_custkey")
    raw = c.select("c_custkey", F.when(k % 6 == 0, "N/A").otherwise(F.col("c_name")).alias("c_name"),
                   F.when(k % 4 == 0, "NaN").otherwise(F.col("c_acctbal").cast("string")).alias("account balance"))
    path = writers.export(raw, scratch_path(c.sparkSession, "customer_csv"))
    return readers.read_csv(c.sparkSession, path, schema("c_custkey bigint, c_name string, `account balance` double"))


def under_header(batches):
    """Every part starts with the header line."""
    yield pd.DataFrame({"value": ["s_suppkey;s_name;s_acctbal"]})
    yield from batches


def dirty(t):
    s = t("supplier")
    name = F.concat("s_name", F.lit(" Café"))
    line = F.when(F.col("s_suppkey") % 10 == 3, F.concat(name, F.lit(";broken"))).otherwise(
        F.concat_ws(";", F.col("s_suppkey").cast("string"), name, F.col("s_acctbal").cast("string")))
    path = scratch_path(s.sparkSession, "supplier_latin1")
    s.select(line.alias("value")).mapInPandas(under_header, "value string").write.option("encoding", "ISO-8859-1").text(path)
    return readers.read_dirty_csv(s.sparkSession, path, schema("s_suppkey bigint, s_name string, s_acctbal double"))


@query("a02_dirty_csv", "SELECT s_suppkey, s_name || ' Café' AS s_name, s_acctbal FROM supplier WHERE s_suppkey % 10 <> 3")
def _(t):
    return dirty(t).rows


def as_array(batches):
    """Every part becomes one JSON array, a record per line."""
    lead = "["
    for pdf in batches:
        lines = pdf["value"].tolist()
        yield pd.DataFrame({"value": [lead + lines[0], *("," + v for v in lines[1:])]} if lines else {"value": []}, dtype=object)
        lead = "," if lines else lead
    yield pd.DataFrame({"value": ["]" if lead == "," else "[]"]})


@query("a03_json_array", "SELECT s_suppkey, s_name AS \"s name\", s_acctbal FROM supplier")
def _(t):
    s = t("supplier")
    path = scratch_path(s.sparkSession, "supplier_json")
    rows = s.select("s_suppkey", F.col("s_name").alias("s name"), "s_acctbal")
    rows.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(as_array, "value string").write.text(path)
    return readers.read_json_array(s.sparkSession, path, schema("s_suppkey bigint, `s name` string, s_acctbal double"))


@query("a03_json_array_in_splits", "SELECT event_id, event_type, value FROM events")
def _(t):
    e = t("events").select("event_id", "event_type", "value")
    path = scratch_path(e.sparkSession, "events_json")
    e.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(as_array, "value string").write.text(path)
    return readers.read_json_array(e.sparkSession, path, e.schema, record_per_line=True)


@query("a04_xml", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(t):
    n = t("nation")
    path = scratch_path(n.sparkSession, "nation_xml")
    n.write.format("xml").option("rootTag", "root").option("rowTag", "row").save(path)
    return readers.read_xml(n.sparkSession, path, schema("n_nationkey int, n_name string, n_regionkey int"), "row")


@query("a05_keyed_json", "SELECT CAST(p_partkey AS VARCHAR) AS name, p_size AS size, p_brand AS brand FROM part")
def _(t):
    p = t("part")
    path = scratch_path(p.sparkSession, "part_keyed")
    one = F.to_json(F.map_from_arrays(F.array(F.col("p_partkey").cast("string")), F.array(F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")))))
    p.select(one.alias("value")).write.option("lineSep", "\u0001").text(path)
    return readers.read_keyed_json(p.sparkSession, path, "struct<size:int,brand:string>", separator="\u0001")


def headed(groups=None):
    """Writes header lines at the top of every part (or at every new group)."""
    def lines(batches):
        last = object()
        for pdf in batches:
            if groups is None:
                if last is not None:
                    last = None
                    yield pd.DataFrame({"value": [f"header {i}" for i in range(12)]})
                yield pdf[["value"]]
                continue
            start = 0
            keys = pdf[groups].to_numpy()
            for i in range(len(keys) + 1):
                if i == len(keys) or keys[i] != last:
                    if i > start:
                        yield pdf.iloc[start:i][["value", groups]]
                    if i < len(keys):
                        last, start = keys[i], i
                        yield pd.DataFrame({"value": ["run of 2024", " alpha  CL  CD", " -----  ----"], groups: [keys[i]] * 3})
    return lines


def line_text():
    return F.concat_ws("  ", *[F.col(c).cast("string") for c in ("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")])


_NUM = ["order_key", "quantity", "price", "discount", "tax"]


@query("a06_skip_header_lines", """
SELECT CAST(l_orderkey AS DOUBLE) AS order_key, l_quantity AS quantity, l_extendedprice AS price, l_discount AS discount, l_tax AS tax FROM lineitem""")
def _(t):
    li = t("lineitem")
    path = scratch_path(li.sparkSession, "lines_with_header")
    li.select(line_text().alias("value")).mapInPandas(headed(), "value string").write.text(path)
    return readers.read_skipping_header(li.sparkSession, path, _NUM).drop("file", "line")


@query("a07_arity_checked", """
SELECT CAST(o_orderkey AS INT) AS "first", CAST(o_custkey AS INT) AS "second", CAST(o_orderdate AS DATE) AS "date" FROM orders WHERE o_orderkey % 9 <> 0""")
def _(t):
    o = t("orders")
    path = scratch_path(o.sparkSession, "triples")
    line = F.concat_ws(", ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "yyyy-M-d"),
                       F.when(F.col("o_orderkey") % 9 == 0, "extra"))
    o.select(line.alias("value")).write.text(path)
    return readers.read_dated_triples(o.sparkSession, path)


PARTY = {"key": ["c_custkey", "s_suppkey"], "name": ["c_name", "s_name"], "balance": ["c_acctbal", "s_acctbal"], "segment": ["c_mktsegment"]}


@query("a08_aliased_append", """
SELECT c_custkey AS "key", c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def _(t):
    return readers.append_sources([t("customer"), t("supplier")], PARTY)


@query("a09_multi_format_load", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT r_regionkey, r_name FROM region")
def _(t):
    spark = t("nation").sparkSession
    xml, json = scratch_path(spark, "nation_xml"), scratch_path(spark, "region_json")
    kind = schema("n_nationkey int, n_name string")
    t("nation").select("n_nationkey", "n_name").write.format("xml").option("rootTag", "root").option("rowTag", "row").save(xml)
    region = t("region").toDF("n_nationkey", "n_name").select(F.to_json(F.struct("*")).alias("value"))
    region.mapInPandas(as_array, "value string").write.text(json)
    return readers.append_sources([readers.read_xml(spark, xml, kind, "row"), readers.read_json_array(spark, json, kind)])


@query("a10_header_names", "SELECT p_partkey AS part_key, p_name AS name_of_part, p_size AS name_of_part_2 FROM part")
def _(t):
    raw = t("part").select(F.col("p_partkey").alias(" Part-Key "), F.col("p_name").alias("Name, of (part)"), F.col("p_size").alias("name OF part"))
    return readers.rename_headers(raw)


@query("a11_partial_dates", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN make_date(year(o_orderdate), 1, 1) WHEN 1 THEN make_date(year(o_orderdate), month(o_orderdate), 1)
  WHEN 2 THEN CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _(t):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = F.when(k == 0, F.date_format(d, "yyyy")).when(k == 1, F.date_format(d, "yyyy-M")).when(k == 2, F.date_format(d, "yyyy-M-d")).otherwise("soon")
    return t("orders").select("o_orderkey", cells.partial_date(text).alias("day"))


@query("a12_latitude_longitude", """
SELECT c_custkey, CAST(c_nationkey - 10 AS DOUBLE) AS lat, round(c_acctbal / 100, 6) AS lon FROM customer WHERE c_custkey % 5 <> 0""")
def _(t):
    text = F.when(F.col("c_custkey") % 5 == 0, F.concat(F.lit("x, "), F.col("c_nationkey").cast("string"))).otherwise(
        F.concat((F.col("c_nationkey") - 10).cast("string"), F.lit(" , "), (F.col("c_acctbal") / 100).cast("string")))
    return t("customer").select("c_custkey", cells.latitude_longitude(text).alias("p")).select("c_custkey", "p.*").dropna()


@query("a13_point_list", """
SELECT event_id, CAST(0 AS INT) AS seq, CAST(user_id AS DOUBLE) AS x, value AS y FROM events UNION ALL SELECT event_id, 2, value, CAST(user_id AS DOUBLE) FROM events""")
def _(t):
    u, v = F.col("user_id").cast("string"), F.col("value").cast("string")
    text = F.concat(u, F.lit(" "), v, F.lit("\nnot a point\n"), v, F.lit("   "), u)
    return readers.point_list(t("events").select("event_id", text.alias("cloud")), "event_id", "cloud")


@query("a14_round_trip", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem")
def _(t):
    li = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")
    path = writers.export(li, scratch_path(li.sparkSession, "lineitem_csv"))
    return li.sparkSession.read.option("header", True).schema(li.schema).csv(path)


def halves(t):
    c = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return c.filter("c_custkey % 3 <> 0"), c.filter("c_custkey % 2 = 0").withColumns({"c_acctbal": -F.col("c_acctbal"), "note": F.lit("x")})


@query("a15_insert_or_replace", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""")
def _(t):
    return writers.keyed_append(*halves(t), ["c_custkey"], "replace")


@query("a15_insert_or_ignore", """
SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""")
def _(t):
    return writers.keyed_append(*halves(t), ["c_custkey"], "ignore")


@query("a15_insert", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(t):
    c = t("customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return writers.keyed_append(c.filter("c_custkey % 3 <> 0"), c.filter("c_custkey % 3 = 0"), ["c_custkey"])


def party(t):
    return {"part": (t("part").select("p_partkey", "p_name"), "p_partkey"),
            "lineitem": (t("lineitem").select("l_orderkey", "l_partkey"), "l_partkey")}


@query("a16_rename_cascade", """
SELECT 'part' AS "table", CASE WHEN p_partkey % 2 = 0 THEN p_partkey + 1000000 ELSE p_partkey END AS "key" FROM part
UNION ALL SELECT 'lineitem', CASE WHEN l_partkey % 2 = 0 THEN l_partkey + 1000000 ELSE l_partkey END FROM lineitem""")
def _(t):
    changes = t("part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 1000000).alias("new"))
    out = writers.rename_keys(party(t), changes)
    pick = lambda n, k: out[n].select(F.lit(n).alias("table"), F.col(k).alias("key"))
    return pick("part", "p_partkey").unionByName(pick("lineitem", "l_partkey"))


@query("a16_delete_cascade", """
SELECT 'part' AS "table", p_partkey AS "key" FROM part WHERE p_size <= 25 UNION ALL
SELECT 'lineitem', l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)""")
def _(t):
    out = writers.delete_keys(party(t), t("part").filter("p_size > 25"), "p_partkey")
    pick = lambda n, k: out[n].select(F.lit(n).alias("table"), F.col(k).alias("key"))
    return pick("part", "p_partkey").unionByName(pick("lineitem", "l_partkey"))


_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@query("a17_catalogue_report", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", CAST({i + 1} AS INT) AS position, '{c.split()[0]}' AS \"column\", '{c.split()[1]}' AS type, (SELECT count(*) FROM {n}) AS rows"
    for n, cols in _TABLES.items() for i, c in enumerate(cols.split(", "))))
def _(t):
    return writers.catalogue_report(t("nation").sparkSession, {n: t(n) for n in _TABLES})


@query("a18_parameter_tables", """
SELECT l_suppkey % 4 AS parameter, CAST(l_orderkey AS DOUBLE) AS alpha, l_quantity AS cl, l_extendedprice AS cd, l_discount AS cdp, l_tax AS cm FROM lineitem WHERE l_suppkey % 4 > 0""")
def _(t):
    li = t("lineitem").withColumn("re", F.col("l_suppkey") % 4)
    path = scratch_path(li.sparkSession, "polars")
    rows = li.select("re", line_text().alias("value")).sortWithinPartitions("re")
    rows = rows.mapInPandas(headed("re"), "value string, re long")
    rows.write.partitionBy("re").text(path)
    return readers.read_parameter_tables(li.sparkSession, path, ["alpha", "cl", "cd", "cdp", "cm"], parameter=r"re=(\d+)").drop("line")


@query("a19_curve_files", "SELECT l_discount AS x, l_quantity / 40 AS y FROM lineitem WHERE l_quantity <= 40")
def _(t):
    li = t("lineitem")
    path = scratch_path(li.sparkSession, "curves")
    text = F.concat_ws(" ", F.col("l_discount").cast("string"), (F.col("l_quantity") / 40).cast("string"))
    li.select(text.alias("value")).mapInPandas(headed(), "value string").write.text(path)
    return readers.read_curve_files(li.sparkSession, path).points.select("x", "y")
