"""Cleaning, validation, profiles, pivots and units on small frames."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from statwright.functions import cells
from statwright.operators import filters, joins, pivots, profile, quality, units
from statwright.sources import readers, writers

NAN = float("nan")
# Commuting minutes of 48 cities.
COMMUTE = [
    23.3, 28.3, 24.6, 32.1, 31.7, 25.8, 38.1, 24.9, 26.8, 23.4, 28.5, 28.1, 29.3, 24.4, 23, 24.8,
    26.2, 23.4, 28.4, 20.1, 32.2, 21.4, 23.8, 30.7, 24.8, 23.6, 25.3, 31.7, 43.8, 22, 27.1, 34.2,
    28.3, 25, 26.4, 23.6, 23.4, 25.8, 20.2, 26.1, 24.8, 32.6, 28.5, 27.3, 26.8, 24, 20.1, 32.8]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, 1.0, "A"), (2, None, "B"), (3, 3.0, None), (4, NAN, ""), (5, 100.0, "A")]
    return spark.createDataFrame(rows, "id int, x double, t string")


def test_null_passes_a_rule_before_it_is_asked(small):
    out = quality.validate(small, {"t": cells.is_not_empty})
    assert sorted(r.id for r in out.rows.collect()) == [1, 2, 3, 5]
    strict = quality.validate(small, {"t": cells.is_not_empty}, nulls="fail")
    assert sorted(r.id for r in strict.rows.collect()) == [1, 2, 5]
    with pytest.raises(ValueError):
        quality.validate(small, {"x": lambda c: c < 50}, on_error="fail")
    assert quality.validate(small, {"x": lambda c: c < 50}, on_error="log").rows.count() == 5


def test_required_columns(small):
    with pytest.raises(ValueError, match="zip"):
        quality.require_columns(small, ["id", "zip"])


def test_nan_counts_as_missing(small):
    rows = {r.column: r.missing for r in quality.missing_profile(small).columns.collect()}
    assert rows == {"id": 0, "x": 2, "t": 1}


def test_two_band_stop_rules(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 4.0, None)], "v double")
    keep = filters.threshold_filter(df, "v", "band_stop", (2, 3))
    assert [r.v for r in keep.collect()] == [1.0, 2.0, 3.0, 4.0]
    other = filters.threshold_filter_keep_missing(df, "v", "band_stop", (2, 3))
    assert [r.v for r in other.rows.collect()] == [1.0, 4.0, None]
    with pytest.raises(ValueError):
        filters.threshold_filter(df, "v", "band_pass", (3, 2))


def test_partial_dates(spark):
    df = spark.createDataFrame([("2002",), ("2021-3",), ("2021-3-7",), ("2019-12-25",), ("2021-13",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(cells.partial_date(F.col("s"))).collect()]
    assert got == [dt.date(2002, 1, 1), dt.date(2021, 3, 1), dt.date(2021, 3, 7), dt.date(2019, 12, 25), None, None, None]


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("1,234.5",), ("x",), ("Infinity",), (" 7 ",)], "s string")
    assert [r[0] for r in df.select(cells.clean_number(F.col("s"))).collect()] == [1234.5, None, None, 7.0]
    df = spark.createDataFrame([("1.234,5",)], "s string")
    assert df.select(cells.clean_number(F.col("s"), decimal_comma=True)).first()[0] == 1234.5


def test_families_and_regions(spark):
    names = ["naca0012", "fx 63-137", "xS1223", "s1223", "goe 10", "risk2", "mylam", "other"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(cells.profile_family(F.col("n"))).collect()]
    assert got == ["NACA", "Wortmann FX", "Other", "Selig", "Goettingen", "RISK", "Laminar", "Other"]
    states = spark.createDataFrame([("CA",), ("north dakota",), ("Guam",), ("Bavaria",), (None,)], "s string")
    out = cells.lookup_recode(states, "s", cells.state_regions(), "r")
    assert [r.r for r in out.collect()] == ["West", "Midwest", "Territory", "Other", "Unknown"]


def test_measurements(spark):
    u = units.length_units(spark)
    df = spark.createDataFrame([("1.5 km", "730.3 ft"), ("1 km", "3 furlong"), ("5", "1 m")], "a string, b string")
    add = [r.total for r in units.add_measurements(df, "a", "b", u).orderBy("a").collect()]
    sub = [r.total for r in units.add_measurements(df, "a", "b", u, -1).orderBy("a").collect()]
    assert add[1] == pytest.approx(1722.584577868344) and sub[1] == pytest.approx(1277.415422131656)
    assert add[0] is None and add[2] is None
    inches = units.convert(spark.createDataFrame([(42.0, "ft")], "v double, u string"), "v", "u", "in", u).first()
    assert inches.converted == pytest.approx(504.0, abs=1e-6)


def test_commuting_minutes(spark):
    df = spark.createDataFrame([(float(v),) for v in COMMUTE], "v double")
    s = profile.column_statistics(df, "v").first()
    assert (s["count"], s["mean"]) == (48, pytest.approx(26.90625))
    assert s.var_pop == pytest.approx(20.85600260416667)
    assert sorted(r.v for r in profile.modes(df, "v").collect()) == [23.4, 24.8]


def test_corrected_shape_and_mad(spark):
    x = np.random.default_rng(0).gamma(2, 3, 200)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    for sizes in ({}, {"exact_rows": 0}):
        r = profile.descriptive_table(df, ["x"], **sizes).first()
        assert r.skewness == pytest.approx(pd.Series(x).skew()) and r.kurtosis == pytest.approx(pd.Series(x).kurt())
        assert r.mad == pytest.approx(np.median(np.abs(x - np.median(x))) * 1.4826)
        assert r.p90 == pytest.approx(np.percentile(x, 90))


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.1, 9.9, 10.0)], "v double")
    assert [r["count"] for r in profile.histogram(df, "v", bin_count=5).orderBy("bin").collect()] == [2, 0, 0, 0, 2]


def test_flat_quartiles_fall_back(spark):
    df = spark.createDataFrame([(1.0,)] * 20 + [(5.0,)], "v double")
    assert profile.bin_rules(df, "v").filter("rule = 'Freedman-Diaconis'").first().fallback


def test_two_scores_differ_in_case_and_missing_values(spark):
    rows = [("s", "c", "n1", 100.0, 10.0, 1.0, "Active"), ("s", "c", "n2", None, 10.0, 2.0, "ACTIVE"), ("t", "c", "n3", 5.0, 1.0, 3.0, "x")]
    df = spark.createDataFrame(rows, "s string, c string, n string, a double, p double, l double, o string")
    args = (["s", "c"], "n", "a", "p", "l", "o")
    plain = {r.s: r for r in pivots.group_score(df, *args).collect()}
    query = {r.s: r for r in pivots.group_score_sql(df, *args).collect()}
    assert plain["s"].score == pytest.approx(0.4 * 0.1 + 0.3 * 0.1 + 30 * 0.55)
    assert query["s"].score == pytest.approx(0.4 * 0.05 + 0.3 * 0.1 + 30)
    assert plain["t"].std_dev_length is None and query["t"].std_dev_length == 0


def test_not_in_with_missing_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (None,)], "b int")
    assert [r.a for r in joins.rows_not_in(left, right, "a", "b").collect()] == [2]
    assert joins.rows_not_in(left, right.filter("b IS NULL"), "a", "b").count() == 3


def test_keyed_append(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 9), (3, "d", 9)], "k int, v string, extra int")
    pick = lambda df: sorted((r.k, r.v) for r in df.collect())
    assert pick(writers.keyed_append(old, new, ["k"], "replace")) == [(1, "a"), (2, "c"), (3, "d")]
    assert pick(writers.keyed_append(old, new, ["k"], "ignore")) == [(1, "a"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError):
        writers.keyed_append(old, new, ["k"])
    assert pick(writers.keyed_append(old, new, ["k"], clear_first=True)) == [(2, "c"), (3, "d")]
    loads = spark.createDataFrame([(2, "z", 1), (2, "c", 2), (4, None, 2), (4, "e", 1)], "k int, v string, load int")
    assert pick(writers.keyed_append(old, loads, ["k"], "replace", order="load"))[1:] == [(2, "c"), (4, None)]
    assert pick(writers.keyed_append(old, loads, ["k"], "ignore", order="load"))[1:] == [(2, "b"), (4, "e")]


def test_table_replaced_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    writers.save_over(spark.read.parquet(path).filter("id > 2"), path)
    assert spark.read.parquet(path).count() == 2


def test_header_names_with_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`A b` int, `a-B` int, ` c ` int")
    assert readers.rename_headers(df).columns == ["a_b", "a_b_2", "c"]


def test_lines_are_numbered_across_splits(spark, tmp_path):
    path = tmp_path / "f.txt"
    path.write_text("\n".join(f"h{i}" for i in range(12)) + "\n" + "\n".join(f"{i} {i * 2}" for i in range(3000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = readers.numbered_lines(spark, str(path)).orderBy("line").collect()
        rows = readers.read_skipping_header(spark, str(path), ["a", "b"])
        assert [r.line for r in lines] == list(range(1, 3013)) and lines[12].value == "0 0"
        assert rows.count() == 3000 and rows.agg(F.sum("b")).first()[0] == 2 * sum(range(3000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_curve_and_parameter_files(spark, tmp_path):
    (tmp_path / "naca0012.dat").write_text("A profile\n1 0\n0.5 0.1\nbad line x\n2 0\n0 0\n")
    out = readers.read_curve_files(spark, str(tmp_path))
    assert out.curves.first().asDict() == {"name": "naca0012", "description": "A profile", "family": "NACA"}
    assert [(r.x, r.y) for r in out.points.orderBy("seq").collect()] == [(1.0, 0.0), (0.5, 0.1), (0.0, 0.0)]
    folder = tmp_path / "p"
    folder.mkdir()
    body = "x\n alpha CL CD CDp CM\n ---\n 1 2 3 4 5\n 1 2\n 6 7 8 9 10\n"
    (folder / "re200_a.pol").write_text(body)
    (folder / "re100_a.pol").write_text(body)
    (folder / "none.pol").write_text(body)
    rows = readers.read_parameter_tables(spark, str(folder), ["alpha", "cl", "cd", "cdp", "cm"]).collect()
    assert [(r.parameter, r.alpha) for r in rows] == [(100, 1.0), (100, 6.0), (200, 1.0), (200, 6.0)]


def test_dirty_csv(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_bytes("id;name\n1;Café\nx;y;z\n2;b\n".encode("latin-1"))
    out = readers.read_dirty_csv(spark, str(path), spark.createDataFrame([], "id int, name string").schema)
    assert out.encoding == "ISO-8859-1"
    assert sorted((r.id, r.name) for r in out.rows.collect()) == [(1, "Café"), (2, "b")]
    assert out.malformed.count() == 1 and out.rows.count() == 2


def test_power_transform_parameter(spark):
    x = np.random.default_rng(2).lognormal(1, 0.5, 800)
    rows = {r.transformation: r for r in filters.transformation_report(spark.createDataFrame(pd.DataFrame({"x": x})), "x").collect()}
    grid = np.linspace(-1, 1, 20001)
    logs = np.log(x)
    like = [(g - 1) * logs.sum() - len(x) / 2 * np.log(np.var(logs if abs(g) < 1e-9 else (x ** g - 1) / g)) for g in grid[::50]]
    assert rows["boxcox"]["lambda"] == pytest.approx(grid[::50][int(np.argmax(like))], abs=0.02)
    assert sum(r.best for r in rows.values()) == 1


def test_equal_thresholds_keep_their_probabilities(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(5.0,)] * 2, "v double")
    got = sorted((r.prob, r.filter_type) for r in filters.threshold_sweep(df, "v").collect())
    assert [p for p, _ in got] == [0.1, 0.1, 0.25, 0.25, 0.5, 0.5, 0.75, 0.75, 0.9, 0.9]
