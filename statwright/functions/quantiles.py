"""Exact, linearly interpolated quantiles in bounded memory.

Spark's ``percentile`` keeps every distinct value of a group in a map that is
merged in one task.  It is used only while the largest group has at most
``SMALL_GROUP`` rows.  Beyond that the wanted ranks are narrowed:

1. One aggregate takes a bounded sketch of every column and group.  The values
   it names a little below and above each wanted rank are a *slice*, which
   holds the rank however the sketch erred.
2. One aggregate counts, by plain comparisons, the rows below each slice and up to it.
   Should a slice miss its rank, it is widened and counted again.
3. The rows inside the slices, a few in ten thousand, are counted by value and
   ordered, split into blocks where a slice is still large; the wanted ranks are read off.

Groups smaller than the sketch is accurate are one slice.  The sketch decides
how much is ordered, never the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import BLOCK_ROWS, join_same, largest_group, running_sum
from .storage import written

SMALL_GROUP = 10_000
SKETCH_ACCURACY = 1_000


def number(column: str):
    """A column as double with NaN made NULL."""
    c = F.col(column).cast("double")
    return F.when(~F.isnan(c), c)


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """keys, variable, value: one row per non-missing number."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), number(c).alias("value")) for c in columns]))
    return (df.select(*keys, pairs.alias("p")).select(*keys, "p.variable", "p.value")
              .filter(F.col("value").isNotNull()))


CELL = "variable string, prob double, value double"


def quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
              keys: Sequence[str] = (), exact_rows: int = SMALL_GROUP,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """keys, variable, prob, value.  Groups of up to ``exact_rows`` rows may be merged in one task."""
    if not keys:
        found = whole_quantiles(df, columns, probs, exact_rows, block_rows)
        return df.sparkSession.createDataFrame([(c, float(p), found[c, p]) for c in columns for p in probs], CELL)
    if largest_group(df, keys)[0] <= exact_rows:
        wide = df.groupBy(*keys).agg(*_percentiles(columns, probs))
        cells = F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.lit(float(p)).alias("prob"),
                     F.col(f"_q{i}")[j].alias("value"))
            for i, c in enumerate(columns) for j, p in enumerate(probs)]))
        return wide.select(*keys, cells.alias("q")).select(*keys, "q.*")
    return _narrowed(df, columns, [float(p) for p in probs], list(keys), block_rows)


def _percentiles(columns: Sequence[str], probs: Sequence[float]) -> list[Column]:
    return [F.percentile(number(c), F.array(*[F.lit(float(p)) for p in probs])).alias(f"_q{i}") for i, c in enumerate(columns)]


def whole_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], exact_rows: int = SMALL_GROUP,
                    block_rows: int = BLOCK_ROWS) -> dict[tuple[str, float], float | None]:
    """Quantiles of whole columns as numbers, by (column, probability)."""
    if df.count() <= exact_rows:
        row = df.agg(*_percentiles(columns, probs)).first()
        return {(c, p): row[i][j] if row[i] is not None else None for i, c in enumerate(columns) for j, p in enumerate(probs)}
    rows = df.select(*[number(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    wanted = [float(p) for p in probs]
    accuracy = SKETCH_ACCURACY
    while True:
        cut = _slices(rows, len(columns), wanted, [], accuracy).first()
        ends = {(i, j): (cut[f"_lo{i}"][j], cut[f"_hi{i}"][j]) for i in range(len(columns)) for j in range(len(wanted)) if cut[f"_n{i}"]}
        sums = rows.selectExpr("count(1) AS rows", *[x for (i, j), (low, high) in ends.items() for x in (
            f"count_if(_v{i} < {_text(low)}) AS b{i}_{j}", f"count_if(_v{i} <= {_text(high)}) AS u{i}_{j}")]).first()
        spot = {(i, j): wanted[j] * (cut[f"_n{i}"] - 1) for i, j in ends}
        below, upto = ({k: sums[f"{x}{k[0]}_{k[1]}"] for k in ends} for x in "bu")
        if all(below[k] <= math.floor(spot[k]) and math.ceil(spot[k]) < upto[k] for k in ends):
            break
        accuracy = max(1, accuracy // 4)  # wider slices; below 2 * accuracy rows a column is one slice
    found = {k: [(below[k], upto[k], low)] for k, (low, high) in ends.items() if low == high}
    wide = [k for k in ends if k not in found]
    if wide:
        inside = {(i, j): f"_v{i} BETWEEN {_text(ends[i, j][0])} AND {_text(ends[i, j][1])}" for i, j in wide}
        cells = ", ".join(f"CASE WHEN {held} THEN struct({i} AS _column, {j} AS _place, _v{i} AS value) END" for (i, j), held in inside.items())
        values = (rows.filter(" OR ".join(inside.values())).selectExpr(f"explode(array({cells})) AS x").filter("x IS NOT NULL").select("x.*")
                  .groupBy("_column", "_place", "value").agg(F.count(F.lit(1)).alias("_rows")))
        fits = max(upto[k] - below[k] for k in wide) <= block_rows
        ordered = running_sum(values, ["_column", "_place"], ["value"], {"_to": "_rows"}, None if fits else block_rows)
        hit = " OR ".join(f"(_column = {i} AND _place = {j} AND {at(spot[i, j]) - below[i, j]} BETWEEN _to - _rows AND _to - 1)"
                          for i, j in wide for at in (math.floor, math.ceil))
        for r in ordered.filter(hit).collect():  # two rows for each number asked for
            k = r["_column"], r["_place"]
            found.setdefault(k, []).append((below[k] + r["_to"] - r["_rows"], below[k] + r["_to"], r.value))

    def value(k: tuple[int, int]) -> float | None:
        if k not in found:
            return None
        low, high = (next(v for a, b, v in found[k] if a <= at(spot[k]) < b) for at in (math.floor, math.ceil))
        return low + (high - low) * (spot[k] - math.floor(spot[k])) if low != high else low
    return {(c, p): value((i, j)) for i, c in enumerate(columns) for j, p in enumerate(probs)}


def _text(x: float) -> str:
    """A double in SQL."""
    return f"double('{x!r}')"


def _slices(rows: DataFrame, count: int, probs: list[float], keys: list[str], accuracy: int) -> DataFrame:
    """keys, and per column its size ``_n`` and arrays ``_lo``, ``_hi`` with a slice per probability.  ``accuracy`` says how
    many rows in that many a sketch may be wrong by one; a margin of three errors on both sides leaves no doubt."""
    margin = 3.0 / accuracy
    asked = [min(1.0, max(0.0, p + s)) for s in (-margin, margin) for p in probs]
    sketch = rows.groupBy(*keys).agg(*[F.expr(x) for i in range(count) for x in (
        f"count(_v{i}) AS _n{i}", f"percentile_approx(_v{i}, array({', '.join(f'{p!r}D' for p in asked)}), {accuracy}) AS _q{i}")])
    return sketch.selectExpr(*[f"`{k}`" for k in keys], *[x for i in range(count) for x in (f"_n{i}", *(
        f"CASE WHEN _n{i} <= {2 * accuracy} THEN array_repeat({_text(all_of)}, {len(probs)}) ELSE slice(_q{i}, {at}, {len(probs)}) END AS {name}{i}"
        for name, at, all_of in (("_lo", 1, -math.inf), ("_hi", len(probs) + 1, math.inf))))])


def _counted(both: DataFrame, count: int, probs: list[float], keys: list[str]) -> DataFrame:
    """keys, and per column and probability the rows below its slice and up to its end, and the value of a slice that is one."""
    return both.groupBy(*keys).agg(*[F.expr(f"count(_v{i}) AS _n{i}") for i in range(count)], *[F.expr(x) for i in range(count) for j in range(len(probs)) for x in (
        f"max(CASE WHEN _lo{i}[{j}] = _hi{i}[{j}] THEN _lo{i}[{j}] END) AS _s{i}_{j}",
        f"count_if(_v{i} < _lo{i}[{j}]) AS _b{i}_{j}", f"count_if(_v{i} <= _hi{i}[{j}]) AS _u{i}_{j}")])


def _narrowed(df: DataFrame, columns: Sequence[str], probs: list[float], keys: list[str], block_rows: int) -> DataFrame:
    count, places = len(columns), range(len(probs))
    rows = df.select(*keys, *[number(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    accuracy = SKETCH_ACCURACY
    while True:
        slices = written(_slices(rows, count, probs, keys, accuracy))
        both = join_same(rows, slices, keys)
        found = ", ".join(f"struct({i} AS _column, {j} AS _place, _n{i} AS _n, _b{i}_{j} AS _below, _u{i}_{j} AS _upto, _s{i}_{j} AS _single)" for i in range(count) for j in places)
        spot = F.expr(f"array({', '.join(_text(p) for p in probs)})[_place] * (_n - 1)")
        ranks = written(_counted(both, count, probs, keys).select(*keys, F.expr(f"explode(array({found}))").alias("x")).select(*keys, "x.*").withColumn("_spot", spot))
        check = ranks.filter("_n > 0").agg(F.bool_or((F.col("_below") > F.floor("_spot")) | (F.col("_upto") <= F.ceil("_spot"))).alias("missed"),
                                           F.max(F.col("_upto") - F.col("_below")).alias("most")).first()
        if not check.missed:
            break
        accuracy = max(1, accuracy // 4)  # wider slices; below 2 * accuracy rows a group is one slice
    inside = {(i, j): f"(_lo{i}[{j}] < _hi{i}[{j}] AND _v{i} BETWEEN _lo{i}[{j}] AND _hi{i}[{j}])" for i in range(count) for j in places}
    cells = ", ".join(f"CASE WHEN {held} THEN struct({i} AS _column, {j} AS _place, _v{i} AS value) END" for (i, j), held in inside.items())
    group = [*keys, "_column", "_place"]
    values = (both.filter(" OR ".join(inside.values())).select(*keys, F.expr(f"explode(array({cells}))").alias("x")).filter("x IS NOT NULL").select(*keys, "x.*")
              .groupBy(*group, "value").agg(F.count(F.lit(1)).alias("_rows")))
    ordered = running_sum(values, group, ["value"], {"_to": "_rows"}, None if (check.most or 0) <= block_rows else block_rows)
    placed = join_same(ordered, ranks, group)
    first, last = F.col("_below") + F.col("_to") - F.col("_rows"), F.col("_below") + F.col("_to")
    low, high = (F.max(F.when((first <= at(F.col("_spot"))) & (at(F.col("_spot")) < last), F.col("value"))) for at in (F.floor, F.ceil))
    share = F.max(F.col("_spot") - F.floor("_spot"))
    read = placed.groupBy(*group).agg(F.when(low == high, low).otherwise(low + (high - low) * share).alias("value"))
    named = [F.element_at(F.array(*[F.lit(x) for x in all_of]), F.col(c) + 1) for all_of, c in ((list(columns), "_column"), (probs, "_place"))]
    return join_same(ranks, read, group, "left").select(*keys, named[0].alias("variable"), named[1].alias("prob"), F.coalesce("_single", "value").alias("value"))


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                   **sizes) -> dict[tuple[str, float], float | None]:
    """Quantiles of whole columns as numbers: columns x probs of them."""
    return whole_quantiles(df, columns, probs, **sizes)


def quantile_columns(df: DataFrame, columns: Sequence[str], named: dict[str, float],
                     keys: Sequence[str] = (), **sizes) -> DataFrame:
    """keys, variable and one column per named probability."""
    long = quantiles(df, columns, list(named.values()), keys, **sizes)
    return long.groupBy(*keys, "variable").agg(*[
        F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(name)
        for name, p in named.items()])
