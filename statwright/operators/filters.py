"""Threshold filters, clipping, filling, typed building and transforms."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import corrected_skew
from ..functions.quantiles import number, quantile_table

KINDS = ("low_pass", "high_pass", "band_pass", "band_stop")


def _bounds(kind: str, thresholds) -> tuple[float, float]:
    if kind not in KINDS:
        raise ValueError(f"filter kind must be one of {KINDS}")
    if kind in ("low_pass", "high_pass"):
        return float(thresholds), float(thresholds)
    low, high = thresholds
    if low >= high:
        raise ValueError("the low threshold must be below the high one")
    return float(low), float(high)


def passes(cell: Column, kind: str, thresholds, inclusive: bool = True,
           stop_keeps_bounds: bool = True) -> Column:
    low, high = _bounds(kind, thresholds)
    if kind == "low_pass":
        return cell <= high if inclusive else cell < high
    if kind == "high_pass":
        return cell >= low if inclusive else cell > low
    if kind == "band_pass":
        return (cell >= low) & (cell <= high) if inclusive else (cell > low) & (cell < high)
    keep_bounds = inclusive if stop_keeps_bounds else not inclusive
    return (cell <= low) | (cell >= high) if keep_bounds else (cell < low) | (cell > high)


def threshold_filter(df: DataFrame, column: str, kind: str, thresholds,
                     inclusive: bool = True) -> DataFrame:
    """Missing cells are dropped; an inclusive band stop keeps its bounds."""
    return df.filter(passes(F.col(column), kind, thresholds, inclusive))


class Filtered(NamedTuple):
    rows: DataFrame
    summary: DataFrame


def threshold_filter_keep_missing(df: DataFrame, column: str, kind: str, thresholds,
                                  inclusive: bool = True) -> Filtered:
    """Missing cells stay; an inclusive band stop removes its bounds."""
    cell = number(column)
    held = passes(cell, kind, thresholds, inclusive, stop_keeps_bounds=False)
    kept = cell.isNull() | held
    summary = df.agg(
        F.count(F.lit(1)).alias("original_count"), F.count_if(kept).alias("filtered_count"),
        F.count_if(cell.isNull()).alias("nan_count"), F.count_if(held).alias("_held"))
    share = lambda part, whole: F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))
    o, f, m = F.col("original_count"), F.col("filtered_count"), F.col("nan_count")
    summary = summary.select(
        "original_count", "filtered_count", (o - f).alias("removed_count"),
        share(f, o).alias("filtered_percentage"), share(o - f, o).alias("removed_percentage"),
        "nan_count", share(F.col("_held"), o - m).alias("non_nan_filtered_percentage"))
    return Filtered(df.filter(kept), summary)


class FilterSpec(NamedTuple):
    column: str
    kind: str
    thresholds: object
    inclusive: bool = True


def default_filters(df: DataFrame, columns: Sequence[str]) -> list[FilterSpec]:
    """Low pass at the 0.9 quantile and high pass at the 0.1 quantile."""
    q = quantile_table(df, columns, [0.1, 0.9])
    specs = []
    for c in columns:
        if q.get((c, 0.9)) is not None:
            specs += [FilterSpec(c, "low_pass", q[c, 0.9]), FilterSpec(c, "high_pass", q[c, 0.1])]
    return specs


def filter_statistics(df: DataFrame, specs: Sequence[FilterSpec]) -> DataFrame:
    """One row per filter; all of them are counted in one pass."""
    counts = [F.count_if(passes(number(s.column), s.kind, s.thresholds, s.inclusive)).alias(f"k{i}")
              for i, s in enumerate(specs)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *counts)
    cells = F.explode(F.array(*[
        F.struct(F.lit(s.column).alias("column"), F.lit(s.kind).alias("filter_type"),
                 F.lit(_bounds(s.kind, s.thresholds)[0]).alias("low"),
                 F.lit(_bounds(s.kind, s.thresholds)[1]).alias("high"),
                 F.col(f"k{i}").alias("filtered_count")) for i, s in enumerate(specs)]))
    return row.select("n", cells.alias("c")).select(
        "c.*", F.col("n").alias("original_count"),
        (F.col("n") - F.col("c.filtered_count")).alias("removed_count"),
        F.coalesce(F.try_divide(F.col("c.filtered_count") * 100.0, F.col("n")), F.lit(0.0)).alias("kept_percentage"))


def threshold_sweep(df: DataFrame, column: str,
                    probs: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Rows kept by low and high pass at several quantiles."""
    q = quantile_table(df, [column], probs)
    of: dict[object, list[float]] = {}
    for p in probs:
        of.setdefault(q[column, p], []).append(p)
    specs = [FilterSpec(column, kind, v) for v in of for kind in ("low_pass", "high_pass")]
    stats = filter_statistics(df, specs)
    same = F.coalesce(*[F.when(F.col("low") == F.lit(v), F.array(*[F.lit(p) for p in ps])) for v, ps in of.items()])
    return stats.select(F.explode(same).alias("prob"), "filter_type", F.col("low").alias("threshold"),
                        "filtered_count", "kept_percentage")


def clip_upper(df: DataFrame, columns: Sequence[str], prob: float = 0.99, factor: float = 10.0) -> DataFrame:
    q = quantile_table(df, columns, [prob])
    return df.withColumns({c: F.least(F.col(c), F.lit(q[c, prob] * factor)) for c in columns
                           if q.get((c, prob)) is not None})


def fill_missing(df: DataFrame, number_value: float = 0, text_value: str = "Unknown",
                 text_values: dict[str, str] | None = None) -> DataFrame:
    values: dict[str, object] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            values[f.name] = number_value
        elif isinstance(f.dataType, T.StringType):
            values[f.name] = (text_values or {}).get(f.name, text_value)
    return df.fillna(values)


def typed(df: DataFrame, integers: Sequence[str] = (), doubles: Sequence[str] = (),
          texts: Sequence[str] = ()) -> DataFrame:
    """Select and cast; a cell that does not parse becomes NULL."""
    kind = {**{c: "int" for c in integers}, **{c: "double" for c in doubles}, **{c: "string" for c in texts}}
    as_number = lambda c: F.col(c).try_cast("double").try_cast("int")
    return df.select(*[(as_number(c) if k == "int" and dict(df.dtypes)[c] == "string"
                        else F.col(c).try_cast(k)).alias(c) for c, k in kind.items()])


def within_tolerance(df: DataFrame, column: str, target: float, tolerance: float,
                     kind: str = "absolute", allowed: Sequence[str] | None = None) -> DataFrame:
    """``percentage`` bounds of a negative target are in the wrong order and
    match nothing, which is kept."""
    if column not in (allowed or df.columns):
        raise ValueError(f"{column} cannot be searched")
    if kind == "absolute":
        low, high = target - tolerance, target + tolerance
    elif kind == "percentage":
        low, high = target * (1 - tolerance / 100.0), target * (1 + tolerance / 100.0)
    else:
        raise ValueError("kind must be absolute or percentage")
    return df.filter(F.col(column).between(low, high))


def lookup(df: DataFrame, **wanted) -> DataFrame:
    """Rows equal to every given value; None leaves a column free."""
    for column, value in wanted.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def one_hot_long(df: DataFrame, row_id: str, columns: Sequence[str]) -> DataFrame:
    """row_id, column, level: the ones of a one-hot table without its zeros, for
    any number of levels.  The first level of a column has no rows, as it has
    no column in the wide form; one aggregate finds it."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]))
    first = df.agg(*[F.min(c).cast("string").alias(f"_{i}") for i, c in enumerate(columns)]).first()
    known = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(first[i]).cast("string"))])
    return df.select(row_id, cells.alias("x")).select(row_id, "x.*").filter(F.col("level") != F.element_at(known, F.col("column")))


def one_hot(df: DataFrame, columns: Sequence[str], max_levels: int = 1000) -> DataFrame:
    """0/1 columns for every level but the first.  Each level is a column of the
    plan, so there may be ``max_levels`` of them; ``one_hot_long`` takes any number."""
    for column in columns:
        levels = sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(max_levels + 1).collect())
        if len(levels) > max_levels:
            raise ValueError(f"{column} has more than {max_levels} levels: use one_hot_long")
        df = df.withColumns({f"{column}_{v}": F.coalesce((F.col(column) == v).cast("int"), F.lit(0))
                             for v in levels[1:]}).drop(column)
    return df


# ---- transforms that reduce skew --------------------------------------------

def box_cox(cell: Column, lam: Column) -> Column:
    return F.when(F.abs(lam) < 1e-12, F.ln(cell)).otherwise(F.try_divide(F.pow(cell, lam) - 1, lam))


def yeo_johnson(cell: Column, lam: Column) -> Column:
    mu = 2 - lam
    up = F.when(F.abs(lam) < 1e-12, F.ln(cell + 1)).otherwise(F.try_divide(F.pow(cell + 1, lam) - 1, lam))
    down = F.when(F.abs(mu) < 1e-12, -F.ln(1 - cell)).otherwise(-F.try_divide(F.pow(1 - cell, mu) - 1, mu))
    return F.when(cell >= 0, up).otherwise(down)


def _best_lambda(df: DataFrame, transform, jacobian: Column, low=-5.0, high=5.0, rounds=4, points=11) -> float:
    """Maximum of the normal log-likelihood.  Every round scores a whole grid in
    one pass (grid points are grouped map-side) and narrows it around the best;
    a parabola through the last three points gives the final digits."""
    fixed = df.agg(F.count("value").alias("n"), F.sum(jacobian).alias("j")).first()
    score, step = {}, 0.0
    for _ in range(rounds):
        step = (high - low) / (points - 1)
        grid = F.array(*[F.lit(low + i * step) for i in range(points)])
        spread = (df.select("value", F.explode(grid).alias("lam")).groupBy("lam")
                    .agg(F.var_pop(transform(F.col("value"), F.col("lam"))).alias("v")).collect())
        score = {r.lam: (r.lam - 1) * fixed.j - fixed.n / 2 * math.log(r.v)
                 for r in spread if r.v is not None and r.v > 0 and math.isfinite(r.v)}
        best = max(score, key=score.get)
        low, high = best - step, best + step
    around = sorted(score, key=lambda g: abs(g - best))[:3]
    if len(around) == 3:
        left, mid, right = (score[g] for g in sorted(around))
        bend = left - 2 * mid + right
        if bend < 0 and sorted(around)[1] == best:
            best += 0.5 * step * (left - right) / bend
    return best


def transformation_report(df: DataFrame, column: str) -> DataFrame:
    """transformation, skewness, lambda, best: candidates and the one whose
    skewness is closest to zero."""
    values = df.select(number(column).alias("value")).filter(F.col("value").isNotNull())
    probe = values.agg(F.count("value").alias("n"), F.min("value").alias("low"),
                       F.count_if(F.col("value") == 0).alias("zeros")).first()
    if probe.n < 5:
        raise ValueError("at least five values are needed")
    v = F.col("value")
    candidates: dict[str, tuple[Column, float | None]] = {"original": (v, None)}
    if probe.low > 0:
        candidates["log"] = (F.ln(v), None)
    if probe.low >= 0:
        candidates["sqrt"] = (F.sqrt(v), None)
    if probe.zeros == 0:
        candidates["reciprocal"] = (F.lit(1.0) / v, None)
    if probe.low > 0:
        lam = _best_lambda(values, box_cox, F.ln(v))
        candidates["boxcox"] = (box_cox(v, F.lit(lam)), lam)
    lam = _best_lambda(values, yeo_johnson, F.signum(v) * F.ln(F.abs(v) + 1))
    candidates["yeojohnson"] = (yeo_johnson(v, F.lit(lam)), lam)
    return skew_of(values, candidates)


def skew_of(values: DataFrame, candidates: dict[str, tuple[Column, float | None]]) -> DataFrame:
    n = F.count("value")
    row = values.agg(*[corrected_skew(n, F.skewness(c)).alias(k) for k, (c, _) in candidates.items()])
    cells = F.explode(F.array(*[
        F.struct(F.lit(k).alias("transformation"), F.col(k).alias("skewness"),
                 F.lit(lam).cast("double").alias("lambda")) for k, (_, lam) in candidates.items()]))
    out = row.select(cells.alias("c")).select("c.*")
    distance = F.when(F.col("transformation") != "original", F.abs("skewness"))
    nearest = F.min(distance).over(Window.partitionBy())  # a handful of rows
    return out.withColumn("best", F.coalesce(distance == nearest, F.lit(False)))
