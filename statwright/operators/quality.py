"""Row validation, declared constraints and missing-value profiles."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import half_even

Rule = Callable[[Column], Column]


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Raises with the names that are absent, before any job starts."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def missing_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """column, present: one row per required name."""
    return df.sparkSession.createDataFrame(
        [(c, c in df.columns) for c in required], "column string, present boolean")


class Validated(NamedTuple):
    rows: DataFrame
    report: DataFrame


def _passes(column: str, rule: Rule, nulls: str) -> Column:
    cell = F.col(column)
    held = F.coalesce(rule(cell), F.lit(False))
    return held if nulls == "fail" else cell.isNull() | held


def validate(df: DataFrame, rules: dict[str, Rule], on_error: str = "skip",
             nulls: str = "pass") -> Validated:
    """Rules by column.  ``skip`` drops failing rows, ``log`` keeps them and
    ``fail`` raises when there is one.  A missing cell passes unless ``nulls``
    is ``"fail"``."""
    require_columns(df, list(rules))
    tests = {c: _passes(c, rule, nulls) for c, rule in rules.items()}
    every = reduce(lambda a, b: a & b, tests.values())
    counts = df.agg(*[F.count_if(~t).alias(c) for c, t in tests.items()],
                    F.count_if(~every).alias("(any)"))
    report = _to_rows(counts, [*tests, "(any)"], "column", "failures")
    if on_error == "fail" and not df.filter(~every).isEmpty():
        raise ValueError("rows fail validation")
    return Validated(df if on_error == "log" else df.filter(every), report)


def _to_rows(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    cells = F.explode(F.array(*[
        F.struct(F.lit(n).alias(key), F.col(f"`{n}`").alias(value)) for n in names]))
    return one_row.select(cells.alias("c")).select("c.*")


class Reference(NamedTuple):
    child: str
    child_key: str
    parent: str
    parent_key: str


def constraint_report(tables: dict[str, DataFrame], checks: dict[tuple[str, str], Column] | None = None,
                      not_null: Sequence[tuple[str, str]] = (), unique: Sequence[tuple[str, Sequence[str]]] = (),
                      foreign: Sequence[Reference] = ()) -> DataFrame:
    """table, constraint, violations.

    CHECK and NOT NULL of one table share one pass; duplicates are counted
    after grouping by the key; orphans are the rows an anti join leaves.
    """
    parts = []
    for name, df in tables.items():
        counted = {f"CHECK {label}": F.count_if(~F.coalesce(rule, F.lit(True)))
                   for (t, label), rule in (checks or {}).items() if t == name}
        counted |= {f"NOT NULL {c}": F.count_if(F.col(c).isNull()) for t, c in not_null if t == name}
        if counted:
            row = df.agg(*[agg.alias(label) for label, agg in counted.items()])
            parts.append(_to_rows(row, list(counted), "constraint", "violations")
                         .select(F.lit(name).alias("table"), "constraint", "violations"))
    for name, key in unique:
        label = f"UNIQUE {', '.join(key)}"
        repeated = tables[name].groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts.append(repeated.agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit(name).alias("table"), F.lit(label).alias("constraint"), "violations"))
    for ref in foreign:
        child = tables[ref.child].filter(F.col(ref.child_key).isNotNull())
        parent = tables[ref.parent].select(F.col(ref.parent_key).alias("_parent_key"))
        orphans = child.join(parent, F.col(ref.child_key) == F.col("_parent_key"), "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(ref.child).alias("table"),
            F.lit(f"FOREIGN KEY {ref.child_key} -> {ref.parent}").alias("constraint"), "violations"))
    return reduce(DataFrame.unionByName, parts)


def relationship_report(tables: dict[str, DataFrame], references: Sequence[Reference],
                        primary: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """relationship, kind, junction, max_per_parent.

    A table with two or more references and at most one further column joins
    its parents many-to-many; every other reference is one-to-many.
    """
    primary = primary or {}
    by_child: dict[str, list[Reference]] = {}
    for ref in references:
        by_child.setdefault(ref.child, []).append(ref)
    parts = []
    for child, refs in by_child.items():
        own = set(primary.get(child, ())) | {r.child_key for r in refs}
        extra = [c for c in tables[child].columns if c not in own]
        parents = sorted({r.parent for r in refs})
        junction = len(refs) >= 2 and len(extra) <= 1 and len(parents) >= 2
        for ref in refs:
            kind = "Many-to-Many" if junction else "One-to-Many"
            label = (f"{parents[0]} <-> {parents[1]}" if junction else f"{ref.parent} -> {child}")
            fan = (tables[child].filter(F.col(ref.child_key).isNotNull())
                   .groupBy(ref.child_key).agg(F.count(F.lit(1)).alias("n")))
            parts.append(fan.agg(F.max("n").alias("max_per_parent")).select(
                F.lit(label).alias("relationship"), F.lit(kind).alias("kind"),
                F.lit(child if junction else None).cast("string").alias("junction"),
                F.lit(ref.child_key).alias("key"), "max_per_parent"))
    return reduce(DataFrame.unionByName, parts)


def is_missing(df: DataFrame, column: str) -> Column:
    cell = F.col(f"`{column}`")
    kind = df.schema[column].dataType
    return cell.isNull() | F.isnan(cell) if isinstance(kind, (T.DoubleType, T.FloatType)) else cell.isNull()


def missing_per_row(df: DataFrame, columns: Sequence[str] | None = None,
                    output: str = "missing_cells") -> DataFrame:
    flags = [is_missing(df, c).cast("int") for c in columns or df.columns]
    return df.withColumn(output, reduce(lambda a, b: a + b, flags))


class MissingProfile(NamedTuple):
    summary: DataFrame
    columns: DataFrame


def missing_profile(df: DataFrame) -> MissingProfile:
    """``summary`` is one row, ``columns`` one row per column; both come from
    single aggregates over the table."""
    names = df.columns
    counts = [F.count_if(is_missing(df, c)).alias(c) for c in names]
    in_row = reduce(lambda a, b: a + b, [is_missing(df, c).cast("int") for c in names])
    width = len(names)
    total = df.agg(F.count(F.lit(1)).alias("n"), F.sum(in_row).alias("missing"),
                   F.count_if(in_row > 0).alias("rows_with_missing"),
                   F.count_if(in_row == width).alias("empty_rows"), *counts)
    complete = reduce(lambda a, b: a + b, [(F.col(f"`{c}`") == 0).cast("int") for c in names])
    summary = total.select(
        F.coalesce("missing", F.lit(0)).alias("total_missing"),
        half_even(F.coalesce(F.try_divide(F.col("missing") * 100.0, F.col("n") * width), F.lit(0.0)), 2)
        .alias("missing_pct"),
        "rows_with_missing", "empty_rows", complete.alias("complete_columns"))
    kinds = dict(df.dtypes)
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col(f"`{c}`").alias("missing"))
        for c in names]))
    columns = (total.select("n", cells.alias("c")).select(
        "c.*", half_even(F.coalesce(F.try_divide(F.col("c.missing") * 100.0, F.col("n")), F.lit(0.0)), 2)
        .alias("missing_pct")))
    return MissingProfile(summary, columns)


def high_missing_columns(df: DataFrame, over_pct: float = 50.0) -> DataFrame:
    return missing_profile(df).columns.filter(F.col("missing_pct") > over_pct)


def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def constant_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns or _numeric(df))
    row = df.agg(*[F.coalesce(F.min(F.when(~is_missing(df, c), F.col(c)))
                              == F.max(F.when(~is_missing(df, c), F.col(c))), F.lit(False)).alias(c)
                   for c in names])
    return _to_rows(row, names, "column", "constant").filter("constant").select("column")


def duplicate_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """first, second: columns of one type that agree in every row."""
    kinds = dict(df.dtypes)
    names = list(columns or df.columns)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:] if kinds[a] == kinds[b]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "first string, second string")
    row = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}")
                   for i, (a, b) in enumerate(pairs)])
    cells = F.explode(F.array(*[
        F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"p{i}").alias("same"))
        for i, (a, b) in enumerate(pairs)]))
    return row.select(cells.alias("c")).select("c.*").filter("same").drop("same")


class Duplicates(NamedTuple):
    rows: DataFrame
    summary: DataFrame


def duplicate_rows(df: DataFrame) -> Duplicates:
    """The rows without full repeats, and the number of repeats."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    summary = counted.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
                          F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))
    return Duplicates(df.dropDuplicates(), summary)


def column_kinds(df: DataFrame) -> DataFrame:
    """column, numeric: numeric type, or text whose every cell parses."""
    tests = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.NumericType, T.BooleanType)):
            test = F.lit(True)
        elif isinstance(field.dataType, T.StringType):
            test = F.coalesce(F.bool_and(F.trim(F.col(field.name)).try_cast("double").isNotNull()
                                         | F.col(field.name).isNull()), F.lit(False))
        else:
            test = F.lit(False)
        tests.append(test.alias(field.name))
    return _to_rows(df.agg(*tests), df.columns, "column", "numeric")
