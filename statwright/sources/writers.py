"""Exports, keyed writes and cascades."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def export(df: DataFrame, path: str, kind: str = "csv", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    writer.option("header", True).csv(path) if kind == "csv" else writer.format(kind).save(path)
    return path


def keyed_append(table: DataFrame | None, rows: DataFrame, key: Sequence[str], strategy: str = "insert",
                 clear_first: bool = False, order: str | None = None) -> DataFrame:
    """The table after INSERT, INSERT OR REPLACE or INSERT OR IGNORE of rows.

    Columns the table does not have are left out.  Of several new rows of one
    key, REPLACE keeps the greatest and IGNORE the smallest by the remaining
    columns, as rows have no order; with an ``order`` column of the new rows,
    REPLACE keeps the last and IGNORE the first by it.  INSERT raises on a key that exists twice.
    """
    key = list(key)
    if not key:
        raise ValueError("a key is needed")
    if table is None:
        table = rows.limit(0)
    if clear_first:
        table = table.limit(0)
    new = rows.select(*[c for c in table.columns if c in rows.columns])
    if strategy == "insert":
        both = table.unionByName(new, allowMissingColumns=True)
        if not both.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            raise ValueError("a key occurs more than once")
        return both
    rest = [c for c in new.columns if c not in key]
    pick = {"replace": F.max, "ignore": F.min}[strategy]
    if order:
        at = rows.groupBy(*key).agg((F.max_by if strategy == "replace" else F.min_by)(F.struct(F.lit(1).alias("_one"), *rest), order).alias("_r"))
        new = at.select(*key, *[f"_r.{c}" for c in rest])
    elif rest:  # one row per key by a partial aggregate, so a repeated key is no burden
        new = new.groupBy(*key).agg(pick(F.struct(*rest)).alias("_r")).select(*key, "_r.*")
    else:
        new = new.dropDuplicates()
    if strategy == "replace":
        return table.join(new.select(*key), key, "left_anti").unionByName(new, allowMissingColumns=True)
    return table.unionByName(new.join(table.select(*key), key, "left_anti"), allowMissingColumns=True)


def save_over(df: DataFrame, path: str) -> None:
    """Replace a Parquet table that may be read by ``df`` itself: the new rows
    are written beside it first."""
    spark = df.sparkSession
    beside = path.rstrip("/") + "_new"
    df.write.mode("overwrite").parquet(beside)
    spark.read.parquet(beside).write.mode("overwrite").parquet(path)


def rename_keys(tables: dict[str, tuple[DataFrame, str]], changes: DataFrame, old: str = "old", new: str = "new") -> dict[str, DataFrame]:
    """The same key change in a parent and its children: name -> (table, key)."""
    out = {}
    for name, (df, key) in tables.items():
        pairs = changes.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
        joined = df.join(pairs, df[key] == F.col("_old"), "left")
        out[name] = joined.select(*[F.coalesce("_new", key).alias(c) if c == key else F.col(c) for c in df.columns])
    return out


def delete_keys(tables: dict[str, tuple[DataFrame, str]], gone: DataFrame, column: str) -> dict[str, DataFrame]:
    keys = gone.select(F.col(column).alias("_gone"))
    return {name: df.join(keys, df[key] == F.col("_gone"), "left_anti") for name, (df, key) in tables.items()}


def catalogue_report(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """table, position, column, type, rows."""
    columns = spark.createDataFrame(
        [(name, i + 1, c, k) for name, df in tables.items() for i, (c, k) in enumerate(df.dtypes)],
        "table string, position int, column string, type string")
    counts = reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()])
    return columns.join(counts, "table")
