"""The catalogue of runnable queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int | None = 6) -> DataFrame:
    """Round every double for comparison."""
    if digits is None:
        return df
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def query(name: str, sql: str | None = None, digits: int | None = 6):
    """Register ``f(t)``, where ``t(table)`` reads a table of the folder."""
    def register(f):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return rounded(f(lambda n: table(spark, folder, n)), digits)
        run.__name__ = name
        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return f
    return register
