"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when at most ``max_rows`` rows exist.  Larger sides get
    no hint: the join then shuffles, and adaptive execution splits hot keys."""
    few = df.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def spread_out(df: DataFrame, *keys: str) -> DataFrame:
    """Before a step that is slow per row (numpy on arrays): use every core.
    Adaptive execution would merge partitions that are small in bytes."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys)
