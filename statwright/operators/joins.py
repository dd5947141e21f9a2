"""Joins of the course queries, with checked broadcasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizes import broadcast_if_small


def join_on(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Inner equi join; repeated keys multiply rows."""
    return left.join(right, on, "inner")


def rows_without(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN ... WHERE right IS NULL."""
    keys = right.select(F.col(right_key).alias("_key"))
    return left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")


def rows_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    keys = right.select(F.col(right_key).alias("_key"))
    return left.join(keys, F.col(left_key) == F.col("_key"), "left_semi")


def rows_not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """NOT IN over the non-missing keys: a left row without a key matches
    nothing and is not in the answer, unless the other side has no key at all.
    """
    keys = right.filter(F.col(right_key).isNotNull())
    kept = left if keys.isEmpty() else left.filter(F.col(left_key).isNotNull())
    return rows_without(kept, keys, left_key, right_key)


def with_dimension(facts: DataFrame, dimension: DataFrame, on: Sequence[str] | str,
                   how: str = "inner") -> DataFrame:
    """Join a lookup table; broadcast when its counted size allows it."""
    return facts.join(broadcast_if_small(dimension), on, how)
