"""Ordered work over groups of any size.

A window over a group sorts that group inside one task.  That is right while
every group is small and fails when one group holds a large share of all
rows.  The helpers here look at the largest group first.  While it fits
(``block_rows``), they use a plain window.  Beyond it, rows are range
partitioned on (keys, order), each range is one *block*, and sums are carried
from block to block by a small table of block totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

BLOCK_ROWS = 2_000_000


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
              extra: Column | None = None) -> DataFrame:
    """Join on keys that may be NULL, with the keys of the left side only."""
    right = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return left.join(right, same if extra is None else [*same, extra], how).drop(*[f"_k_{k}" for k in keys])


def largest_group(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """(rows of the largest group, rows in all)."""
    if not keys:
        n = df.count()
        return n, n
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.agg(F.max("n").alias("top"), F.sum("n").alias("total")).first()
    return top.top or 0, top.total or 0


def settled(df: DataFrame, keys: Sequence[str], block_rows: int | None = BLOCK_ROWS) -> int | None:
    """``block_rows`` for steps over the same groups: None when even groups four
    times as large would fit, so that later steps need not measure again."""
    if block_rows is None or largest_group(df, keys)[0] * 4 <= block_rows:
        return None
    return block_rows


def with_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                block_rows: int | None = BLOCK_ROWS) -> tuple[DataFrame, bool]:
    """Adds ``_block`` and ``_tie``; says whether groups were split.

    Inside a key, blocks follow each other in the given order.  ``_tie`` lets
    rows that are equal in every order column be split as well.
    """
    top, total = largest_group(df, keys) if block_rows is not None else (0, 0)
    if block_rows is None or top <= block_rows:
        return df.withColumn("_block", F.lit(0)).withColumn("_tie", F.lit(0).cast("long")), False
    parts = max(2, -(-2 * total // block_rows))
    spread = (df.withColumn("_tie", F.monotonically_increasing_id())
                .repartitionByRange(parts, *keys, *order, "_tie")
                .withColumn("_block", F.spark_partition_id()))
    return materialise(spread), True


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                sums: dict[str, str], block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Inclusive running sums: ``sums`` maps a new column to the summed one."""
    blocked, split = with_blocks(df, keys, order, block_rows)
    inside = (Window.partitionBy(*keys, "_block").orderBy(*order, "_tie")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = blocked.select("*", *[F.sum(c).over(inside).alias(new) for new, c in sums.items()])
    if split:
        earlier = (Window.partitionBy(*keys).orderBy("_block")
                   .rowsBetween(Window.unboundedPreceding, -1))
        totals = blocked.groupBy(*keys, "_block").agg(
            *[F.sum(c).alias(f"_sum_{new}") for new, c in sums.items()])
        offsets = totals.select(*keys, "_block", *[
            F.coalesce(F.sum(f"_sum_{new}").over(earlier), F.lit(0)).alias(f"_off_{new}")
            for new in sums])
        out = join_same(out, offsets, [*keys, "_block"]).withColumns(
            {new: F.col(new) + F.col(f"_off_{new}") for new in sums}).drop(*[f"_off_{new}" for new in sums])
    return out.drop("_block", "_tie")


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              name: str = "_pos", block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Row number 1..n inside every key."""
    return (running_sum(df.withColumn("_one", F.lit(1).cast("long")), keys, order,
                        {name: "_one"}, block_rows).drop("_one"))


class Framed(NamedTuple):
    """Rows cut into chunks with copies of their neighbours.

    Windows over ``window`` see ``before`` rows back and ``after`` rows ahead
    of every row whose ``_own`` flag is true; the other rows are copies.
    """

    df: DataFrame
    window: Window

    def own(self, df: DataFrame) -> DataFrame:
        return df.filter("_own").drop("_own", "_chunk", "_tie", "_pos")


def framed(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int, after: int,
           block_rows: int | None = BLOCK_ROWS) -> Framed:
    """Prepare neighbour access (lag, lead, row frames) for groups of any size."""
    window = Window.partitionBy(*keys, "_chunk").orderBy(*order, "_tie")
    if block_rows is None or largest_group(df, keys)[0] <= block_rows:
        plain = (df.withColumn("_chunk", F.lit(0).cast("long"))
                   .withColumn("_tie", F.lit(0).cast("long"))
                   .withColumn("_own", F.lit(True)))
        return Framed(plain, window)
    size = max(block_rows, before + after + 1)
    place = positions(df, keys, order, "_pos", block_rows)
    at = F.col("_pos") - 1
    first = F.greatest(F.lit(0), F.floor((at - after) / size)).cast("long")
    last = F.floor((at + before) / size).cast("long")
    copies = (place.withColumn("_chunk", F.explode(F.sequence(first, last)))
                   .withColumn("_own", F.col("_chunk") == F.floor(at / size))
                   .withColumn("_tie", F.col("_pos")))
    return Framed(copies, window)


def value_counts_ranked(df: DataFrame, keys: Sequence[str], value: str,
                        block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """One row per distinct value of a key: ``n`` rows have it, ``upto`` rows
    have it or less.  The average rank of the value is ``upto - (n - 1) / 2``.
    """
    counts = (df.filter(F.col(value).isNotNull())
                .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n")))
    return running_sum(counts, keys, [value], {"upto": "n"}, block_rows)


def average_rank() -> Column:
    return F.col("upto") - (F.col("n") - 1) / F.lit(2.0)
