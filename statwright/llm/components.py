"""Connected components of an edge table by alternating large and small stars.

Each round is a grouped minimum and a join; both combine before they shuffle
or are split when a node is hot, so a star of a third of all nodes is no
problem.  Rounds grow with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.storage import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the larger (or the smaller and equal) neighbours of each node on the least of its neighbourhood."""
    if large:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    near = both.join(least, "a")
    if large:
        out = near.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = near.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.filter("a <> m").select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``, root the least node of its component."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        edges = materialise(_star(_star(edges, True), False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        edges.select(F.col("b"), F.col("b"))).distinct()
