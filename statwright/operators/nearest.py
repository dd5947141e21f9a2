"""Exact nearest-point distances between point sets of any size.

The target points of a key are packed into a tree.  Points are numbered along
a curve that fills the plane (the bits of their two cell numbers, interleaved),
``block_points`` following each other are a leaf, ``FAN`` leaves following
each other a node, and so on to one root; every leaf and node carries the box
around its points.  The order only makes the boxes small, results rest on the
boxes themselves, so points of one x (or in one spot) are packed like others.

A point first looks into the leaf at its own place on the curve; the distance
found there is a bound.  Then it goes down from the root, one join a level,
only into nodes whose box is nearer than the bound.  Nothing lists all pairs,
no array is longer than a leaf or a node, and the levels grow with the
logarithm of the targets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import BLOCK_ROWS, largest_group, positions, running_sum
from ..functions.storage import written

BLOCK_POINTS = 128
FAN = 64
#: Cells along each axis of a key's box, as a power of two.
CELL_BITS = 26


def _nearest(points: Column, x: Column, y: Column) -> Column:
    away = F.transform(points, lambda p: (p.x - x) * (p.x - x) + (p.y - y) * (p.y - y))
    return F.sqrt(F.array_min(away))


def _coded(points: DataFrame, boxes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds the place on the curve through the box of the key: the bits of both cell numbers, interleaved."""
    top = (1 << CELL_BITS) - 1
    out = points.join(boxes, list(keys))
    for c in "xy":
        share = f"coalesce(try_divide({c} - _{c}0, _{c}1 - _{c}0), 0D)"
        out = out.withColumn(f"_c{c}", F.expr(f"cast(least(greatest(floor({share} * {top}), 0), {top}) AS bigint)"))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = out.withColumns({f"_c{c}": F.expr(f"(_c{c} | shiftleft(_c{c}, {shift})) & {mask}L") for c in "xy"})
    return out.withColumn("_code", F.expr("_cx | shiftleft(_cy, 1)")).drop("_cx", "_cy", "_x0", "_x1", "_y0", "_y1")


def _box(x: str = "x", y: str = "y") -> list[Column]:
    return [f(c).alias(f"_{n}{k}") for n, c in (("x", x), ("y", y)) for k, f in ((0, F.min), (1, F.max))]


def _leaf_of(targets: DataFrame, asked: DataFrame, keys: Sequence[str], size: int, block_rows: int | None) -> DataFrame:
    """Adds the leaf at a point's own place: by the count of targets up to it, one running sum over both tables."""
    marks = targets.select(*keys, "_code", F.lit(0).alias("_side"), F.lit(1).cast("long").alias("_t"))
    wants = asked.withColumns({"_side": F.lit(1), "_t": F.lit(0).cast("long")})
    both = wants.unionByName(marks, allowMissingColumns=True)
    counted = running_sum(both, keys, ["_code", "_side"], {"_upto": "_t"}, block_rows).filter("_side = 1")
    return counted.withColumn("_leaf", F.greatest(F.lit(0), F.floor((F.col("_upto") - 1) / size)).cast("long")).drop("_code", "_side", "_t", "_upto")


def _levels(leaves: DataFrame, keys: Sequence[str], fan: int) -> list[DataFrame]:
    """Tables (keys, _node, _kids) from the leaves' parents up to one node a key; kids carry their boxes."""
    out, below = [], leaves.select(*keys, F.col("_leaf").alias("_node"), "_x0", "_x1", "_y0", "_y1")
    while True:
        most = below.agg(F.max("_node")).first()[0] or 0
        kid = F.struct("_node", "_x0", "_x1", "_y0", "_y1")
        level = written(below.groupBy(*keys, F.floor(F.col("_node") / fan).cast("long").alias("_up")).agg(
            F.collect_list(kid).alias("_kids"), F.min("_x0").alias("_x0"), F.max("_x1").alias("_x1"), F.min("_y0").alias("_y0"), F.max("_y1").alias("_y1")))
        out.append(level.select(*keys, F.col("_up").alias("_node"), "_kids"))
        if most < fan:
            return out
        below = level.select(*keys, F.col("_up").alias("_node"), "_x0", "_x1", "_y0", "_y1")


def nearest_distances(points: DataFrame, targets: DataFrame, keys: Sequence[str], row_id: str,
                      block_points: int = BLOCK_POINTS, block_rows: int | None = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """keys, row_id, distance from every point to the nearest target of its key;
    points of a key without targets are left out.  Both tables have x and y."""
    asked = points.select(*keys, row_id, "x", "y")
    targets = targets.select(*keys, "x", "y")
    top, _ = largest_group(targets, keys)
    if top <= block_points:
        sets = targets.groupBy(*keys).agg(F.collect_list(F.struct("x", "y")).alias("_set"))
        return asked.join(sets, list(keys)).select(
            *keys, row_id, _nearest(F.col("_set"), F.col("x"), F.col("y")).alias("distance"))
    boxes = written(targets.groupBy(*keys).agg(*_box()))
    coded = _coded(targets, boxes, keys)
    placed = positions(coded, keys, ["_code", "x", "y"], "_pos", block_rows)
    leaves = written(placed.groupBy(*keys, F.floor((F.col("_pos") - 1) / block_points).cast("long").alias("_leaf"))
                     .agg(F.collect_list(F.struct("x", "y")).alias("_set"), *_box()))
    here = _leaf_of(coded, _coded(asked, boxes, keys), keys, block_points, block_rows)
    near = (here.join(leaves.select(*keys, "_leaf", "_set"), [*keys, "_leaf"])
            .select(*keys, row_id, "x", "y", "_leaf", _nearest(F.col("_set"), F.col("x"), F.col("y")).alias("_d")))
    near = written(near)
    front = near.withColumn("_node", F.lit(0).cast("long"))
    levels = _levels(leaves, keys, fan)
    for depth, level in enumerate(reversed(levels)):
        gap = "greatest(k._{c}0 - {c}, {c} - k._{c}1, 0D)"
        nearer = f"pow({gap.format(c='x')}, 2) + pow({gap.format(c='y')}, 2) < _d * _d * 1.000000000000001D"
        fresh = " AND k._node != _leaf" if depth + 1 == len(levels) else ""
        front = (front.join(level, [*keys, "_node"]).drop("_node")
                 .withColumn("_node", F.expr(f"explode(transform(filter(_kids, k -> {nearer}{fresh}), k -> k._node))")).drop("_kids"))
    found = (front.join(leaves.select(*keys, F.col("_leaf").alias("_node"), "_set"), [*keys, "_node"])
             .select(*keys, row_id, _nearest(F.col("_set"), F.col("x"), F.col("y")).alias("distance")))
    return (near.select(*keys, row_id, F.col("_d").alias("distance")).unionByName(found)
            .groupBy(*keys, row_id).agg(F.min("distance").alias("distance")))
