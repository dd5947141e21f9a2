"""Curves short enough for one task, many at a time.

Rows meet once, by curve and x (one shuffle of the points and nothing else).
A Python worker reads them as flat columns, takes the curves of equal knot
count together and solves their cubics as arrays over curves, so that the cost
of a numpy call is shared by hundreds of curves.  What is made of a curve
(its points, or one number) leaves the worker straight away.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .splines import many_values

#: Curves of more points go chunk by chunk.
SHORT_POINTS = 4096
#: Rows of whole curves that are looked at together, and numbers in one array of the curves solved together.
LOOK_ROWS = 32_768
ARRAY_NUMBERS = 65_536


def parted(points: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """Points of curves of at most ``most`` points, and of the longer ones (None if there are none)."""
    sizes = points.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = points.filter(F.col(key).isNotNull())
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= most:
        return known, None
    long, same = sizes.filter(F.col("_n") > most), F.col(key) == F.col("_key")
    return known.join(long, same, "left_anti"), known.join(long, same, "left_semi")


class Knots(NamedTuple):
    """Merged points of some curves, one after the other: NULL where the flag is set."""

    start: np.ndarray
    count: np.ndarray
    x: np.ndarray
    y: np.ndarray
    no_x: np.ndarray
    no_y: np.ndarray


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values (NaN for NULL) and where they are NULL."""
    none = np.asarray(column.is_null())
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False), none


def knots(first: np.ndarray, x: np.ndarray, no_x: np.ndarray, y: np.ndarray, no_y: np.ndarray, tolerance: float) -> Knots:
    """``curves.merged_by_x`` of whole curves in x order; ``first`` marks their first rows."""
    curve = np.cumsum(first) - 1
    new = first.copy()
    new[1:] |= (no_x[1:] != no_x[:-1]) | ~(no_x[1:] | (x[1:] == x[:-1]) | (np.isnan(x[1:]) & np.isnan(x[:-1])))
    at = np.flatnonzero(new)
    x, no_x, first, curve = x[at], no_x[at], first[at], curve[at]
    total, n = np.add.reduceat(np.where(no_y, 0.0, y), at), np.add.reduceat((~no_y).astype(np.int64), at)
    run = first.copy()
    run[1:] |= no_x[1:] | no_x[:-1] | ~(x[1:] - x[:-1] >= 0) | (x[1:] - x[:-1] >= tolerance)
    starts = np.flatnonzero(run)
    wide = x[np.r_[starts[1:], len(x)] - 1] - x[starts] >= tolerance
    lengths = np.diff(np.r_[starts, len(x)])
    part = np.where(np.repeat(wide, lengths), np.floor((x - np.repeat(x[starts], lengths)) / tolerance), 0.0)
    new = run
    new[1:] |= part[1:] != part[:-1]
    at = np.flatnonzero(new)
    n = np.add.reduceat(n, at)
    count = np.bincount(curve[at])
    return Knots(np.cumsum(count) - count, count, x[at], np.add.reduceat(total, at) / n, no_x[at], n == 0)


def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows again, no curve cut in two; ``_i`` is 1 in the first row of a curve."""
    held, rows = [], 0
    for batch in batches:
        cuts = np.flatnonzero(batch.column("_i").to_numpy() == 1)
        if len(cuts) and rows + cuts[-1] >= LOOK_ROWS:
            yield pa.Table.from_batches([*held, batch.slice(0, cuts[-1])]).combine_chunks()
            held, rows, batch = [], 0, batch.slice(cuts[-1])
        held.append(batch)
        rows += batch.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def half_up(x: np.ndarray, digits: int) -> np.ndarray:
    """Doubles as ``F.round`` gives them, half up from their shortest decimal form; that form is written only close to a half."""
    scale = 10.0 ** digits
    large = np.abs(x) * scale
    low = np.floor(large)
    rest = large - low
    out = np.copysign((low + (rest >= 0.5)) / scale, x) + 0.0
    # from 2 ** 53 on, a double has no digits to lose
    plain = (np.abs(rest - 0.5) > large * 2.0 ** -50) & (large < 2.0 ** 52)
    for i in np.flatnonzero(~plain):
        out[i] = x[i] if not abs(x[i]) < 2.0 ** 53 else float(Decimal(repr(float(x[i]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) + 0.0
    return out


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _keys(table: pa.Table, key: str) -> pa.Array:
    """Keys as a group has them: no negative zero."""
    column = _column(table, key)
    return pc.add(column, pa.scalar(0.0, column.type)) if pa.types.is_floating(column.type) else column


def cubics(k: Knots, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Curves (their places) of three knots or more with n points each at equal steps of the chord length: x and y, a column a curve."""
    grid = np.linspace(0, 1, n)
    for m in np.unique(k.count[k.count > 2]):
        places = np.flatnonzero(k.count == m)
        together = max(1, ARRAY_NUMBERS // max(m, n))
        for some in np.split(places, np.arange(together, len(places), together)):
            at = k.start[some] + np.arange(m)[:, None]
            x, y, none = k.x[at], k.y[at], k.no_x[at] | k.no_y[at]
            dx, dy = np.diff(x, axis=0), np.diff(y, axis=0)
            u = np.zeros(x.shape)
            u[1:] = np.cumsum(np.where(none[1:] | none[:-1], 0.0, np.sqrt(dx * dx + dy * dy)), axis=0)
            if not u[-1].all():
                raise ZeroDivisionError("a curve without length can't be resampled")
            u /= u[-1]
            known = ~np.isnan(u[0])
            if not known.all():
                some, u, x, y = some[known], u[:, known], x[:, known], y[:, known]
            if len(some):
                yield some, *many_values(u, x, y, grid)


Made = Callable[[pa.Table, np.ndarray, Knots, np.ndarray], Iterator[pa.RecordBatch]]


def each(points: DataFrame, key: str, tolerance: float, made: Made, schema: T.StructType) -> DataFrame:
    """``made`` of (rows of some curves, first row of each, the knots of those of three points or more, their places among all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(all="ignore"):
            for rows in whole(batches):
                first = _column(rows, "_i").to_numpy() == 1
                start = np.flatnonzero(first)
                n = np.diff(np.r_[start, len(first)])
                many, (x, no_x), (y, no_y) = n >= 3, _numbers(_column(rows, "x")), _numbers(_column(rows, "y"))
                in_many = np.repeat(many, n)
                places = np.flatnonzero(many)
                k = knots(first[in_many], x[in_many], no_x[in_many], y[in_many], no_y[in_many], tolerance) if len(places) else None
                yield from made(rows, start, k, places)

    inside = Window.partitionBy(key).orderBy("x", "y")
    return points.withColumn("_i", F.row_number().over(inside)).mapInArrow(run, schema)


def resampled(points: DataFrame, key: str, n: int, tolerance: float, digits: int | None = None) -> DataFrame:
    """``curves.resample`` of short curves."""
    spark, number = points.sparkSession, T.DoubleType()
    seq = points.select("seq").unionByName(spark.range(0).select(F.col("id").alias("seq"))).schema["seq"].dataType
    points = points.select(key, F.col("seq").cast(seq).alias("seq"), F.col("x").cast(number).alias("x"), F.col("y").cast(number).alias("y"))

    def made(rows: pa.Table, start: np.ndarray, k: Knots | None, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        name, numbered = _keys(rows, key), _column(rows, "seq")

        def batch(curve, seq, x, y, name=name):
            return pa.RecordBatch.from_arrays([name.take(pa.array(start[curve])), seq, x, y], [key, "seq", "x", "y"])

        def numbers(values, none=None):
            return pa.array(values if digits is None else half_up(values, digits), mask=none, from_pandas=none is None)
        few = np.ones(len(start), bool)
        few[places] = False
        if few.any():
            n_rows = np.diff(np.r_[start, len(rows)])
            keep = np.flatnonzero(np.repeat(few, n_rows))
            x, y = (numbers(values[keep], none[keep]) for values, none in (_numbers(_column(rows, c)) for c in "xy"))
            yield batch(np.repeat(np.arange(len(start)), n_rows)[keep], numbered.take(pa.array(keep)), x, y, _column(rows, key))
        if k is None:
            return
        if (k.count <= 2).any():
            keep = np.flatnonzero(np.repeat(k.count <= 2, k.count))
            seq_ = keep - np.repeat(k.start, k.count)[keep] + 1
            yield batch(np.repeat(places, k.count)[keep], pa.array(seq_).cast(numbered.type), numbers(k.x[keep], k.no_x[keep]), numbers(k.y[keep], k.no_y[keep]))
        for some, x, y in cubics(k, n):
            yield batch(np.repeat(places[some], n), pa.array(np.tile(np.arange(1, n + 1), len(some))).cast(numbered.type), numbers(x.T.ravel()), numbers(y.T.ravel()))

    return each(points, key, tolerance, made, T.StructType([points.schema[key], *[T.StructField(c, t) for c, t in (("seq", seq), ("x", number), ("y", number))]]))


def nearest_sums(points: DataFrame, key: str, probe: np.ndarray, tolerance: float) -> DataFrame:
    """key, distance_sum of the short curves that resampling gives as many points as the probe (x, y) has:
    from each point of the probe to the nearest of the curve, summed."""
    number, n = T.DoubleType(), len(probe)
    points = points.select(key, F.col("x").cast(number).alias("x"), F.col("y").cast(number).alias("y"))

    def made(rows: pa.Table, start: np.ndarray, k: Knots | None, places: np.ndarray) -> Iterator[pa.RecordBatch]:
        name = _keys(rows, key)
        px, py = probe[:, 0][:, None].copy(), probe[:, 1][:, None].copy()
        dx, dy = np.empty((n, n)), np.empty((n, n))
        for some, x, y in cubics(k, n) if k is not None else ():
            near, x, y = np.empty((len(some), n)), x.T.copy(), y.T.copy()
            for i in range(len(some)):
                np.subtract(x[i], px, out=dx)
                np.subtract(y[i], py, out=dy)
                np.multiply(dx, dx, out=dx)
                np.multiply(dy, dy, out=dy)
                np.add(dx, dy, out=dx)
                dx.min(axis=1, out=near[i])
                if np.isnan(near[i, 0]):
                    np.fmin.reduce(dx, axis=1, out=near[i])
            sums = np.sqrt(near).sum(axis=1)
            sums[np.isnan(sums)] = np.inf
            yield pa.RecordBatch.from_arrays([name.take(pa.array(start[places[some]])), pa.array(sums)], [key, "distance_sum"])

    return each(points, key, tolerance, made, T.StructType([points.schema[key], T.StructField("distance_sum", number)]))
