"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entries become integers, ``floor(scale * c)``.  A task packs blocks of vectors
by bit: every dimension is shifted by its least value in the block, and each
bit plane of the shifted values becomes words of 64 rows.  The cross-product
of two dimensions is then a weighted sum of popcounts of ANDed planes; undoing
the shifts is integer arithmetic.  Spark adds the blocks' products as whole
numbers, so the scatter matrix has no rounding at all, and it is centred as
integers (``n * sum(x y) - sum(x) * sum(y)``) before its eigenvectors are
taken by ``eigh`` and sharpened by rotations in extended precision, so that
small components beside a large one keep their digits.  Only that matrix, whose size is the square of the dimensions, comes to
the driver.

The fit list has each distinct integer vector once, so copies do not weigh.
It is written once; the whitened fit list is measured again to give
``identity_error``, the largest entry of its covariance minus the identity.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, also from the fit; so are rows whose vector has another length
than the commonest of the fit list (ties: the longest).  Integers beyond 64
bits stop at the largest one.  Repeated rows get equal results.  A component
whose eigenvalue is zero (to rounding, as with fewer distinct vectors than
components) has a null coordinate and does not enter ``identity_error``;
``explained`` is null where all vectors are equal.  An empty table gives no
rows.  Other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.storage import written
from .words import shielded

SCALE = 256
#: Vectors of one bit-sliced block.
BLOCK = 1 << 14
#: Products are sent in two parts, so that sums of any number of them fit.
LOW_BITS = 60
RESULT = ("n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double")


def usable(vector: Column) -> Column:
    """Not null, and neither null, NaN nor infinity in it."""
    return vector.isNotNull() & ~F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")) + F.lit(0).cast("long"))


class Planes(NamedTuple):
    """Bit planes of a block: ``bits[k]`` is bit ``power[k]`` of dimension ``dim[k]``, 64 rows a word."""

    bits: np.ndarray
    dim: np.ndarray
    power: np.ndarray
    shift: list[int]


def sliced(x: np.ndarray) -> Planes:
    """Planes of the rows of ``x`` (int64), each dimension counted from its least value."""
    rows, dims = x.shape
    least = x.min(axis=0)
    up = x.view(np.uint64) - least.view(np.uint64)
    need = [int(v).bit_length() for v in up.max(axis=0)]
    dim = np.repeat(np.arange(dims), need)
    power = np.concatenate([np.arange(b) for b in need]) if dims else np.zeros(0, np.int64)
    words = -(-rows // 64)
    bits = np.zeros((len(dim), words * 8), dtype=np.uint8)
    at = 0
    for j, b in enumerate(need):
        for p in range(b):
            packed = np.packbits((up[:, j] >> np.uint64(p) & np.uint64(1)).astype(np.uint8))
            bits[at, :len(packed)] = packed
            at += 1
    return Planes(bits.view(np.uint64), dim, power.astype(np.int64), [int(v) for v in least])


def products(x: np.ndarray) -> np.ndarray:
    """Exact sums of the products of all pairs of columns of (1, x); Python integers, upper triangle."""
    rows, dims = x.shape
    planes = sliced(x)
    count = len(planes.dim)
    sums = np.zeros(dims, dtype=object)
    ones = np.bitwise_count(planes.bits).sum(axis=1, dtype=np.int64)
    cross = np.zeros((dims, dims), dtype=object)
    small = 2 * (int(planes.power.max()) + 1 if count else 0) + rows.bit_length() + 7 <= 62
    kind = np.int64 if small else object
    weight = np.array([1 << int(p) for p in planes.power], dtype=kind)
    first = np.searchsorted(planes.dim, np.arange(dims))
    for k in range(count):
        i = planes.dim[k]
        sums[i] += int(ones[k]) << int(planes.power[k])
        tail = first[i]
        both = np.bitwise_count(planes.bits[tail:] & planes.bits[k]).sum(axis=1, dtype=np.int64).astype(kind)
        line = np.zeros(dims, dtype=kind)
        np.add.at(line, planes.dim[tail:], both * weight[tail:] * weight[k])
        cross[i] += line
    a = np.array(planes.shift, dtype=object)
    out = np.zeros((dims + 1, dims + 1), dtype=object)
    out[0, 0] = rows
    out[0, 1:] = sums + rows * a
    out[1:, 1:] = cross + np.outer(sums, a) + np.outer(a, sums) + rows * np.outer(a, a)
    return out


def matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, dims)


def scatter(fit: DataFrame, dims: int) -> np.ndarray:
    """Sums of the products of all pairs of columns of (1, x), over the whole fit list."""
    low = (1 << LOW_BITS) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, size = None, [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = matrix(batch.slice(a, BLOCK), dims)
                held.append(part)
                size += len(part)
                if size >= BLOCK:
                    got = products(np.concatenate(held))
                    total = got if total is None else total + got
                    held, size = [], 0
        if held:
            got = products(np.concatenate(held))
            total = got if total is None else total + got
        if total is not None:
            i, j = np.triu_indices(dims + 1)
            v = total[i, j]
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array([Decimal(int(t) >> LOW_BITS) for t in v], pa.decimal128(38, 0)),
                 pa.array([int(t) & low for t in v], pa.int64())], names=["i", "j", "high", "low"])

    parts = fit.select("_x").mapInArrow(run, "i int, j int, high decimal(38,0), low long")
    sums = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"))
    out = np.zeros((dims + 1, dims + 1), dtype=object)
    for r in sums.collect():
        out[r.i, r.j] = out[r.j, r.i] = (int(r.high) << LOW_BITS) + int(r.low)
    return out


class Basis(NamedTuple):
    """What whitens a vector: n, the sums S, the components (columns, over the root of their eigenvalue) and the
    share of the variance of each; ``alive`` says which eigenvalues are not zero."""

    n: int
    sums: list[int]
    maps: np.ndarray
    explained: list[float | None]
    alive: list[bool]


def long_double(v: int) -> np.longdouble:
    """An integer of any size, rounded once or twice."""
    shift = max(0, abs(v).bit_length() - 62)
    return np.ldexp(np.longdouble(v >> shift), shift)


def principal(cov: np.ndarray, sweeps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) by falling eigenvalue.  ``eigh`` leaves an error in proportion to the
    largest eigenvalue; rotations in extended precision take it down to one in proportion to each."""
    dims = len(cov)
    _, q = np.linalg.eigh(cov.astype(np.float64))
    q = q[:, ::-1].astype(np.longdouble)
    q = q @ (3 * np.eye(dims, dtype=np.longdouble) - q.T @ q) / 2
    b = q.T @ cov @ q
    b = (b + b.T) / 2
    eps = np.finfo(np.longdouble).eps
    for _ in range(sweeps):
        scale = np.sqrt(np.maximum(np.diagonal(b), 0))
        far = np.triu(np.abs(b) > 4 * eps * np.maximum(np.outer(scale, scale), dims * eps * np.abs(b).max()), 1)
        if not far.any():
            break
        for i, j in np.argwhere(far):
            if b[i, j] == 0:
                continue
            t = (b[j, j] - b[i, i]) / (2 * b[i, j])
            t = (1 if t >= 0 else -1) / (abs(t) + np.sqrt(t * t + 1))
            c = 1 / np.sqrt(t * t + 1)
            turn = np.array([[c, t * c], [-t * c, c]], dtype=np.longdouble)
            for m in (b, q):
                m[:, [i, j]] = m[:, [i, j]] @ turn
            b[[i, j]] = turn.T @ b[[i, j]]
    values = np.diagonal(b)
    order = np.argsort(-values, kind="stable")
    return values[order], q[:, order]


def basis(total: np.ndarray, components: int) -> Basis:
    """Components of a scatter matrix, centred as integers."""
    n, sums = int(total[0, 0]), [int(v) for v in total[0, 1:]]
    dims = len(sums)
    centred = [[n * int(total[i + 1, j + 1]) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    square = n * n
    spread = sum(centred[i][i] for i in range(dims)) / square
    wide = np.array([[long_double(v) for v in row] for row in centred], dtype=np.longdouble).reshape(dims, dims) / long_double(square)
    values, vectors = principal(wide)
    values, vectors = values[:components], vectors[:, :components]
    floor = 64 * dims * np.finfo(np.longdouble).eps * (values[0] if len(values) else 0.0)
    alive = [bool(spread > 0 and e > floor) for e in values]
    maps = np.array([(vectors[:, k] / np.sqrt(values[k])).astype(np.float64) if ok else np.zeros(dims) for k, ok in enumerate(alive)]).T
    share = [(float(e) / spread if ok else 0.0) if spread > 0 else None for e, ok in zip(values, alive, strict=True)]
    return Basis(n, sums, maps.reshape(dims, len(alive)), share, alive)


def centred(x: np.ndarray, b: Basis) -> np.ndarray:
    """n * x - S, exactly."""
    most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    if most * b.n + max((abs(s) for s in b.sums), default=0) < 1 << 62:
        return x * b.n - np.array(b.sums, dtype=np.int64)
    return x.astype(object) * b.n - np.array(b.sums, dtype=object)


def squares(d: np.ndarray) -> list[Decimal | None]:
    """Sum of squares of each row, exactly; null beyond 38 digits."""
    most = max(abs(int(d.min())), abs(int(d.max()))) if d.size else 0
    if d.dtype != object and most * most * max(1, d.shape[1]) >= 1 << 62:
        d = d.astype(object)
    return [Decimal(int(v)) if int(v) < 10 ** 38 else None for v in (d * d).sum(axis=1)]


def coordinates(d: np.ndarray, b: Basis) -> np.ndarray:
    return (d / b.n).astype(np.float64) @ b.maps


def identity_error(fit: DataFrame, b: Basis, dims: int) -> float | None:
    """Largest entry of the covariance of the whitened fit list minus the identity, measured over the list."""
    k = len(b.alive)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            z = coordinates(centred(matrix(batch, dims), b), b)
            total += z.T @ z
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    got = fit.select("_x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    errors = [abs(r.v / b.n - (r.i == r.j)) for r in got if b.alive[r.i] and b.alive[r.j]]
    return max(errors, default=None)


def whiten(rows: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE) -> DataFrame:
    """The usable rows without their vector, with ``n`` (fit list), ``deviation``
    (squared distance of n * x from the sums), the first ``components``
    ``whitened`` coordinates, the variance ``explained`` by each, and ``identity_error``."""
    result = T.StructType.fromDDL(RESULT)
    kept = [c for c in rows.columns if c != vector and c not in result.names]
    mine, back = shielded(rows.select(*[F.col(f"`{c}`") for c in [*kept, vector]]), (vector,))
    good = mine.filter(usable(F.col(f"`{vector}`"))).withColumn("_x", integers(F.col(f"`{vector}`"), scale)).drop(vector)
    own = [c for c in good.columns if c != "_x"]
    fit = written(good.groupBy("_x").agg(F.count(F.lit(1)).alias("_copies")).select("_x"))
    size = fit.groupBy(F.size("_x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    schema = T.StructType([good.schema[c] for c in own] + result.fields)
    names = [*[c.alias(k) for c, k in zip([F.col(o) for o in own], kept, strict=True)], *[F.col(c) for c in result.names]]
    if size is None or size.dims == 0:
        return rows.sparkSession.createDataFrame([], schema).select(*names)
    dims = size.dims
    fit = fit.filter(F.size("_x") == dims)
    b = basis(scatter(fit, dims), min(components, dims))
    error = identity_error(fit, b, dims)
    share = pa.array([b.explained], pa.list_(pa.float64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            d = centred(matrix(batch, dims), b)
            z = coordinates(d, b)
            hidden = np.broadcast_to(~np.array(b.alive), z.shape).ravel()
            flat = pa.array(z.ravel(), mask=hidden)
            bounds = pa.array(np.arange(0, z.size + 1, z.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in own), pa.array(np.full(m, b.n)), pa.array(squares(d), pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(bounds, flat), share.take(pa.array(np.zeros(m, np.int32))), pa.array([error] * m, pa.float64())],
                names=[*own, *result.names])

    return good.filter(F.size("_x") == dims).mapInArrow(run, schema).select(*names)
