"""Words of whole texts as numpy arrays, inside Spark tasks.

A batch of texts arrives as one Arrow column.  Its bytes are cut into words in
windows of bounded size, so a text of any length needs memory only for eight
bytes a word, never for arrays as long as the text.  All rules here look at
single bytes: every separator is an ASCII byte and only A-Z is lower-cased, so
working on UTF-8 bytes gives the same words as working on characters.

Words and word sequences are compared by 64-bit hashes: a random value per
byte, summed with powers of an odd base and mixed.  Two different words of one
comparison meet with a probability near 2**-64.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 1 << 18

#: Separators of the words ``[^\x20\x09-\x0D]+``.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Separators of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
BASE = 0xD1342543DE82EF95
STEP = U(0xA24BAED4963EE407)


@functools.lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64."""
    up, down = np.full(n, BASE, dtype=U), np.full(n, pow(BASE, -1, 1 << 64), dtype=U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


class Words(NamedTuple):
    """``first[i]:first[i + 1]`` are the words of text i; starts and ends are byte positions in ``data``."""

    first: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    bounds: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, bounds of each text in them); null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def windows(data: np.ndarray, bounds: np.ndarray, blank: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pieces of about WINDOW bytes that end at a separator or at the end of a text; a longer word makes a longer piece."""
    at, n = 0, len(data)
    while at < n:
        size = WINDOW
        while True:
            end = min(n, at + size)
            if end == n:
                break
            edge = bounds[np.searchsorted(bounds, end, side="right") - 1]
            stops = np.flatnonzero(blank[data[max(at, end - 4096):end]])
            stop = max(at, end - 4096) + stops[-1] + 1 if len(stops) else 0
            if not len(stops) and end - at > 4096 and edge <= at:
                stops = np.flatnonzero(blank[data[at:end]])
                stop = at + stops[-1] + 1 if len(stops) else 0
            if max(stop, edge) > at:
                end = int(max(stop, edge))
                break
            size *= 2
        yield at, end
        at = end


def run_hashes(part: np.ndarray, s: np.ndarray, e: np.ndarray, byte: np.ndarray = BYTE) -> np.ndarray:
    """Hash of the bytes from each s up to its e; ``byte`` has the value of every byte."""
    up, down = powers(WINDOW if len(part) <= WINDOW else 1 << int(len(part) - 1).bit_length())
    total = np.zeros(len(part) + 1, dtype=U)
    np.cumsum(byte[part] * up[:len(part)], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(U) * STEP)


def words(column: pa.Array, blank: np.ndarray = BLANK, lower: bool = True, hashed: bool = True) -> Words:
    """The words of every text of a column."""
    data, bounds = text_bytes(column)
    starts, ends, hashes = [], [], []
    for a, b in windows(data, bounds, blank):
        part = data[a:b]
        inside = ~blank[part]
        before = np.empty(len(part), dtype=bool)
        before[0], before[1:] = False, inside[:-1]
        heads = bounds[np.searchsorted(bounds, a):np.searchsorted(bounds, b)] - a
        before[heads] = False
        s = np.flatnonzero(inside & ~before)
        after = np.empty(len(part), dtype=bool)
        after[-1], after[:-1] = False, inside[1:]
        after[heads[heads > 0] - 1] = False
        e = np.flatnonzero(inside & ~after) + 1
        starts.append(s + a)
        ends.append(e + a)
        if hashed:
            hashes.append(run_hashes(part, s, e, BYTE[LOWER] if lower else BYTE))
    none = np.zeros(0, np.int64)
    starts = np.concatenate(starts) if starts else none
    ends = np.concatenate(ends) if ends else none
    hashes = np.concatenate(hashes) if hashes else np.zeros(0, U)
    return Words(np.searchsorted(starts, bounds), hashes, starts, ends, data, bounds)


def follow(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a sequence that is one word longer."""
    return mix(state * STEP + word)


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(bounds by text, hashes) of every run of n words; a text of fewer words, but not none, has its whole sequence as one."""
    h, count = w.hashes, np.diff(w.first)
    run = np.full(max(0, len(h) - n + 1), n, dtype=U)
    for k in range(n):
        run = follow(run, h[k:len(h) - n + 1 + k])
    per = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(per)])
    out = np.empty(first[-1], dtype=U)
    full = np.flatnonzero(count >= n)
    at = np.repeat(w.first[full] - first[full], per[full])
    into = span(first[full], per[full])
    out[into] = run[into + at]
    for i in np.flatnonzero((count > 0) & (count < n)):
        state = np.full(1, count[i], dtype=U)
        for x in h[w.first[i]:w.first[i + 1]]:
            state = follow(state, np.full(1, x, dtype=U))
        out[first[i]] = state[0]
    return first, out


def mix_pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One well-spread key for two numbers below 2**32; ``split_pair`` reverses it."""
    return mix(a.astype(U) << U(32) | b.astype(U))


def split_pair(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = key.astype(U, copy=True)
    x ^= x >> U(31) ^ x >> U(62)
    x *= U(pow(0x94D049BB133111EB, -1, 1 << 64))
    x ^= x >> U(27) ^ x >> U(54)
    x *= U(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    x ^= x >> U(30) ^ x >> U(60)
    return (x >> U(32)).astype(np.int64), (x & U(0xFFFFFFFF)).astype(np.int64)


def span(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, size of them."""
    if not len(sizes) or not sizes.sum():
        return np.zeros(0, np.int64)
    return np.arange(sizes.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; zero where it has none."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def pieces(batches: Iterable[pa.RecordBatch], text: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes of text, so that memory follows the text, not the row count."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes) // most if len(sizes) else sizes
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same, and at the end of a task the memory it has freed goes back to
    the machine: workers live on, and each task would add its own peak."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return wrapped


def map_texts(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None],
              schema: str | T.StructType, text: str = "text", most: int = 1 << 22) -> DataFrame:
    """Apply ``make`` to runs of rows of bounded text; rows stay in the tasks that read them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, most):
            out = make(piece)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(tidy(run), schema)


def add_columns(df: DataFrame, make: Callable[[pa.RecordBatch], list[pa.Array]], new: str,
                text: str = "text", drop: tuple[str, ...] = (), reads: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``df`` with new columns made from whole texts.  Columns of
    the same names are replaced; those in ``drop`` are left out; ``make`` may
    look at replaced columns that ``reads`` names."""
    added = [f.name for f in T.StructType.fromDDL(new).fields]
    kept = [c for c in df.columns if c not in added and c not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + T.StructType.fromDDL(new).fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *make(batch)], names=[*kept, *added])

    need = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*kept, text, *reads])])
    return map_texts(need, run, schema, text)


def shielded(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """Rename the columns an operator does not use, so that none clashes with
    its own; the second value selects the documents' columns again."""
    prefix = "_own_"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix += "_"
    names = {c: f"{prefix}{i}" for i, c in enumerate(docs.columns) if c not in used}
    return docs.withColumnsRenamed(names), [F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns]


def counts_in(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many bytes of each text are marked."""
    out = np.zeros(len(bounds) - 1, np.int64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(mask.view(np.uint8), bounds[full], dtype=np.int64)
    return out


def lists(values: np.ndarray, first: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """A list column from flat values and bounds."""
    flat = pa.array(values.view(np.int64) if values.dtype == U else values, type=kind)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), flat)
