"""Removal of word sequences that occur more than once, by fixed-block anchors.

A window is ``window`` consecutive words of one document; words covered by a
window that also starts anywhere else are removed, every occurrence alike.

*Anchors.*  Each document is cut into non-overlapping blocks of
``(window + 1) // 2`` words.  Whatever its offset, a window holds one whole
block, so two equal windows always share the content of an anchor: the block
inside the one meets a run of words of the other.

*Probes.*  Every run of a block's length, at every word, is looked up in the
index of blocks.  A bitmap of fixed size (``BITS``) turns most of them down in
the task that reads the text; the rest and the blocks themselves are counted
by Spark.  Blocks met at least twice are live.

*Extension.*  A live block is extended word by word to the windows that hold
it, which are counted in turn.  A window found once is no repeat, and its row
still names its document and place, so these places go back to their document
by one join; all other extended windows are repeats, and the words they cover
are the maximal exact repeats.  No pairs of documents are ever made: a passage
held by many documents is one counted key.

Bitmaps only save work: a false positive adds a row that the counts turn down.
On tables of some hundred million blocks they fill up, and most runs travel
(eight bytes a word, added up before the shuffle).  Runs are compared by 64
bits, windows and texts by 96.

Defined results: a null or empty text has no words and keeps none; documents
shorter than a window are kept whole; equal documents of a window or more lose
all their words; occurrences may overlap inside one document; an empty table
gives no rows; repeated rows or ids count as documents of their own; other
columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import join_same
from . import words as W

WINDOW = 35
#: Bits of each bitmap, as a power of two.
BITS = 28
#: Rows of one batch sent to Spark.
ROWS = 1 << 18
LEAST_POWERS = 1 << 20
RESULT = "n_words long, n_removed long, kept string"


class Runs:
    """Hashes of all runs of consecutive words of a piece of texts, from running sums."""

    def __init__(self, w: W.Words, salt: int = 0) -> None:
        h = W.mix(w.hashes ^ W.U(salt)) if salt else w.hashes
        n = len(h)
        up, self.down = W.powers(max(LEAST_POWERS, 1 << n.bit_length()))
        self.total = np.zeros(n + 1, dtype=W.U)
        np.cumsum(h * up[:n], out=self.total[1:])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return W.mix((self.total[starts + size] - self.total[starts]) * self.down[starts] + W.U(size * int(W.STEP) % (1 << 64)))


def starts_of(w: W.Words, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, places in their text) of the runs of ``size`` words of the texts that hold a window."""
    count = np.diff(w.first)
    per = np.where(count >= window, count - size + 1, 0)
    places = W.span(np.zeros(len(per), np.int64), per)
    return places + np.repeat(w.first[:-1], per), places


def anchor_keys(docs: DataFrame, window: int) -> DataFrame:
    """Hashes of the non-overlapping blocks."""
    block = (window + 1) // 2

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = W.words(batch.column("text"), lower=False)
        starts, places = starts_of(w, window, block)
        keys = np.unique(Runs(w).at(starts[places % block == 0], block))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])
    return W.map_texts(docs.select("text"), make, "key long")


def bitmap(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """One bit for the highest ``bits`` bits of each key, in words of 64; its size does not depend on the keys."""
    bit = keys.select(F.shiftrightunsigned("key", 64 - bits).alias("bit"))
    got = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toArrow()
    out = np.zeros(1 << (bits - 6), dtype=W.U)
    out[got.column("at").to_numpy()] = got.column("mask").to_numpy().view(W.U)
    return out


def marked(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys >> W.U(64 - (len(table).bit_length() + 5))
    return (table[(bit >> W.U(6)).astype(np.int64)] >> (bit & W.U(63)) & W.U(1)).astype(bool)


def live_keys(docs: DataFrame, window: int, bits: int) -> DataFrame:
    """Hashes of blocks whose words also start somewhere else."""
    block = (window + 1) // 2
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(anchor_keys(docs, window), bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "text"):
            w = W.words(piece.column("text"), lower=False)
            starts, places = starts_of(w, window, block)
            keys = Runs(w).at(starts, block)
            own = places % block == 0
            met = own | marked(shared.value, keys)
            keys, own = keys[met], own[met]
            order = np.argsort(keys)
            keys, own = keys[order], own[order]
            head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
            times = np.diff(np.concatenate([head, [len(keys)]]))
            owned = np.maximum.reduceat(own.view(np.uint8), head).astype(bool) if len(head) else own
            for a in range(0, len(head), ROWS):
                part = slice(a, a + ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(keys[head[part]].view(np.int64)), pa.array(times[part].astype(np.int64)), pa.array(owned[part])],
                                                 names=["key", "n", "own"])
    found = docs.select("text").mapInArrow(W.tidy(run), "key long, n long, own boolean")
    return found.groupBy("key").agg(F.sum("n").alias("n"), F.max("own").alias("own")).filter((F.col("n") > 1) & F.col("own")).select("key")


def extended(w: W.Words, runs: Runs, live: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, places) of the windows that hold a live block."""
    block = (window + 1) // 2
    starts, places = starts_of(w, window, window)
    anchor = starts + -places % block
    heads = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])) if len(anchor) else np.zeros(0, np.int64)
    alive = marked(live, runs.at(anchor[heads], block))
    held = np.repeat(alive, np.diff(np.concatenate([heads, [len(anchor)]])))
    return starts[held], places[held]


def text_key(text: str) -> list[Column]:
    """96 bits of a text."""
    return [F.xxhash64(text).alias("_f"), F.hash(text).alias("_g")]


def lone_windows(docs: DataFrame, live, window: int) -> DataFrame:
    """(_f, _g, lone): the places of extended windows that occur once, by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "text"):
            w = W.words(piece.column("text"), lower=False)
            runs = Runs(w)
            starts, places = extended(w, runs, live.value, window)
            if not len(starts):
                continue
            key = runs.at(starts, window)
            more = Runs(w, 0x5DEECE66D).at(starts, window).view(np.int64).astype(np.int32)
            order = np.lexsort((more, key))
            key, more = key[order], more[order]
            head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (more[1:] != more[:-1])]))
            n = np.diff(np.concatenate([head, [len(key)]]))
            first = order[head]
            owner = np.searchsorted(w.first, starts[first], side="right") - 1
            f, g = (piece.column(c).to_numpy()[owner] for c in ("_f", "_g"))
            columns = [key[head].view(np.int64), more[head], f, g, places[first].astype(np.int32), np.minimum(n, 2).astype(np.int32)]
            for a in range(0, len(head), ROWS):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + ROWS]) for c in columns], names=["key", "more", "_f", "_g", "at", "n"])

    rows = docs.select("text", *text_key("text")).mapInArrow(W.tidy(run), "key long, more int, _f long, _g int, at int, n int")
    counted = rows.groupBy("key", "more").agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in ("_f", "_g", "at")))
    return counted.filter("n = 1").groupBy("_f", "_g").agg(F.collect_list("at").alias("_lone"))


def joined_words(w: W.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one blank."""
    data, at = w.data, np.flatnonzero(keep)
    step = np.zeros(len(data) + 2, dtype=np.int8)
    owner = np.searchsorted(w.first, at, side="right") - 1
    last = np.concatenate([owner[1:] != owner[:-1], [True]]) if len(at) else np.zeros(0, bool)
    stops = w.ends[at] + ~last
    step[w.starts[at]] += 1
    step[stops] -= 1
    inside = np.cumsum(step[:len(data)], dtype=np.int8).astype(bool)
    bytes_ = data.copy()
    bytes_[w.ends[at[~last]]] = 0x20
    bounds = np.concatenate([[0], np.cumsum(W.counts_in(inside, w.bounds))])
    return pa.LargeStringArray.from_buffers(len(w.bounds) - 1, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(bytes_[inside])).cast(pa.string())


def remove_repeats(docs: DataFrame, window: int = WINDOW, bits: int = BITS, keep_text: bool = True) -> DataFrame:
    """Adds ``n_words``, ``n_removed`` and ``kept``, the words left of each text."""
    mine, back = W.shielded(docs, ("text",))
    live = docs.sparkSession.sparkContext.broadcast(bitmap(live_keys(mine, window, bits), bits))
    held = mine.select("*", *text_key("text"))
    held = join_same(held, lone_windows(mine, live, window), ["_f", "_g"], "left")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        w = W.words(batch.column("text"), lower=False)
        starts, places = extended(w, Runs(w), live.value, window)
        lone = batch.column("_lone")
        sizes = np.diff(lone.offsets.to_numpy()) if len(lone) else np.zeros(0, np.int64)
        single = lone.values.slice(lone.offsets[0].as_py(), int(sizes.sum())).to_numpy() + np.repeat(w.first[:-1], sizes) if len(lone) else sizes
        cover = np.zeros(len(w.hashes) + 1, dtype=np.int64)
        cover[starts] += 1
        cover[single] -= 1
        repeated = np.flatnonzero(cover[:-1])
        step = np.zeros(len(w.hashes) + 1, dtype=np.int64)
        step[repeated] += 1
        step[repeated + window] -= 1
        gone = np.cumsum(step)[:-1] > 0
        return [pa.array(np.diff(w.first).astype(np.int64)), pa.array(W.sums(gone.astype(np.int64), w.first)), joined_words(w, ~gone)]

    out = W.add_columns(held.withColumn("_lone", F.coalesce("_lone", F.array().cast("array<int>"))), make, RESULT,
                        drop=("_f", "_g", "_lone", *(() if keep_text else ("text",))), reads=("_lone",))
    added = ("n_words", "n_removed", "kept")
    named = [c for c, name in zip(back, docs.columns, strict=True) if name not in added and (keep_text or name != "text")]
    return out.select(*named, *added)
