"""Language-model scores from a weighted backoff automaton.

The model is a smoothed bigram model.  Each word that begins a kept bigram is
a state; each kept bigram is an arc with its probability; a failure arc leads
from a state to the root at the state's backoff weight, and the root has an
arc for every word.  A text is one left-to-right traversal that adds up log10
probabilities.  A state is the last word, so the sum is one over the words and
the bigrams of a text, each looked up by its hash.

With c for counts in the training texts, N their tokens (words and ends), V
the distinct ones and D a discount from the counts of counts of the bigrams
whose words occur at least twice:

    root    p(w)   = (c(w) + 1) / (N + V + 1)
    arc     p(w|v) = (c(v w) - D) / c(v) + b(v) p(w)
    failure b(v)   = 1 - sum over the arcs of v of (c(v w) - D) / c(v)

so the probabilities of each state sum to one.

``corpus`` scores a table that holds the training texts themselves.  There
every bigram of a training text is an arc, those seen once too, and D comes
from the counts of counts of all bigrams, so b(v) = D t(v) / c(v) with t(v) the
number of different words after v.  Texts are cut into pieces and written as
places in the words of their piece.  The distinct bigrams of all pieces meet
by hash, then the words; each piece gets back what it can't know alone (what
only one piece has is known there), and its texts are walked with the state
carried from word to word.

``train`` and ``score`` are for texts that come later: there every bigram that
occurs ``LEAST`` times is an arc, at any corpus size.  Words and arcs are one
table that grows with the corpus.  Its entries with at least one in ``shard_words`` of all tokens (so
at most that many words and arcs) are sent to the tasks; the other words and
bigrams of each text are joined with the rest of the table, save those that a
bitmap of the rest (``FILTER_BITS`` at any size) shows to be in none.  Where an
entry is looked up changes no score.

Defined results: a null or empty text is one end token; without training texts
every token is unknown (N = V = 0); repeated rows are scored alike and count
as often as they occur; an empty table gives no rows; other columns are kept,
those named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.storage import bucketed, written
from . import words as W

RESULT = "n_tokens long, n_known long, base_score double, score double"
LEAST = 2
SHARD_WORDS = 1 << 21
ROWS = 1 << 18
CHUNK = 1 << 20
PIECE = 1 << 23
#: A piece with its counts has more bytes than this and goes to a worker alone; ten thousand counts have less.
ALONE = 1 << 20
MET = "piece long, keys array<long>, n array<long>, t array<long>"
STATS = -1
FILTER_BITS = 28
END = W.mix(np.array([0x656E64], dtype=W.U))[0]
BEGIN = W.mix(np.array([0x626567696E], dtype=W.U))[0]


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds by text, token hashes): the words of each text and its end."""
    w = W.words(column)
    first = w.first + np.arange(len(w.first))
    out = np.empty(first[-1], dtype=W.U)
    ends = np.zeros(len(out), dtype=bool)
    ends[first[1:] - 1] = True
    out[ends], out[~ends] = END, w.hashes
    return first, out


class Model(NamedTuple):
    """N, V and the log10 backoff weight at the head of a text."""

    tokens: int
    distinct: int
    begin: float


def ids_of(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Place of each hash in a sorted table, -1 where it is absent."""
    if not len(table):
        return np.full(len(hashes), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def histories(first: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The token before each; BEGIN at the head of a text."""
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[first[:-1]] = BEGIN
    return before


def counted(docs: DataFrame, key: Callable[[np.ndarray, np.ndarray], np.ndarray], short: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(v, w, n) by piece of text: tokens with one key, their number and one of
    their histories; ``short`` gives the numbers that stand for them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in W.pieces(batches, "text"):
            first, w = tokens(piece.column("text"))
            v = histories(first, w)
            _, at, n = np.unique(key(v, w), return_index=True, return_counts=True)
            for a in range(0, len(at), ROWS):
                k = at[a:a + ROWS]
                pair = [x[k] if short is None else short(x[k]) for x in (v, w)]
                yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in pair), pa.array(n[a:a + ROWS])], names=["v", "w", "n"])
    return docs.select("text").mapInArrow(run, "v long, w long, n long")


def bigrams(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(v, w, n) of the bigrams seen twice.  A word of the sorted table
    ``frequent`` travels as its place there, which compresses well."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def short(x: np.ndarray) -> np.ndarray:
        at = ids_of(x, shared.value)
        return np.where(at >= 0, at.astype(W.U), x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for b in batches:
            pair = []
            for c in ("v", "w"):
                x = b.column(c).to_numpy().view(W.U)
                at = np.flatnonzero(x < W.U(len(table)))
                x = x.copy()
                x[at] = table[x[at].astype(np.int64)]
                pair.append(pa.array(x.view(np.int64)))
            yield pa.RecordBatch.from_arrays([*pair, b.column("n")], names=["v", "w", "n"])
    few = counted(docs, W.follow, short).groupBy("v", "w").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST)
    return few.select("v", "w", "n").mapInArrow(run, "v long, w long, n long")


def keyed(gains: DataFrame) -> DataFrame:
    """Entries of bigrams under the hash that a text looks them up by."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, w = (b.column(c).to_numpy().view(W.U) for c in ("v", "w"))
            zero = np.zeros(len(v))
            yield pa.RecordBatch.from_arrays([pa.array(W.follow(v, w).view(np.int64)), b.column("n"), pa.array(zero.astype(np.int32)), pa.array(zero),
                                              b.column("gain")], names=["key", "n", "known", "base", "gain"])
    return gains.select("v", "w", "n", "gain").mapInArrow(run, "key long, n long, known int, base double, gain double")


def bitmap(entries: DataFrame) -> np.ndarray:
    """One bit for the highest ``FILTER_BITS`` bits of each key, in words of 64."""
    bit = entries.select(F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("bit"))
    got = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("mask")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=W.U)
    out[got.column("at").to_numpy()] = got.column("mask").to_numpy().view(W.U)
    return out


def train(docs: DataFrame) -> tuple[Model, DataFrame]:
    """(model, entries) of training texts.  The entries are the words and the
    arcs: key, occurrences, and what one occurrence in a text adds to
    ``n_known``, ``base_score`` and ``score``."""
    begin, end = int(BEGIN.view(np.int64)), int(END.view(np.int64))
    # A word that occurs once has one history, so any of its histories is that one.
    single = written(counted(docs, lambda v, w: w).groupBy(F.col("w").alias("key")).agg(F.sum("n").alias("n"), F.min("v").alias("v")))
    total = single.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"), F.sum(F.when(F.col("key") == end, F.col("n"))).alias("texts")).first()
    n, distinct, texts = total.n or 0, total.v, total.texts or 0
    frequent = single.filter(F.col("n") * SHARD_WORDS >= n).select("key").toArrow().column("key").to_numpy().view(W.U)
    arcs = written(bigrams(docs, np.unique(np.append(frequent, BEGIN))))

    # Bigrams seen once are all tokens that are no arc's; a word seen once is in one bigram as a word and in one as
    # a history.  (A single end is no history, but then the single begin is.)
    some = arcs.agg(F.sum("n").alias("n"), F.count_if(F.col("n") == 2).alias("two")).first()
    rare = single.filter(F.col("n") == 1)
    alone = rare.count()
    before = rare.groupBy(F.col("v").alias("h")).agg(F.count(F.lit(1)).alias("m"))
    both = before.join(rare.select("key"), F.col("h") == F.col("key")).agg(F.sum("m").alias("m")).first().m or 0
    if texts == 1:
        both += before.filter(F.col("h") == begin).agg(F.sum("m").alias("m")).first().m or 0
    one = n - (some.n or 0) - (2 * alone - both)
    discount = one / (one + 2 * some.two) if one and some.two else 0.5

    left = arcs.groupBy(F.col("v").alias("key")).agg(F.sum(F.col("n") - discount).alias("held"))
    heads = docs.sparkSession.createDataFrame([(begin, texts)] if texts else [], "key long, n long")
    states = written(single.select("key", "n").unionAll(heads).join(left, "key", "left").select(
        "key", "n", F.greatest(1 - F.coalesce("held", F.lit(0.0)) / F.col("n"), F.lit(1e-12)).alias("back")))
    head = states.filter(F.col("key") == begin).first()
    root = (F.col("c_w") + 1) / F.lit(float(n + distinct + 1))
    gain = F.log10((F.col("n") - discount) / F.col("c_v") + F.col("back") * root) - F.log10(F.col("back") * root)
    gains = (arcs.join(states.select(F.col("key").alias("v"), F.col("n").alias("c_v"), "back"), "v")
             .join(single.select(F.col("key").alias("w"), F.col("n").alias("c_w")), "w")
             .select("v", "w", "n", gain.alias("gain")))
    own = F.log10(F.col("n") + 1)
    roots = states.filter(F.col("key") != begin).select("key", "n", F.lit(1).alias("known"), own.alias("base"), (own + F.log10("back")).alias("gain"))
    return Model(n, distinct, math.log10(head.back) if head else 0.0), written(roots.unionAll(keyed(gains)))


def score(docs: DataFrame, model: Model, entries: DataFrame, shard_words: int = SHARD_WORDS, keep_text: bool = True) -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``base_score`` and ``score``; ``text`` is left out where it isn't kept."""
    often = F.col("n") * shard_words >= model.tokens
    got = entries.filter(often).select("key", "known", "base", "gain").toArrow()
    key = got.column("key").to_numpy().view(W.U)
    order = np.argsort(key)
    rare = entries.filter(~often).select("key", "known", "base", "gain")
    shared = docs.sparkSession.sparkContext.broadcast((bitmap(rare), key[order], *(got.column(c).to_numpy()[order] for c in ("known", "base", "gain"))))
    floor = math.log10(1 / (model.tokens + model.distinct + 1))

    def walk(batch: pa.RecordBatch) -> list[pa.Array]:
        bits, table, *adds = shared.value
        first, w = tokens(batch.column("text"))
        rows = np.repeat(np.arange(batch.num_rows), np.diff(first))
        found, rest, owner = [np.zeros(batch.num_rows) for _ in adds], [], []
        for looked in (w, W.follow(histories(first, w), w)):
            distinct, inverse = np.unique(looked, return_inverse=True)
            at = ids_of(distinct, table)
            for k, add in enumerate(adds):
                if len(table):
                    found[k] += W.sums(np.where(at >= 0, add[at], 0).astype(float)[inverse], first)
            bit = distinct >> W.U(64 - FILTER_BITS)
            maybe = (bits[(bit >> W.U(6)).astype(np.int64)] >> (bit & W.U(63)) & W.U(1)).astype(bool)
            out = np.flatnonzero(((at < 0) & maybe)[inverse])
            rest.append(looked[out])
            owner.append(rows[out])
        rest, owner = np.concatenate(rest), np.concatenate(owner)
        order = np.lexsort((rest, owner))
        rest, owner = rest[order], owner[order]
        heads = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (owner[1:] != owner[:-1])])) if len(rest) else np.zeros(0, np.int64)
        times = np.diff(np.concatenate([heads, [len(rest)]]))
        bounds = np.searchsorted(owner[heads], np.arange(batch.num_rows + 1))
        size = np.diff(first)
        base = found[1] + size * floor
        return [pa.array(size.astype(np.int64)), pa.array(found[0].astype(np.int64)), pa.array(base), pa.array(size * floor + found[2] + model.begin),
                W.lists(rest[heads], bounds), W.lists(times, bounds)]

    results = ("n_tokens", "n_known", "base_score", "score")
    mine, back = W.shielded(docs.drop(*results), ("text",))
    named = [c for c in docs.columns if c not in results]
    walked = W.add_columns(mine, walk, f"{RESULT}, _keys array<long>, _times array<long>", drop=() if keep_text else ("text",))
    part = written(walked.withColumn("_row", F.monotonically_increasing_id()))
    rest = part.select("_row", F.explode(F.arrays_zip("_keys", "_times")).alias("x")).select("_row", F.col("x._keys").alias("key"), F.col("x._times").alias("times"))
    more = (rest.join(rare, "key").groupBy("_row")
            .agg(*(F.sum(F.col(c) * F.col("times")).alias(f"_{c}") for c in ("known", "base", "gain"))))
    kept = [F.col(f"`{c}`") for c in walked.columns if c not in ("_keys", "_times")]
    out = part.select("_row", *kept).join(more, "_row", "left")
    for c, add in (("n_known", "_known"), ("base_score", "_base"), ("score", "_gain")):
        out = out.withColumn(c, F.col(c) + F.coalesce(add, F.lit(0)))
    return out.select(*[b for b, c in zip(back, named, strict=True) if keep_text or c != "text"], *results)


class Bigrams(NamedTuple):
    """The distinct bigrams of a piece: places of both words (the place after the last word is the head of a text),
    which of them each token ends, and how often each ends a token of a training text."""

    v: np.ndarray
    w: np.ndarray
    of: np.ndarray
    n: np.ndarray


def bigrams_of(token: np.ndarray, first: np.ndarray, trained: np.ndarray, distinct: int) -> Bigrams:
    before = np.empty(len(token), np.int64)
    before[1:] = token[:-1]
    before[first[:-1]] = distinct
    code, of = np.unique(before * (distinct + 1) + token, return_inverse=True)
    n = np.bincount(of[np.repeat(trained, np.diff(first))], minlength=len(code))
    return Bigrams(code // (distinct + 1), code % (distinct + 1), of.astype(np.int32), n)


def flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """All values of a list column; null lists have none."""
    got = pc.list_flatten(column)
    return (got.combine_chunks() if isinstance(got, pa.ChunkedArray) else got).to_numpy(zero_copy_only=False)


def cut(docs: DataFrame, own: list[str]) -> DataFrame:
    """One row a piece of about ``PIECE`` bytes of text: columns ``own`` of its texts, whether they are ``_trained``, their numbers
    of tokens, the hashes of its distinct words, the commonest first, and the tokens as places there."""
    kinds = T.StructType([docs.schema[c] for c in own])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, w = tokens(batch.column("text"))
        words, place, often = np.unique(w, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words))
        n = batch.num_rows
        texts = pa.StructArray.from_arrays([batch.column(c) for c in own], names=own) if own else pa.nulls(n, pa.struct([]))
        one = np.array([0, 1])
        return pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x) for x in (texts, batch.column("_trained"))]
            + [W.lists(x, one * len(x)) for x in (np.diff(first).astype(np.int64), words[order], rank[place])],
            names=["own", "trained", "sizes", "words", "tokens"])
    schema = T.StructType([T.StructField("own", T.ArrayType(kinds)), T.StructField("trained", T.ArrayType(T.BooleanType())),
                           *(T.StructField(c, T.ArrayType(k)) for c, k in (("sizes", T.LongType()), ("words", T.LongType()), ("tokens", T.IntegerType())))])
    need = docs.select(*dict.fromkeys([*own, "text", "_trained"]))
    return W.map_texts(need, run, schema, most=PIECE).withColumn("piece", F.monotonically_increasing_id())


class Piece(NamedTuple):
    """A piece with what came back for its bigrams: bounds of its texts, hashes of its words and of the head of a text, its
    bigrams, how often its training texts have each word, how many distinct words follow there that no other piece
    counts, and how often all training texts have each bigram."""

    first: np.ndarray
    token: np.ndarray
    hashes: np.ndarray
    pairs: Bigrams
    c: np.ndarray
    t: np.ndarray
    arcs: np.ndarray


def keys_of(hashes: np.ndarray, pairs: Bigrams) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the bigrams in order, their places)."""
    key = W.follow(hashes[pairs.v], hashes[pairs.w])
    order = np.argsort(key)
    return key[order], order


def opened(row: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Bigrams]:
    size, hashes, token, trained = (flat(row.column(c)) for c in ("sizes", "words", "tokens", "trained"))
    first = np.concatenate([[0], np.cumsum(size)])
    return first, token, np.append(hashes.view(W.U), BEGIN), trained, bigrams_of(token, first, trained, len(hashes))


def settled(row: pa.RecordBatch) -> Piece:
    first, token, hashes, trained, b = opened(row)
    c = np.bincount(b.w, b.n, len(hashes)).astype(np.int64)
    c[-1], t = trained.sum(), np.bincount(b.v[b.n > 0], minlength=len(hashes))
    key, order = keys_of(hashes, b)
    at, n = order[np.searchsorted(key, flat(row.column("keys")).view(W.U))], flat(row.column("n"))
    arcs = b.n.copy()
    arcs[at] = n >> 1
    other = at[(n & 1 == 0) & (b.n[at] > 0)]
    return Piece(first, token, hashes, b, c, t - np.bincount(b.v[other], minlength=len(hashes)), arcs)


def by_piece(df: DataFrame, make: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from make(batch.slice(i, 1))
    return df.mapInArrow(W.tidy(run), schema)


def sent(row: pa.RecordBatch, **columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    piece, size = row.column("piece")[0].as_py(), len(columns["key"])
    for a in range(0, size, ROWS):
        part = {k: pa.array((x.view(np.int64) if x.dtype == W.U else x)[a:a + ROWS]) for k, x in columns.items()}
        yield pa.RecordBatch.from_pydict({"piece": pa.array(np.full(min(ROWS, size - a), piece)), **part})


def pairs_asked(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The distinct bigrams of a piece and how often its training texts have each, in an order that compresses well."""
    _, _, hashes, _, b = opened(row)
    key, order = keys_of(hashes, b)
    n = b.n[order]
    order = np.argsort(n, kind="stable")
    yield from sent(row, key=key[order], n=n[order])


def words_asked(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The distinct words of a piece, how often its training texts have each, and how many distinct words it counts after each."""
    p = settled(row)
    yield from sent(row, key=p.hashes, n=p.c, t=p.t)


def met(rows: DataFrame) -> DataFrame:
    """The rows of a key brought together: for each piece the sums that differ from its own.  Bigrams come back as twice the
    sum, plus one for the one piece that counts it as a follower.  Rows ``STATS`` have (tokens, distinct) of words, or
    (tokens of bigrams seen twice or more, bigrams seen twice, seen once) of bigrams."""
    words = "t" in rows.columns

    def settle(key: np.ndarray, piece: np.ndarray, n: np.ndarray, t: np.ndarray | None = None) -> pa.RecordBatch:
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(key))))
        total = np.add.reduceat(n, heads)
        if t is not None:
            after = np.add.reduceat(t, heads)
            out = np.flatnonzero((total[group] != n) | (after[group] != t))
            first, second = total[group[out]], after[group[out]]
            real = total[key[heads] != BEGIN.view(np.int64)]
            stats = [real.sum(), np.count_nonzero(real)]
        else:
            out = np.flatnonzero(total[group] != n)
            learned = np.flatnonzero(n > 0)
            owner = np.zeros(len(key), np.int64)
            owner[learned[np.unique(group[learned], return_index=True)[1]]] = 1
            first, second = 2 * total[group[out]] + owner[out], np.zeros(0, np.int64)
            stats = [total[total > 1].sum(), (total == 2).sum(), (total == 1).sum()]
        order = np.argsort(piece[out], kind="stable")
        to = piece[out][order]
        ends = np.append(np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]])) if len(to) else np.zeros(0, np.int64), len(to))
        names = np.append(to[ends[:-1]], STATS)
        lists = [W.lists(key[out][order], np.append(ends, len(to))), W.lists(np.append(first[order], stats), np.append(ends, len(to) + len(stats)))]
        lists.append(W.lists(second[order], np.append(ends, len(to))) if words else W.lists(second, np.zeros(len(names) + 1)))
        return pa.RecordBatch.from_arrays([pa.array(names), *lists], names=["piece", "keys", "n", "t"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append([c.to_numpy() for c in b.columns])
            size += b.num_rows
            if size >= CHUNK and held[0][0][0] != held[-1][0][-1]:
                got = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = int(np.searchsorted(got[0], got[0][-1]))
                yield settle(*(x[:last] for x in got))
                held, size = [[x[last:].copy() for x in got]], len(got[0]) - last
        if size:
            yield settle(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return rows.select("key", "piece", "n", *["t"] * words).repartition("key").sortWithinPartitions("key").mapInArrow(W.tidy(run), MET)


def corpus(docs: DataFrame, trained: Column, keep_text: bool = True) -> DataFrame:
    """Adds ``n_tokens``, ``n_known``, ``base_score``, ``score`` and ``train_tokens`` to all texts, learned from those
    with ``trained``; ``text`` is left out where it isn't kept."""
    results = ("n_tokens", "n_known", "base_score", "score", "train_tokens")
    mark = "_trained"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.coalesce(trained, F.lit(False))).drop(*results)
    mine, back = W.shielded(marked, ("text", mark))
    mine = mine.withColumnRenamed(mark, "_trained")
    named = [c for c in marked.columns if c != mark and (keep_text or c != "text")]
    own = [c for c in mine.columns if c != "_trained" and (keep_text or c != "text")]
    # Places of words, the commonest first, are smaller as plain numbers under zstd than by Parquet's dictionary.
    pieces = bucketed(cut(mine, own), "piece", **{"compression": "zstd", "parquet.enable.dictionary": "false"})
    read = pieces.select("piece", "trained", "sizes", "words", "tokens")

    def together(df: DataFrame, *names: str) -> DataFrame:
        return df.filter(F.col("piece") >= 0).groupBy("piece").agg(*(F.flatten(F.collect_list(c)).alias(a) for c, a in zip(df.columns[1:], names)))

    def statistics(df: DataFrame, many: int) -> list[int]:
        return [x or 0 for x in df.filter(F.col("piece") == STATS).agg(*(F.sum(F.col("n")[k]) for k in range(many))).first()]

    pairs = written(met(by_piece(read, pairs_asked, "piece long, key long, n long")), True, ALONE).select("piece", "keys", "n")
    _, two, one = statistics(pairs, 3)
    discount = one / (one + 2 * two) if one and two else 0.5
    pairs = together(pairs, "keys", "n")
    singles = written(met(by_piece(read.join(pairs, "piece", "left"), words_asked, "piece long, key long, n long, t long")), True, ALONE)
    n, distinct = statistics(singles, 2)
    size = float(n + distinct + 1)
    kinds = T.StructType([*(mine.schema[c] for c in own), *T.StructType.fromDDL(RESULT + ", train_tokens long").fields])

    def walk(row: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        p = settled(row)
        order = np.argsort(p.hashes)
        at = order[np.searchsorted(p.hashes[order], flat(row.column("word")).view(W.U))]
        c, t, b = p.c.copy(), p.t.copy(), p.pairs
        c[at], t[at] = flat(row.column("c")), flat(row.column("t"))
        root = (c + 1) / size
        seen = c[b.v]
        arc = np.where(p.arcs > 0, p.arcs - discount, 0.0)
        step = np.log10(np.where(seen > 0, (arc + discount * t[b.v] * root[b.w]) / np.maximum(seen, 1), root[b.w]))
        columns = [np.diff(p.first), W.sums((c[p.token] > 0).astype(np.int64), p.first), W.sums(np.log10(root)[p.token], p.first), W.sums(step[b.of], p.first),
                   np.full(len(p.first) - 1, n, np.int64)]
        texts = pc.list_flatten(row.column("own")).flatten() if own else []
        yield pa.RecordBatch.from_arrays([*texts, *(pa.array(x) for x in columns)], names=[*own, *results])

    rows = pieces.join(pairs, "piece", "left").join(together(singles, "word", "c", "t"), "piece", "left")
    # Written here, as the size of a batch holds for the step only, not for what callers do with the rows.
    return written(by_piece(rows, walk, kinds), True, ALONE).select(*[b for b, c in zip(back, marked.columns, strict=True) if c in named], *results)
