"""Mixing sources to target weights by balanced sampling (the cube method).

A document of a source is to be taken ``target / source size`` times.  The
whole part of that is taken for certain; the fractional parts are settled by
the cube method: vectors of fractions move through the null space of the
balancing constraints (number of documents and number of words of the source)
until they meet a side of the cube.  Three documents always leave one such
direction, so at most two stay undecided per block.

Blocks are small groups of one source, dealt by a hash of the document, so a
source with a third of all rows is many blocks.  The undecided rest of all
blocks is balanced again in blocks, level by level, until one block per source
is left; its last two documents are the landing problem and take the choice
nearest to the target.  Random choices come from hashes of documents: reruns
agree whatever the partitioning.

Defined results: a null text has size 0 and may be taken any number of times
without changing the mix; null sources are a source of their own, last in
order; rows equal in doc_id, source and size are one unit and are taken
equally often; an empty table gives no rows; without any word all targets are
0.  Other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import join_same, positions
from ..functions.sizes import broadcast_if_small
from ..functions.storage import materialise
from . import words as W

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
BLOCK = 4096


def sized(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Adds ``size``: the words of the whole text."""
    def count(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(np.diff(W.words(batch.column("text"), hashed=False).first).astype(np.int64))]
    return W.add_columns(docs, count, "size long", drop=() if keep_text else ("text",))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target): shares by weight of all words, at most
    ``most`` times the source's size; the excess is shared again by weight."""
    sums = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
            .withColumn("_last", F.col("source").isNull().cast("int")))
    ranked = positions(sums, [], ["_last", "source"], "_rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = materialise(ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("top")))
    rate = float("inf")
    while True:
        free = F.col("weight") * F.lit(rate) < F.col("top")
        if rate == float("inf"):
            free = F.lit(True)
        now = ranked.agg(F.sum("source_size").alias("total"), F.sum(F.when(~free, F.col("top"))).alias("held"),
                         F.sum(F.when(free, F.col("weight"))).alias("free")).first()
        if not now.total or not now.free:
            rate = 0.0 if not now.total else rate
            break
        new = (now.total - (now.held or 0.0)) / now.free
        if new == rate or ranked.filter(free & (F.col("weight") * F.lit(new) > F.col("top"))).isEmpty():
            rate = new
            break
        rate = new
    return ranked.select("source", "source_size", F.least(F.col("top"), F.col("weight") * F.lit(rate)).alias("target"))


def flight(sizes: np.ndarray, part: np.ndarray, dice: np.ndarray) -> np.ndarray:
    """Move fractions until at most two are left; documents and words of the block stay in balance."""
    part = part.copy()
    pool: list[int] = []
    coming = iter(np.flatnonzero((part > 0) & (part < 1)).tolist())
    step = 0
    while True:
        while len(pool) < 3:
            following = next(coming, None)
            if following is None:
                return part
            pool.append(following)
        a, b, c = pool
        u = (sizes[b] - sizes[c], sizes[c] - sizes[a], sizes[a] - sizes[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        scale = max(abs(x) for x in u)
        u = [x / scale for x in u]
        p = [part[a], part[b], part[c]]
        up = min(((1 - q) / x if x > 0 else -q / x) for q, x in zip(p, u, strict=True) if x)
        down = min((q / x if x > 0 else (q - 1) / x) for q, x in zip(p, u, strict=True) if x)
        go = up if dice[step % len(dice)] * (up + down) < down else -down
        step += 1
        for k, x in zip(pool, u, strict=True):
            moved = part[k] + go * x
            part[k] = 0.0 if moved < 1e-9 else 1.0 if moved > 1 - 1e-9 else moved
        pool = [k for k in pool if 0 < part[k] < 1]


def landing(sizes: np.ndarray, part: np.ndarray, goal: float, flips: int = 64) -> np.ndarray:
    """Round the last fractions to the choice nearest to ``goal`` words, then
    exchange single decisions of the block while that comes nearer."""
    part = part.copy()
    left = np.flatnonzero((part > 0) & (part < 1))
    fixed = sizes[(part >= 1)].sum()
    best = min(range(1 << len(left)), key=lambda m: (
        round(abs(fixed + sum(sizes[k] * (m >> i & 1) for i, k in enumerate(left)) - goal), 6),
        abs(sum((m >> i & 1) - part[k] for i, k in enumerate(left)))))
    for i, k in enumerate(left):
        part[k] = best >> i & 1
    miss = goal - sizes[part >= 1].sum()
    for _ in range(flips):
        change = np.where(part >= 1, -sizes, sizes)
        k = int(np.argmin(np.abs(miss - change))) if len(change) else 0
        if not len(change) or abs(miss - change[k]) >= abs(miss) - 0.5:
            break
        miss -= change[k]
        part[k] = 1 - part[k]
    return part


def copies(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """How often each unit (doc_id, source, size, rows, share) is taken: ``copies``."""
    whole = F.floor(F.col("share") + 1e-12)
    state = units.select("doc_id", "source", "size", "rows", whole.cast("int").alias("whole"),
                         F.greatest(F.col("share") - whole, F.lit(0.0)).alias("part"),
                         F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size").alias("_at"))
    done, level = None, 0

    def settle(last: bool):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["size", "_at"], ascending=False, kind="stable", ignore_index=True)
            weight = (rows["size"] * rows["rows"]).to_numpy(float)
            dice = (W.mix(rows["_at"].to_numpy().view(np.uint64) + np.uint64(level + 1)) >> np.uint64(11)).astype(float) / 2.0 ** 53
            start = rows["part"].to_numpy(float)
            part = flight(weight, start, dice)
            rows["part"] = landing(weight, part, float(weight @ start)) if last else part
            return rows.drop(columns="_block")
        return run

    while True:
        per = state.filter("part > 0 and part < 1").groupBy("source").agg(F.count(F.lit(1)).alias("_n"))
        per = per.withColumn("_blocks", F.ceil(F.col("_n") / block))
        deep = per.agg(F.max("_blocks")).first()[0] or 0
        dealt = join_same(state, broadcast_if_small(per), ["source"], "left")
        dealt = dealt.withColumn("_block", F.pmod(F.xxhash64("_at", F.lit(level)), F.greatest(F.coalesce("_blocks", F.lit(1)), F.lit(1))))
        moving = dealt.filter("part > 0 and part < 1").select(*state.columns, "_block")
        fixed = state.filter("part <= 0 or part >= 1")
        done = fixed if done is None else done.unionByName(fixed)
        if not deep:
            break
        state = materialise(moving.groupBy("source", "_block").applyInPandas(settle(deep == 1), state.schema))
        level += 1
    return done.select("doc_id", "source", "size", (F.col("whole") + F.col("part")).cast("int").alias("copies"))


def choose(base: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST,
           block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(targets by source, copies by doc_id, source, size) of rows doc_id, source, size."""
    goal = materialise(targets(base, weights, most))
    units = base.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return goal, copies(join_same(units, broadcast_if_small(goal), ["source"]).withColumn("share", share), block)


def mix(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Adds ``source_size``, ``target``, ``copies`` and ``taken`` to rows with doc_id, source, size."""
    own = [c for c in sizes.columns if c not in ("source_size", "target", "copies", "taken")]
    sizes = materialise(sizes.select(*[F.col(f"`{c}`") for c in own]))
    goal, chosen = choose(sizes.select("doc_id", "source", "size"), weights, most, block)
    out = join_same(sizes, broadcast_if_small(goal), ["source"])
    out = join_same(out, broadcast_if_small(chosen, 2_000_000), ["doc_id", "source", "size"])
    return out.withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    mine, back = W.shielded(docs, ("doc_id", "text", "source"))
    base = materialise(sized(mine, keep_text=False).select("doc_id", "source", "size"))
    taken = materialise(choose(base, weights, most, block)[1]).filter("copies > 0")
    out = join_same(sized(mine), broadcast_if_small(taken, 2_000_000), ["doc_id", "source", "size"])
    return out.withColumn("_copy", F.explode(F.expr("sequence(1, copies)"))).select(*back)
