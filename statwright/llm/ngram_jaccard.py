"""N-gram Jaccard join of all documents, exact, by a size-aware heavy-light join.

A document's set are the hashes of its word n-grams; equal sets are one.  Two
sets of n and m elements with similarity t share at least
c = ceil(t (n + m) / (1 + t)) elements.

*Light* sets enumerate their subsets of c elements for every partner size.
Two sets that meet under a subset key share it, so the key is the proof.

*Heavy* sets go to inverted lists.  The keys of the lists are parts of a set:
the elements fall into k ranges of hashes, and since at most d = n + m - 2c
elements differ, at least k - d of the parts agree.  A part has several
elements, so a passage or line that many documents share makes no long list.
k depends on the size class of the smaller set; a set writes the parts of its
own class and of the class below.  Agreeing parts that are empty count only for
sets with more empty parts than the k - d - 1 that are allowed for.

The boundary between light and heavy is the size that costs least: written
keys plus, for lists, the elements read to check a candidate, over the
histogram of set sizes.

A list is not expanded into pairs.  Its least member is the centre, and each
other member is compared with it (a *star*).  A member that is not linked with
the centre is *far*.  Pairs of members of which at least one is far are looked
for among the members of one centre.  (If neither is far, both hang on the
centre already.)  So no link is lost, near copies of one text cost as many
rows as there are copies, and the components of links come out exact.

Most candidates only share a passage.  They are turned down by *parities*: bit
b of a set tells whether an odd number of its elements end in b.  Each element
in which two sets differ turns one bit, so sets with more unlike bits than
elements in which they may differ are not linked.  This loses nothing, and
takes about a fiftieth of the elements' bytes; the elements themselves travel
only for pairs that pass.

Members of one centre are compared in one task up to a bound.  Beyond it their
pairs are found in the space of differences from the centre by Spark joins:
both differences must share an element, rare elements first, and position
bounds leave few pairs, which are checked exactly.

Keys travel as sorted arrays (one per task and bucket), in which a piece of
text sends each key of each set once.

Defined results: a null text or one without words has an empty set and no
link; a text with fewer words than n has its whole sequence as its only
element; repeated rows and copies share a set; a null doc_id takes part but
names no component (it comes last in order); an empty table gives no rows.
Elements and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import join_same
from ..functions.sizes import broadcast_if_small
from ..functions.storage import written
from . import words as W
from .components import components

CHECK = 4.0
MOST_LIGHT = 24
LARGEST_IDS = 4_000_000
#: Elements of a centre's members that one task may hold; larger groups are joined by Spark.
GROUP_ELEMENTS = 2_000_000
#: Members of a centre, and elements of them all, whose parities one task may compare; larger groups are joined by Spark as well.
GROUP_MEMBERS = 8192
GROUP_PARITIES = 100_000_000
#: Marks, beside a set's size, that it has the larger of a subset key's two sizes.
LARGER = 1 << 15


class Similarity(NamedTuple):
    """Jaccard threshold as a fraction, to compare in whole numbers."""

    num: int
    den: int

    def shared(self, n: int, m: int) -> int:
        """Elements that sets of n and m must share at least."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def least(self, n: int) -> int:
        return -(-self.num * n // self.den)

    def most(self, n: int) -> int:
        return self.den * n // self.num

    def apart(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Elements in which they may differ at most."""
        return n + m - 2 * -(-self.num * (n + m) // (self.num + self.den))


def classes(sim: Similarity, ratio: float = 1.5, top: int = 1 << 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lower bounds, parts, allowed empty parts) of the size classes."""
    low, parts, spare = [1], [], []
    while low[-1] < top:
        end = max(low[-1] + 1, math.ceil(low[-1] * ratio))
        last = end - 1
        both = last + sim.most(last)
        d = max(int(sim.apart(np.int64(s), np.int64(0))) for s in range(max(2 * low[-1], both - 64), both + 1))
        empty = math.exp(-low[-1] / (d + 1)) * (d + 1)
        extra = min(d, math.ceil(empty + 3 * math.sqrt(empty))) if d else 0
        parts.append(d + 1 + extra)
        spare.append(extra)
        low.append(end)
    return np.array(low[:-1], dtype=np.int64), np.array(parts, dtype=np.int64), np.array(spare, dtype=np.int64)


def sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    first, g = W.grams(W.words(column), n)
    return [np.unique(g[a:b]) for a, b in zip(first, first[1:], strict=False)]


def name(s: np.ndarray) -> int:
    """Id of a set."""
    total = W.mix(s ^ W.U(0x5BF03635F0A31C27)).sum(dtype=W.U, keepdims=True) + np.full(1, len(s), W.U) * W.STEP
    return int(W.mix(total).view(np.int64)[0])


def parity(s: np.ndarray) -> np.ndarray:
    """Parities of a set, at least one bit an element, as whole words."""
    bits = 64 << (max(0, len(s) - 1) >> 6).bit_length()
    odd = np.bincount((s & W.U(bits - 1)).view(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(W.U)


def folded(p: np.ndarray, size: int) -> np.ndarray:
    """Rows of parities cut to ``size`` words; what they count stays whole."""
    while p.shape[-1] > size:
        half = p.shape[-1] // 2
        p = p[..., :half] ^ p[..., half:]
    return p


def may_link(p: np.ndarray, q: np.ndarray, n: int, m: np.ndarray, sim: Similarity) -> np.ndarray:
    """Whether the parities let a set of n elements be linked with each of the others (rows of ``q``)."""
    size = min(p.shape[-1], q.shape[-1])
    apart = sim.apart(np.int64(n), m)
    return (np.bitwise_count(folded(p, size) ^ folded(q, size)).sum(axis=-1, dtype=np.int64) <= apart) & (np.abs(n - m) <= apart)


@functools.lru_cache(maxsize=128)
def ranges(which: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(first hash of each further part, what tells the parts of a class apart)."""
    edges = ((np.arange(1, parts, dtype=W.U) << W.U(32)) + W.U(parts - 1)) // W.U(parts)
    return edges << W.U(32), W.mix(np.arange(parts, dtype=W.U) + W.U(which << 32))


def part_keys(s: np.ndarray, total: np.ndarray, which: int, parts: int, spare: int) -> np.ndarray:
    """Keys of the parts of a set in a size class; ``total`` are running sums of its mixed elements."""
    edges, salt = ranges(which, parts)
    cut = np.empty(parts + 1, dtype=np.int64)
    cut[0], cut[1:-1], cut[-1] = 0, np.searchsorted(s, edges), len(s)
    size = np.diff(cut)
    key = W.mix(np.diff(total[cut]) + salt + size.astype(W.U) * W.STEP)
    full = size > 0
    return key[full] if parts - full.sum() <= spare else key


def subset_keys(s: np.ndarray, sim: Similarity, light: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, whether the set is the larger of the two sizes) of the subsets of
    c elements, for every partner size up to ``light``."""
    n, out, larger = len(s), [], []
    mixed = W.mix(s)
    total = mixed.sum(dtype=W.U)
    for m in range(sim.least(n), min(light, sim.most(n)) + 1):
        c = sim.shared(n, m)
        if c > min(n, m):
            continue
        tag = W.mix(np.array([min(n, m) << 16 | max(n, m)], dtype=W.U))[0] ^ W.U(0x6C696768745F5F5F)
        dropped = list(itertools.combinations(range(n), n - c))
        gone = mixed[np.array(dropped, dtype=np.int64).reshape(len(dropped), n - c)].sum(axis=1, dtype=W.U)
        out.append(W.mix(total - gone + tag) & ~W.U(1))
        larger.append(np.full(len(gone), n > m))
    return (np.concatenate(out), np.concatenate(larger)) if out else (np.zeros(0, W.U), np.zeros(0, bool))


def boundary(sizes: dict[int, int], sim: Similarity) -> int:
    """Largest light size: the one with the least cost over the histogram of small sizes."""
    low, parts, _ = classes(sim)

    def light(n: int) -> float:
        return sum(math.comb(n, n - sim.shared(n, m)) for m in range(sim.least(n), sim.most(n) + 1) if sim.shared(n, m) <= min(n, m))

    def heavy(n: int) -> float:
        return parts[np.searchsorted(low, n, side="right") - 1] + parts[np.searchsorted(low, max(1, sim.least(n)), side="right") - 1] + CHECK * n

    best, cost = 0, math.inf
    for x in range(MOST_LIGHT + 1):
        now = sum(k * light(n) for n, k in sizes.items() if n <= x) + sum(k * heavy(n) for n, k in sizes.items() if n >= sim.least(x + 1))
        if now < cost:
            best, cost = x, now
    return best


def members(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, set, n_shingles, parity) of every document."""
    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = sets(batch.column("text"), n)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([name(x) for x in s], pa.int64()), pa.array([len(x) for x in s], pa.int64()),
                                           pa.array([parity(x).tobytes() for x in s], pa.binary())], names=["doc_id", "set", "n_shingles", "parity"])
    return W.map_texts(docs.select("doc_id", "text"), make,
                       f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, set long, n_shingles long, parity binary")


def stars(docs: DataFrame, n: int, sim: Similarity, light: int) -> DataFrame:
    """(centre, member, proven) of all lists with two sets or more."""
    parts_out = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    low, parts, spare = classes(sim)

    def local(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        keys, owner, names, size, seen = [], [], [], [], set()
        for s in sets(batch.column("text"), n):
            me = name(s) if len(s) else 0
            if not len(s) or me in seen:
                continue
            seen.add(me)
            at = 2 * len(names)
            names.append(me)
            size.append(min(len(s), LARGER - 1))
            if len(s) <= light:
                got, larger = subset_keys(s, sim, light)
                keys.append(got)
                owner.append(at + larger.astype(np.int64))
            if sim.most(len(s)) > light:
                own = int(np.searchsorted(low, len(s), side="right") - 1)
                below = int(np.searchsorted(low, max(1, sim.least(len(s))), side="right") - 1)
                total = np.zeros(len(s) + 1, dtype=W.U)
                np.cumsum(W.mix(s), out=total[1:])
                got = np.concatenate([part_keys(s, total, c, int(parts[c]), int(spare[c])) for c in range(below, own + 1)]) | W.U(1)
                keys.append(got)
                owner.append(np.full(len(got), at, np.int64))
        if not keys:
            return None
        key, own = np.concatenate(keys), np.concatenate(owner)
        del keys, owner
        order = np.argsort(key, kind="stable")
        key, own = key[order], own[order]
        cut = np.searchsorted(key, np.array([(b << 64) // parts_out for b in range(1, parts_out)], dtype=W.U))
        first = np.concatenate([[0], cut, [len(key)]])
        named, sized, rows = np.array(names, dtype=np.int64), np.array(size, dtype=np.uint16), []
        for b, (a, z) in enumerate(zip(first, first[1:], strict=False)):
            if z > a:
                # A set's id and size travel once per bucket; its keys only name its place among them.
                here, place = np.unique(own[a:z] >> 1, return_inverse=True)
                place = place << 1 | own[a:z] & 1
                rows.append((b, key[a:z].tobytes(), place.astype(np.uint16 if len(here) < 1 << 15 else np.uint32).tobytes(),
                             named[here].tobytes(), sized[here].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2, 3, 4))],
                                          names=["bucket", "keys", "places", "sets", "sizes"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(got: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            key, own, num = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((own, num, key))
            key, own, num = key[order], own[order], num[order]
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (own[1:] != own[:-1])])
            key, own, num = key[new], own[new], num[new]
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            centre = np.repeat(head, np.diff(np.concatenate([head, [len(key)]])))
            # The centre is the smallest set.  A subset key proves a link only where the smaller of its two sizes takes part.
            at = np.flatnonzero((own != own[centre]) & (num[centre] < LARGER))
            c, m, proven = own[centre[at]], own[at], (key[at] & W.U(1)) == 0
            link = np.unique(np.stack([c, m, proven.astype(np.int64)]), axis=1) if len(c) else np.zeros((3, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(link[0]), pa.array(link[1]), pa.array(link[2].astype(bool))], names=["centre", "member", "proven"])

        bucket, got = None, []
        for batch in batches:
            for b, *data in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "places", "sets", "sizes")), strict=True):
                if b != bucket and got:
                    yield from out(got)
                    got = []
                bucket = b
                key, named, sized = (np.frombuffer(x, t) for x, t in zip((data[0], data[2], data[3]), (W.U, np.int64, np.uint16), strict=True))
                place = np.frombuffer(data[1], np.uint16 if 4 * len(data[1]) == len(data[0]) else np.uint32)
                got.append((key, named[place >> 1], sized[place >> 1] | (place & 1).astype(np.uint16) << np.uint16(15)))
        if got:
            yield from out(got)

    sent = W.map_texts(docs.select("text"), local, "bucket int, keys binary, places binary, sets binary, sizes binary")
    listed = sent.repartition(parts_out, "bucket").sortWithinPartitions("bucket").mapInArrow(W.tidy(merge), "centre long, member long, proven boolean")
    return listed.groupBy("centre", "member").agg(F.max("proven").alias("proven"))


def elements(docs: DataFrame, member: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(set, items) of the wanted sets, from one document of each."""
    ids = member.filter("doc_id is not null").groupBy("set").agg(F.min("doc_id").alias("doc_id")).join(wanted, "set", "left_semi")
    spare = member.filter("doc_id is null").select("set").distinct().join(wanted, "set", "left_semi").join(ids, "set", "left_anti")
    chosen = docs.select("doc_id", "text").join(broadcast_if_small(ids, LARGEST_IDS), "doc_id")
    if not spare.isEmpty():
        chosen = chosen.select("doc_id", "text", "set").unionByName(
            docs.filter("doc_id is null").select("doc_id", "text").withColumn("set", F.lit(None).cast("long")))
    wanted_ids = chosen.select("set", "text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = sets(batch.column("text"), n)
        own = [name(x) if k is None else k for k, x in zip(batch.column("set").to_pylist(), s, strict=True)]
        keep = [i for i, (k, x) in enumerate(zip(own, s, strict=True)) if len(x) and k == name(x)]
        first = np.concatenate([[0], np.cumsum([len(s[i]) for i in keep])]).astype(np.int64)
        flat = np.concatenate([s[i] for i in keep]) if keep else np.zeros(0, W.U)
        return pa.RecordBatch.from_arrays([pa.array([own[i] for i in keep], pa.int64()), W.lists(flat, first)], names=["set", "items"])
    return W.map_texts(wanted_ids, make, "set long, items array<long>").join(broadcast_if_small(wanted, LARGEST_IDS), "set", "left_semi")


def linked(pairs: DataFrame, items: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (centre, member) that are similar enough, row by row: no batch of many sets is held."""
    both = pairs.join(items.withColumnsRenamed({"set": "member", "items": "mine"}), "member").join(
        items.withColumnsRenamed({"set": "centre", "items": "theirs"}), "centre")
    shared = F.size(F.array_intersect("theirs", "mine")).cast("long")
    return both.filter(shared * (sim.num + sim.den) >= (F.size("theirs") + F.size("mine")).cast("long") * sim.num).select("centre", "member")


def compared(pairs: DataFrame, items: DataFrame, sim: Similarity) -> DataFrame:
    """(centre, member, n_centre, n_member, far, diff): the elements in which the two differ."""
    both = pairs.join(items.withColumnsRenamed({"set": "member", "items": "mine"}), "member").join(
        items.withColumnsRenamed({"set": "centre", "items": "theirs"}), "centre")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (lists_of(batch.column(c)) for c in ("theirs", "mine"))
            diff = [np.setxor1d(x, y, assume_unique=True) for x, y in zip(a, b, strict=True)]
            na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
            size = np.array([len(x) for x in diff])
            far = size > sim.apart(na, nb)
            first = np.concatenate([[0], np.cumsum(size)])
            flat = np.concatenate(diff) if len(diff) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("centre"), batch.column("member"), pa.array(na, pa.int64()), pa.array(nb, pa.int64()),
                                              pa.array(far), W.lists(flat.view(W.U), first)],
                                             names=["centre", "member", "n_centre", "n_member", "far", "diff"])
    return both.select("centre", "member", "theirs", "mine").mapInArrow(
        run, "centre long, member long, n_centre long, n_member long, far boolean, diff array<long>")


def plausible(pairs: DataFrame, traits: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (centre, member) whose parities let them be linked."""
    both = pairs.join(traits.toDF("member", "m", "mine"), "member").join(traits.toDF("centre", "n", "theirs"), "centre")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            p, q = (batch.column(c).to_pylist() for c in ("theirs", "mine"))
            keep = [bool(may_link(np.frombuffer(a, W.U), np.frombuffer(b, W.U), x, y, sim)) for a, b, x, y in zip(p, q, n, m, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("centre"), batch.column("member")], names=["centre", "member"]).filter(pa.array(keep, pa.bool_()))
    return both.select("centre", "member", "n", "m", "theirs", "mine").mapInArrow(W.tidy(run), "centre long, member long")


def lists_of(column: pa.Array) -> list[np.ndarray]:
    flat, off = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    off = off - off[0]
    return [flat[a:b] for a, b in zip(off, off[1:], strict=False)]


def beyond_centres(docs: DataFrame, n: int, member: DataFrame, traits: DataFrame, star: DataFrame, root: DataFrame, sim: Similarity,
                   group_elements: int = GROUP_ELEMENTS) -> DataFrame:
    """(a, b): links between members of a list of which at least one is far
    from its centre, and that ``root`` has not joined yet."""
    placed = star.join(broadcast_if_small(root.withColumnRenamed("node", "member"), LARGEST_IDS), "member", "left").withColumn(
        "root", F.coalesce("root", "member")).join(traits.select(F.col("set").alias("member"), F.col("n").alias("n_member")), "member")
    groups = written(placed.groupBy("centre").agg(F.max("far").alias("some"), F.min("root").alias("one"), F.max("root").alias("other"),
                                                  F.count(F.lit(1)).alias("rows"), F.sum("n_member").alias("total")).filter("some and one <> other").select(
        "centre", ((F.col("rows") > GROUP_MEMBERS) | (F.col("total") > GROUP_PARITIES)).alias("wide")))
    rows = placed.join(broadcast_if_small(groups, LARGEST_IDS), "centre")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = ["centre", "member", "root", "far"]
    close = rows.filter("not wide").select(*kept, "n_member").join(traits.select(F.col("set").alias("member"), "parity"), "member")
    close = written(close.repartition(parts, "centre").sortWithinPartitions("centre", "member").mapInArrow(
        functools.partial(_by_group, functools.partial(group_candidates, sim)), "centre long, member long, root long, far boolean, n_member long"))
    full = close.groupBy("centre").agg((F.sum("n_member") > group_elements).alias("wide"))
    close = close.join(full, "centre")
    small = close.filter("not wide").select(*kept)
    items = elements(docs, member, small.select(F.col("member").alias("set")).distinct(), n).withColumnRenamed("set", "member")
    near = small.join(items, "member").repartition(parts, "centre").sortWithinPartitions("centre", "member").mapInArrow(
        functools.partial(_by_group, functools.partial(group_links, sim)), "a long, b long")
    wide = written(rows.filter("wide").select(*kept).unionByName(close.filter("wide").select(*kept)))
    if wide.isEmpty():
        return near
    ends = wide.select(F.col("centre").alias("set")).union(wide.select("member")).distinct()
    diff = compared(wide.select("centre", "member"), written(elements(docs, member, ends, n)), sim).drop("far")
    return near.unionByName(_wide_groups(written(diff.join(wide, ["centre", "member"])), sim))


def _by_group(make: Callable[[list[pa.RecordBatch]], pa.RecordBatch], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of bounded size, one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        centre = batch.column("centre").to_numpy()
        if not len(centre):
            continue
        cuts = [0, *(np.flatnonzero(np.diff(centre)) + 1).tolist(), len(centre)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            if held and held[0].column("centre")[0].as_py() != centre[a]:
                yield make(held)
                held = []
            held.append(batch.slice(a, z - a))
    if held:
        yield make(held)


def unsettled(parities: list[np.ndarray], n: np.ndarray, root: np.ndarray, far: np.ndarray, sim: Similarity) -> Iterator[tuple[int, np.ndarray]]:
    """(a far member, the members it may be linked with) where the roots differ and the first is far, each pair once."""
    words = np.array([len(p) for p in parities])
    levels = [(np.flatnonzero(words == size), np.stack([p for p in parities if len(p) == size])) for size in np.unique(words).tolist()]
    for y in np.flatnonzero(far).tolist():
        found = []
        for at, q in levels:
            use = np.flatnonzero((root[at] != root[y]) & (~far[at] | (at > y)) & (np.abs(n[at] - n[y]) <= sim.apart(n[y], n[at])))
            found.append(at[use[may_link(parities[y], q[use], n[y], n[at[use]], sim)]])
        x = np.concatenate(found) if found else np.zeros(0, np.int64)
        if len(x):
            yield y, x


def group_candidates(sim: Similarity, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The members of one centre that take part in a pair which the parities allow."""
    t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    root, n, far = (t.column(c).to_numpy(zero_copy_only=False) for c in ("root", "n_member", "far"))
    parities = [np.frombuffer(p, W.U) for p in t.column("parity").to_pylist()]
    used = np.zeros(len(n), dtype=bool)
    for y, x in unsettled(parities, n, root, far, sim):
        used[y] = used[x] = True
    return t.select(["centre", "member", "root", "far", "n_member"]).filter(pa.array(used))


def group_links(sim: Similarity, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Links that join different roots in one group of a centre."""
    t = pa.Table.from_batches(held).combine_chunks()
    items = [x for c in t.column("items").chunks for x in lists_of(c)]
    member, root, far = (t.column(c).to_numpy() for c in ("member", "root", "far"))
    n = np.array([len(x) for x in items], dtype=np.int64)
    up: dict[int, int] = {}

    def top(r: int) -> int:
        while up.get(r, r) != r:
            up[r] = up.get(up[r], up[r])
            r = up[r]
        return r

    a, b = [], []
    for y, xs in unsettled([parity(x.view(W.U)) for x in items], n, root, far, sim):
        for x in xs.tolist():
            ry, rx = top(int(root[y])), top(int(root[x]))
            if ry != rx and len(np.setxor1d(items[y], items[x], assume_unique=True)) <= sim.apart(n[y], n[x]):
                up[max(ry, rx)] = min(ry, rx)
                a.append(int(member[y]))
                b.append(int(member[x]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _wide_groups(rows: DataFrame, sim: Similarity) -> DataFrame:
    """The same for groups beyond the bound, as joins on shared rare elements."""
    own = rows.select("centre", "member", "root", "far", F.col("n_member").alias("n"), F.size("diff").alias("size"), F.explode("diff").alias("e"))
    often = own.groupBy("centre", "e").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # Elements of one member only can't be shared; those before a shared one still count as places.
    ranked = own.join(often, ["centre", "e"], "left").groupBy("centre", "member", "root", "far", "n", "size").agg(
        F.sort_array(F.collect_list(F.when(F.col("often").isNotNull(), F.struct("often", "e")))).alias("es"))
    ranked = ranked.select("centre", "member", "root", "far", "n", "size", (F.col("size") - F.size("es")).alias("alone"), F.posexplode("es").alias("p", "s"))
    spot = ranked.select("centre", "member", "root", "far", "n", "size", (F.col("p") + F.col("alone")).alias("at"), F.col("s.e").alias("e"))
    reach = F.expr(f"{sim.den - sim.num} * n div {sim.num}")
    # A far member shares more than half of what its partner differs in, but for sizes above the centre's and rounding.
    half = F.col("at") * 2 * (sim.num + sim.den) <= F.col("size") * 2 * sim.den + 2 * (sim.num + sim.den)
    probe = spot.filter(F.col("far") & (F.col("at") <= reach)).select(*[F.col(c).alias(f"y_{c}") for c in ("centre", "e", "member", "root", "n", "size", "at")])
    index = spot.filter(half).select(*[F.col(c).alias(f"x_{c}") for c in ("centre", "e", "member", "root", "n", "size", "at", "far")])
    most = F.expr(f"x_n + y_n - 2 * (({sim.num} * (x_n + y_n) + {sim.num + sim.den - 1}) div {sim.num + sim.den})")
    apart = F.expr("x_at + y_at + abs((x_size - x_at) - (y_size - y_at))")
    pairs = index.join(probe, [F.expr("x_centre = y_centre"), F.expr("x_e = y_e"), F.expr("x_root <> y_root"),
                               F.expr("not x_far or x_member < y_member"), apart <= most])
    return _checked(pairs.select(F.col("x_centre").alias("centre"), "x_member", "y_member").distinct(), rows, sim)


def _checked(pairs: DataFrame, rows: DataFrame, sim: Similarity) -> DataFrame:
    """Pairs whose differences from the centre say that they are linked."""
    side = rows.select("centre", "member", "n_member", "diff")
    both = pairs.join(side.withColumnsRenamed({"member": "x_member", "n_member": "x_n", "diff": "x"}), ["centre", "x_member"]).join(
        side.withColumnsRenamed({"member": "y_member", "n_member": "y_n", "diff": "y"}), ["centre", "y_member"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = np.array([len(np.setxor1d(x, y, assume_unique=True)) for x, y in
                          zip(lists_of(batch.column("x")), lists_of(batch.column("y")), strict=True)], dtype=np.int64)
            keep = pa.array(d <= sim.apart(batch.column("x_n").to_numpy(), batch.column("y_n").to_numpy()))
            yield pa.RecordBatch.from_arrays([batch.column("x_member"), batch.column("y_member")], names=["a", "b"]).filter(keep)
    return both.select("x_member", "y_member", "x_n", "y_n", "x", "y").mapInArrow(W.tidy(run), "a long, b long").distinct()


def ngram_components(docs: DataFrame, n: int = 5, similarity: tuple[int, int] = (4, 5), light: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id): the least doc_id that links reach."""
    sim = Similarity(*similarity)
    docs = docs.select("doc_id", "text")
    member = written(members(docs, n))
    if light is None:
        sizes = member.filter(f"n_shingles > 0 and n_shingles <= {sim.most(MOST_LIGHT + 1)}").groupBy("n_shingles").agg(F.countDistinct("set").alias("k"))
        light = boundary({r.n_shingles: r.k for r in sizes.collect()}, sim)
    listed = written(stars(docs, n, sim, light))
    proven = listed.filter("proven").select(F.col("centre").alias("a"), F.col("member").alias("b"))
    open_pairs = listed.filter("not proven").select("centre", "member")
    listed_sets = listed.select(F.col("centre").alias("set")).union(listed.select("member")).distinct()
    traits = written(member.join(listed_sets, "set", "left_semi").groupBy("set").agg(F.first("n_shingles").alias("n"), F.first("parity").alias("parity")))
    candidates = written(plausible(open_pairs, traits, sim))
    wanted = candidates.select(F.col("centre").alias("set")).union(candidates.select("member")).distinct()
    near = written(linked(candidates, written(elements(docs, member, wanted, n)), sim).distinct())
    root = written(components(proven.unionByName(near.toDF("a", "b"))))
    # A pair that a subset key proves may also share a list with others, so it stays a member of the star.
    star = listed.join(near.withColumn("near", F.lit(True)), ["centre", "member"], "left").select(
        "centre", "member", (~F.col("proven") & F.col("near").isNull()).alias("far"))
    more = written(beyond_centres(docs, n, member, traits, star, root, sim))
    if not more.isEmpty():
        root = components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    placed = member.drop("parity").join(broadcast_if_small(root.withColumnRenamed("node", "set"), LARGEST_IDS), "set", "left").withColumn(
        "root", F.coalesce("root", "set"))
    full = placed.filter("n_shingles > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = placed.join(broadcast_if_small(full, LARGEST_IDS), "root", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def deduplicate(docs: DataFrame, n: int = 5, similarity: tuple[int, int] = (4, 5)) -> DataFrame:
    """One document of each component, the one with the least doc_id.  Rows
    with the same doc_id are one document, of which the row with the least text
    (then the least JSON form) stays; documents without words or without doc_id stay."""
    found = written(ngram_components(docs, n, similarity).filter("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")))
    kept = join_same(docs, broadcast_if_small(found.select("doc_id"), LARGEST_IDS), ["doc_id"], "left_semi")
    if not found.filter("rows > 1").isEmpty():
        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        kept = kept.groupBy("doc_id").agg(F.min_by(row, F.struct("text", F.to_json(row))).alias("_row")).select("_row.*")
    return kept.unionByName(docs.filter("doc_id is null"))
