"""Benchmark decontamination with a generalised suffix automaton.

The normalised test items become one automaton: every run of item words is a
path, and each state knows the items that hold it.  A training text is
streamed through it word by word; the state and the matched length say the
longest run of item words that ends at each word.  Runs of ``window`` words or
more are hits, and so is a whole shorter item.  Words that are not part of any
three-word run of an item can't lengthen a match to a hit, so the stream only
walks over stretches of words where such runs follow each other in one text.

Items are taken in blocks of at most ``MAX_WORDS`` words with one automaton
each, so the size of what is broadcast is bounded; more items mean more passes
over the texts, never a larger automaton.

Defined results: a null or empty text has no words and no hits; items without
words are ignored; repeated items count once per row; repeated documents are
judged alike; an empty table of either kind gives documents without hits;
item ids may be of any type that can be ordered; other columns are kept, those
named like a result are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

MAX_WORDS = 2_000_000
GATE_BITS = 20
RESULT = "n_words long, n_hit long, items array<{}>, spans array<struct<start:int,end:int>>"


class Automaton:
    """Generalised suffix automaton over word hashes, with item sets at window length."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int) -> None:
        self.window = window
        self.arcs: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, seq in items:
            last = 0
            for word in seq:
                last = self._extend(last, word)
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        self.least = min([window, *(len(seq) for _, seq in items if seq)])
        for item, seq in items:
            if not seq:
                continue
            size, state = min(window, len(seq)), 0
            for i, word in enumerate(seq):
                state = self.arcs[state][word]
                if i + 1 >= size:
                    while self.length[self.link[state]] >= size:
                        state = self.link[state]
                    if len(seq) < window:
                        self.short.setdefault(state, []).append((len(seq), item))
                    else:
                        self.items.setdefault(state, set()).add(item)
        self.run = min(3, self.least)

    def _add(self, length: int, link: int, arcs: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.arcs.append(arcs)
        return len(self.length) - 1

    def _split(self, state: int, word: int) -> int:
        """The state for the longest suffix of ``state`` followed by ``word``."""
        old = self.arcs[state][word]
        if self.length[old] == self.length[state] + 1:
            return old
        new = self._add(self.length[state] + 1, self.link[old], dict(self.arcs[old]))
        self.link[old] = new
        while state != -1 and self.arcs[state].get(word) == old:
            self.arcs[state][word] = new
            state = self.link[state]
        return new

    def _extend(self, last: int, word: int) -> int:
        if word in self.arcs[last]:
            return self._split(last, word)
        new, state = self._add(self.length[last] + 1, 0, {}), last
        while state != -1 and word not in self.arcs[state]:
            self.arcs[state][word] = new
            state = self.link[state]
        self.link[new] = 0 if state == -1 else self._split(state, word)
        return new

    def stream(self, seq: list[int], hit: np.ndarray, at: int) -> set[int]:
        """Walk over words; marks hit words in ``hit`` from position ``at`` on and returns the items met."""
        found: set[int] = set()
        state, size = 0, 0
        arcs, link, length, window = self.arcs, self.link, self.length, self.window
        for i, word in enumerate(seq, at + 1):
            following = arcs[state].get(word)
            while following is None and state:
                state = link[state]
                size = length[state]
                following = arcs[state].get(word)
            if following is None:
                continue
            state, size = following, size + 1
            if size >= window:
                hit[i - size:i] = True
                t = state
                while length[link[t]] >= window:
                    t = link[t]
                found |= self.items.get(t, set())
            if self.short:
                t = state
                while t > 0:
                    for n, item in self.short.get(t, ()):
                        if n <= size:
                            hit[i - n:i] = True
                            found.add(item)
                    t = link[t]
        return found


def gate_of(w: W.Words, n: int) -> np.ndarray:
    """Hashes of the runs of n words, by first word; zero where a text ends before."""
    out = np.zeros(len(w.hashes), dtype=W.U)
    if len(w.hashes) >= n:
        run = np.full(len(w.hashes) - n + 1, n, dtype=W.U)
        for k in range(n):
            run = W.follow(run, w.hashes[k:len(w.hashes) - n + 1 + k])
        out[:len(run)] = run
        for k in range(1, n):
            cut = w.first[1:-1] - k
            out[cut[(cut >= 0)]] = 0
    return out


def item_blocks(items: DataFrame, max_words: int = MAX_WORDS) -> list[list[tuple[int, list[int]]]]:
    """Normalised items in blocks of at most ``max_words`` words, streamed to the driver block by block."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = W.words(batch.column("text"), W.NOT_ALNUM)
        return pa.RecordBatch.from_arrays([batch.column("item_id"), W.lists(w.hashes, w.first)], names=["item_id", "seq"])
    rows = W.map_texts(items.select("item_id", "text"), run, f"item_id {items.schema['item_id'].dataType.simpleString()}, seq array<long>")
    out: list[list[tuple[int, list[int]]]] = [[]]
    size = 0
    for r in rows.orderBy("item_id").toLocalIterator():
        if size + len(r.seq) > max_words and out[-1]:
            out.append([])
            size = 0
        size += len(r.seq)
        out[-1].append((r.item_id, [x & 0xFFFFFFFFFFFFFFFF for x in r.seq]))
    return out


def scan(docs: DataFrame, block: list[tuple[int, list[int]]], window: int, ids: DataFrame) -> DataFrame:
    """Adds the hits of one block of items to the documents; ``ids`` has the type of their item_id."""
    id_type, arrow_type = ids.schema["item_id"].dataType.simpleString(), ids.select("item_id").limit(0).toArrow().schema.field(0).type
    machine = Automaton(block, window)
    runs = set()
    for _, seq in block:
        h = np.array(seq, dtype=W.U)
        if len(h) >= machine.run:
            one = W.Words(np.array([0, len(h)]), h, h, h, h, h)
            runs.update(gate_of(one, machine.run)[:len(h) - machine.run + 1].tolist())
    runs = np.array(sorted(runs), dtype=W.U)
    table = np.zeros(1 << GATE_BITS, dtype=bool)
    table[(runs & W.U((1 << GATE_BITS) - 1)).astype(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast((machine, runs, table))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        machine, runs, table = shared.value
        w = W.words(batch.column("text"), W.NOT_ALNUM)
        n, rows = machine.run, batch.num_rows
        hits, met, spans = np.zeros(rows, np.int64), [[] for _ in range(rows)], [[] for _ in range(rows)]
        if len(runs):
            key = gate_of(w, n)
            maybe = np.flatnonzero(table[(key & W.U((1 << GATE_BITS) - 1)).astype(np.int64)])
            place = np.minimum(np.searchsorted(runs, key[maybe]), len(runs) - 1)
            live = maybe[runs[place] == key[maybe]]
            holder = np.searchsorted(w.first, live, side="right") - 1
            cut = np.flatnonzero((np.diff(live) != 1) | (np.diff(holder) != 0))
            at = np.concatenate([[0], cut + 1]) if len(live) else cut
            heads, tails, owner = live[at], live[np.concatenate([cut, [-1]])] if len(live) else live, holder[at]
            long = tails - heads + n >= machine.least
            marked: dict[int, np.ndarray] = {}
            for a, b, i in zip(heads[long].tolist(), (tails + n)[long].tolist(), owner[long].tolist(), strict=True):
                start = int(w.first[i])
                hit = marked.setdefault(i, np.zeros(int(w.first[i + 1]) - start, dtype=bool))
                met[i] = set(met[i]) | machine.stream(w.hashes[a:b].tolist(), hit, a - start)
            for i, hit in marked.items():
                hits[i] = hit.sum()
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                base = int(w.first[i])
                spans[i] = [{"start": int(w.starts[base + a] - w.bounds[i]), "end": int(w.ends[base + b - 1] - w.bounds[i])}
                            for a, b in zip(edge[::2], edge[1::2], strict=True)]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return [pa.array(np.diff(w.first).astype(np.int64)), pa.array(hits),
                pa.array([sorted(x, key=lambda v: (v is not None, v)) for x in met], pa.list_(arrow_type)), pa.array(spans, kind)]

    return W.add_columns(docs, make, RESULT.format(id_type))


def hits(docs: DataFrame, items: DataFrame, window: int = 10, max_words: int = MAX_WORDS) -> DataFrame:
    """Adds ``n_words``, ``n_hit``, ``items`` and ``spans`` (byte ranges of hit words).

    With one block of items this is one pass without a shuffle.  With more,
    every further block scans the texts again and merges its hits by row.
    """
    blocks = item_blocks(items, max_words)
    out = scan(docs, blocks[0], window, items)
    for block in blocks[1:]:
        first = out.withColumnsRenamed({"items": "_items", "spans": "_spans"})
        more = scan(first, block, window, items)
        out = more.withColumns({"items": F.concat("_items", "items"), "spans": F.concat("_spans", "spans")}).drop("_items", "_spans")
        out = merged_spans(out)
    return out


def merged_spans(df: DataFrame) -> DataFrame:
    """Joins overlapping spans of several blocks and counts their words again."""
    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        w = W.words(batch.column("text"), W.NOT_ALNUM, hashed=False)
        counts, rows = [], []
        for i, spans in enumerate(batch.column("spans").to_pylist()):
            out: list[dict] = []
            for s in sorted(spans, key=lambda s: s["start"]):
                if out and s["start"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], s["end"])
                else:
                    out.append(s)
            starts = w.starts[w.first[i]:w.first[i + 1]] - w.bounds[i]
            counts.append(sum(int(np.searchsorted(starts, s["end"]) - np.searchsorted(starts, s["start"])) for s in out))
            rows.append(out)
        return [pa.array(counts, pa.int64()), pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
    return W.add_columns(df, make, "n_hit long, spans array<struct<start:int,end:int>>", reads=("spans",))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, coverage: float = 0.5,
                  max_words: int = MAX_WORDS) -> DataFrame:
    """The documents with hit spans cut out of their texts (a blank stays
    between the rest); a document with more than ``coverage`` of its words hit
    is dropped.  ``n_chars``, if there is one, is counted again."""
    mine, back = W.shielded(docs, ("text", "n_chars"))
    found = hits(mine, items, window, max_words).filter(F.col("n_hit") <= F.col("n_words") * coverage)

    # By DataFrame functions: a second Python step in the stage would keep a second worker for every core.
    raw, spans = F.col("text").cast("binary"), F.col("spans")

    def rest(i):
        start = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0)
        end = F.when(i < F.size(spans), F.get(spans, i)["start"]).otherwise(F.octet_length("text"))
        return F.substring(raw, start + 1, end - start).cast("string")

    cut = F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), rest), " ")
    clean = found.withColumn("text", F.when(F.size(spans) > 0, cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*back)
