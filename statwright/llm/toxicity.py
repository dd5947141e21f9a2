"""Toxicity from a learned lexicon, matched with Levenshtein automata.

Labelled texts give the lexicon: words and word stems whose documents are
nearly always toxic.  A stem stands for all words that begin with it, so it
covers compounds that no label has shown; learned words stay beside it for
their misspellings.  The terms form a trie; its
intersection with the Levenshtein automata of its terms (one edit, for terms of
five letters or more) is one machine whose states are sets of (trie node,
edits).  Its transitions are made when a word first needs them and kept, so
every distinct word is read once, letter by letter, and most die early.

Each hit is seen in its window of words: a term inside quotation marks or
after a reporting word counts as quoted, otherwise as direct.  The four counts
(exact or misspelt, direct or quoted), with the share of hits among the words,
are the only inputs of the score: a document's probability is the smoothed
share of toxic documents with the same inputs among the labelled ones, backed
off to a logistic model of the counts where few labels have them.

Defined results: a null or empty text has no hits and the score of texts
without hits; repeated rows are scored alike; without labels the lexicon is
empty and the prior 0.5 makes no text toxic (``predicted`` 0); an empty table
gives no rows; other columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizes import broadcast_if_small
from . import words as W

#: Labelled rows the lexicon and the weights are learned from, at most; chosen by a hash of doc_id.
MAX_LABELS = 200_000
STEMS = (4, 5, 6, 7)
FUZZY_FROM = 5
PRECISION = 0.9
CONTEXT = 4
LETTERS = re.compile(r"[^\W_]+")
#: Words that report what somebody else says.
REPORTING = frozenset("said says saying wrote called calls quoted quote told dit dijo sagte schrieb escribió écrit".split())
QUOTES = "\"“”„«»‹›"


def weigh(toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """Lower bound of the share of toxic documents (Wilson, 95 %)."""
    n = np.maximum(toxic + clean, 1)
    p, z = toxic / n, 1.96
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def terms_of(text: str) -> set[str]:
    """Words and stems (marked by a final star) of a text."""
    out: set[str] = set()
    for word in set(LETTERS.findall((text or "").lower())):
        out.add(word)
        out.update(word[:k] + "*" for k in STEMS if len(word) > k)
    return out


def labelled(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """(text, toxic) of at most ``max_labels`` labelled documents."""
    few = (labels.filter("toxic is not null and doc_id is not null").select("doc_id", "toxic").distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labels))
    return docs.select("doc_id", "text").join(broadcast_if_small(few), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def learn_terms(train: DataFrame, least: int = 4, precision: float = PRECISION) -> dict[str, tuple[int, int]]:
    """Lexicon: term to (toxic, clean) documents.  Terms are counted in toxic
    documents first; only those frequent enough are counted in the others."""
    def count(rows: DataFrame, wanted=None) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: Counter[str] = Counter()
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    found = terms_of(text)
                    seen.update(found & wanted.value if wanted is not None else found)
                if len(seen) > 500_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])
                    seen = Counter()
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])
        return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    some = train.agg(F.count_if(F.expr("toxic = 1")).alias("bad"), F.count_if(F.expr("toxic = 0")).alias("good")).first()
    if not some.bad:
        return {}
    enough = max(least, math.ceil(some.bad * 0.002))
    bad = {r.term: r.n for r in count(train.filter("toxic = 1")).filter(F.col("n") >= enough).collect()}
    shared = train.sparkSession.sparkContext.broadcast(set(bad))
    good = {r.term: r.n for r in count(train.filter("toxic = 0"), shared).collect()}
    names = sorted(bad)
    sure = weigh(np.array([bad[t] for t in names], float), np.array([good.get(t, 0) for t in names], float) if names else np.zeros(0))
    prior = some.bad / (some.bad + some.good)
    kept = {t for t, s in zip(names, sure, strict=True)
            if bad[t] / (bad[t] + good.get(t, 0)) >= precision and s >= prior + 0.4 * (1 - prior)}
    # A stem that one word explains gives way to the word, which may also be misspelt.
    whole = {}
    for t in bad:
        for k in STEMS if not t.endswith("*") else ():
            whole[t[:k] + "*"] = max(whole.get(t[:k] + "*", 0), bad[t])
    kept = {t for t in kept if not t.endswith("*") or bad[t] >= 1.25 * whole.get(t, 0)}
    stems = {t[:-1] for t in kept if t.endswith("*")}

    # A stem covers the words that begin with it, but not their misspellings; words long enough to be misspelt stay beside it.
    def covered(t: str) -> bool:
        name = t.rstrip("*")
        if name == t and len(name) >= FUZZY_FROM:
            return False
        return any(name[:k] in stems and name[:k] + "*" != t for k in STEMS if k < len(name) or (k == len(name) and not t.endswith("*")))
    return {t: (bad[t], good.get(t, 0)) for t in kept if not covered(t)}


class Machine:
    """Trie of terms intersected with their Levenshtein automata, determinised as words need it."""

    def __init__(self, terms: list[str]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.end: list[int] = [0]
        self.fuzzy: list[bool] = [False]
        for term in sorted(terms):
            name, node = term.rstrip("*"), 0
            for c in name:
                if c not in self.children[node]:
                    self.children.append({})
                    self.end.append(0)
                    self.fuzzy.append(False)
                    self.children[node][c] = len(self.end) - 1
                if len(name) >= FUZZY_FROM and not term.endswith("*"):
                    self.fuzzy[node] = True
                node = self.children[node][c]
            self.end[node] |= 2 if term.endswith("*") else 1
            if len(name) >= FUZZY_FROM and not term.endswith("*"):
                self.fuzzy[node] = True
                self.end[node] |= 4
        self.sets: list[frozenset[tuple[int, int]]] = []
        self.names: dict[frozenset[tuple[int, int]], int] = {}
        self.next: list[dict[str, int]] = []
        self.verdict: list[tuple[int, int]] = []
        self.start = self._state({(0, 0)})
        self.known: dict[str, int] = {}

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """State of a set of (node, edits), closed under letters missing in the word."""
        closed, work = set(pairs), list(pairs)
        while work:
            node, edits = work.pop()
            if edits == 0 and self.fuzzy[node]:
                for child in self.children[node].values():
                    if self.fuzzy[child] and (child, 1) not in closed:
                        closed.add((child, 1))
                        work.append((child, 1))
        key = frozenset(closed)
        if key not in self.names:
            self.names[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            stem = any(e == 0 and self.end[n] & 2 for n, e in key)
            last = 1 if any(e == 0 and self.end[n] & 1 for n, e in key) else 2 if any(e == 1 and self.end[n] & 4 for n, e in key) else 0
            self.verdict.append((int(stem), last))
        return self.names[key]

    def _step(self, state: int, c: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, edits in self.sets[state]:
            child = self.children[node].get(c)
            if child is not None and (edits == 0 or self.fuzzy[child]):
                out.add((child, edits))
            if edits == 0 and self.fuzzy[node]:
                out.add((node, 1))
                out.update((x, 1) for x in self.children[node].values() if self.fuzzy[x])
        following = self._state(out) if out else -1
        self.next[state][c] = following
        return following

    def match(self, word: str) -> int:
        """1: a term or a word of a stem; 2: a term with one edit; 0: neither."""
        state = self.start
        for c in word:
            following = self.next[state].get(c)
            state = self._step(state, c) if following is None else following
            if state < 0:
                return 0
            if self.verdict[state][0]:
                return 1
        return self.verdict[state][1]


def features(column: pa.Array, machine: Machine) -> np.ndarray:
    """By text: words, then hits (exact direct, exact quoted, misspelt direct, misspelt quoted)."""
    w = W.words(column, ALPHA)
    out = np.zeros((len(column), 5), np.int64)
    out[:, 0] = np.diff(w.first)
    distinct, at, inverse = np.unique(w.hashes, return_index=True, return_inverse=True)
    kind = np.zeros(len(distinct), np.int64)
    raw = w.data.tobytes() if len(distinct) else b""
    known = machine.known
    if len(known) > 2_000_000:
        known.clear()
    for i, (key, a, b) in enumerate(zip(distinct.tolist(), w.starts[at].tolist(), w.ends[at].tolist(), strict=True)):
        got = known.get(key)
        if got is None:
            got = known[key] = max((machine.match(x) for x in LETTERS.findall(raw[a:b].decode("utf-8", "replace").lower())), key=(0, 2, 1).index, default=0)
        kind[i] = got
    found = np.flatnonzero(kind[inverse]) if len(inverse) else np.zeros(0, np.int64)
    owner = np.searchsorted(w.first, found, side="right") - 1
    for k, i in zip(found.tolist(), owner.tolist(), strict=True):
        a, b = max(k - CONTEXT, int(w.first[i])), min(k + CONTEXT, int(w.first[i + 1]) - 1)
        before = raw[w.starts[a]:w.starts[k]].decode("utf-8", "replace")
        after = raw[w.ends[k]:w.ends[b]].decode("utf-8", "replace")
        quoted = (any(q in before for q in QUOTES) and any(q in after for q in QUOTES)) or not REPORTING.isdisjoint(before.lower().split())
        out[i, {1: 1, 2: 3}[int(kind[inverse[k]])] + quoted] += 1
    return out


ALPHA = W.BLANK.copy()
ALPHA[[ord(c) for c in ".,;:!?()[]{}<>|/\\\"*#$%&=+-_@'`~^"]] = True


class Weights(NamedTuple):
    cells: dict[tuple[int, ...], tuple[int, int]]
    beta: tuple[float, ...]


def cell(f: np.ndarray) -> list[tuple[int, ...]]:
    """Bounded inputs: hit counts up to 3, and whether hits are more than one in fifty words."""
    dense = (f[:, 1:].sum(axis=1) * 50 > f[:, 0]).astype(int)
    return [(*map(int, row), int(d)) for row, d in zip(np.minimum(f[:, 1:], 3), dense, strict=True)]


def fit(train: DataFrame, machine: Machine) -> Weights:
    """Counts of toxic and clean documents by inputs (at most 512 cells), and a logistic model of them."""
    shared = train.sparkSession.sparkContext.broadcast(machine)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = Counter(zip(cell(features(batch.column("text"), shared.value)), batch.column("toxic").to_pylist(), strict=True))
        return pa.RecordBatch.from_arrays([pa.array([list(c) for c, _ in seen], pa.list_(pa.int64())), pa.array([t for _, t in seen], pa.int32()),
                                           pa.array(list(seen.values()), pa.int64())], names=["cell", "toxic", "n"])
    rows = W.map_texts(train, run, "cell array<long>, toxic int, n long").groupBy("cell", "toxic").agg(F.sum("n").alias("n")).collect()
    cells: dict[tuple[int, ...], list[int]] = {}
    for r in rows:
        cells.setdefault(tuple(r.cell), [0, 0])[0 if r.toxic else 1] += r.n
    if not cells:
        return Weights({}, (0.0,) * 6)
    x = np.array([[1.0, *c] for c in cells])
    y, n = np.array([v[0] for v in cells.values()], float), np.array([sum(v) for v in cells.values()], float)
    beta = np.zeros(6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(6) * 0.1, x.T @ (y - n * p) - 0.1 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Weights({k: (v[0], v[1]) for k, v in cells.items()}, tuple(beta.tolist()))


#: Score of every text where there is no usable label.
UNLABELLED = 0.05


def probability(c: tuple[int, ...], w: Weights, prior: float = 5.0) -> float:
    """Share of toxic documents in the cell, drawn to the logistic model with the weight of ``prior`` documents."""
    z = w.beta[0] + sum(b * x for b, x in zip(w.beta[1:], c, strict=True))
    p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    bad, good = w.cells.get(c, (0, 0))
    return (bad + prior * p) / (bad + good + prior)


def score(docs: DataFrame, labels: DataFrame, held_out: str | None = None, max_labels: int = MAX_LABELS) -> DataFrame:
    """Adds ``score``, ``predicted`` and the hit counts.  Labels of rows for
    which the SQL condition ``held_out`` holds are not looked at."""
    train = labelled(docs, labels.filter(f"not ({held_out})") if held_out else labels, max_labels)
    machine = Machine(sorted(learn_terms(train)))
    weights = fit(train, machine)
    shared = docs.sparkSession.sparkContext.broadcast((machine, weights))

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        machine, weights = shared.value
        f = features(batch.column("text"), machine)
        memo: dict[tuple[int, ...], float] = {}
        p = np.array([memo.get(c) or memo.setdefault(c, probability(c, weights) if weights.cells else UNLABELLED) for c in cell(f)], float)
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *(pa.array(f[:, k]) for k in range(1, 5))]
    return W.add_columns(docs, make, "score double, predicted int, n_direct long, n_quoted long, n_misspelt long, n_misspelt_quoted long")
