"""Quality rules with thresholds that follow each language and source.

Every document is measured on its whole text.  Each measure is an integer, and
a group's sketch of it is a histogram with bins of at most 0.1 % relative
width.  Such sketches merge by adding counts, in any order and from any number
of tasks, and always give the same quantiles.  A group's threshold is a
quartile plus a multiple of the quartile range, with a least distance so that
a group without spread does not reject its own normal documents.  Groups with
few documents take the merged sketch of their language, and rare languages the
merged sketch of everything.

Defined results: a null text counts as empty and fails the base rule (fewer
than 50 words); null languages and sources are groups of their own; repeated
rows are judged like any other row; an empty table gives no rows; other
columns are kept, those named like a measure are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import join_same
from ..functions.sizes import broadcast_if_small
from . import words as W

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
LINE_END = np.zeros(256, dtype=bool)
LINE_END[0x0A] = True

MEASURES = ("n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, "
            "n_repeat_words long")


class Rule(NamedTuple):
    """A measure of a document and how far from the group's quartiles it may lie.

    ``ranges`` quartile ranges, at least ``least``, above the upper quartile;
    with ``both`` also below the lower one.
    """

    name: str
    value: str
    ranges: float
    least: int
    both: bool = False


RULES = (
    Rule("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 3.0, 50),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 3.0, 300),
    Rule("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", 3.0, 250),
    Rule("word_length", "100 * word_chars div greatest(n_words, 1)", 4.0, 120, True),
)
MIN_WORDS = 50
MIN_GROUP = 200


def measures(batch: pa.RecordBatch) -> list[pa.Array]:
    w = W.words(batch.column("text"), lower=False)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(w.first)).astype(W.U)
    n = np.diff(w.first)
    chars = W.counts_in(((w.data & 0xC0) != 0x80) & ~W.BLANK[w.data], w.bounds)
    symbols = W.counts_in(SYMBOL[w.data], w.bounds)

    lines = W.words(batch.column("text"), LINE_END, lower=False)
    of = np.repeat(np.arange(batch.num_rows), np.diff(lines.first))
    full = np.searchsorted(w.starts, lines.starts) < np.searchsorted(w.starts, lines.ends)
    of, line = of[full], lines.hashes[full]
    _, once = np.unique(W.mix(line + of.astype(W.U) * W.STEP), return_index=True)
    n_lines = np.bincount(of, minlength=batch.num_rows)
    n_dup = n_lines - np.bincount(of[once], minlength=batch.num_rows)

    first, run = W.grams(w, 3)
    holder = np.repeat(np.arange(batch.num_rows), np.diff(first)).astype(W.U)
    key = W.mix(run + holder * W.STEP)
    order = np.argsort(key)
    same = np.zeros(len(key), dtype=bool)
    if len(key) > 1:
        equal = key[order][1:] == key[order][:-1]
        same[order[1:][equal]] = True
        same[order[:-1][equal]] = True
    at = W.span(w.first[:-1], np.diff(first))[same]
    marked = np.zeros(len(w.hashes) + 2, dtype=bool)
    for k in range(3):
        marked[at + k] = True
    repeats = W.sums(marked[:len(doc)].astype(np.int64), w.first)
    return [pa.array(x.astype(np.int64)) for x in (n, chars, symbols, n_lines, n_dup, repeats)]


def measure(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """The documents with their measures."""
    return W.add_columns(docs, measures, MEASURES, drop=() if keep_text else ("text",))


def binned(value: Column) -> Column:
    """Exact below 2048; above, the eleven leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 11, F.lit(0))
    return F.when(value < 2048, value).otherwise(
        F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift))


def sketches(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Mergeable quantile sketches: rows (lang, source, rule, bin, n)."""
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), binned(F.expr(r.value)).cast("long").alias("bin"))
                      for r in rules])
    return (measured.select("lang", "source", F.explode(pairs).alias("p"))
            .groupBy("lang", "source", "p.rule", "p.bin").agg(F.count(F.lit(1)).alias("n")))


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge the sketches of each key and read its quartiles: the lowest bin that reaches the rank."""
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "rule")
    ranked = merged.select("*", F.sum("n").over(group.orderBy("bin")).alias("upto"), F.sum("n").over(group).alias("all"))
    return ranked.groupBy(*keys, "rule").agg(
        F.max("all").alias("docs"),
        F.min(F.when(F.col("upto") * 4 >= F.col("all"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("all") * 3, F.col("bin"))).alias("q3"))


def thresholds(measured: DataFrame, rules: tuple[Rule, ...] = RULES, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source) with ``<rule>_low`` and ``<rule>_high``."""
    sketch = sketches(measured, rules)
    own = quartiles(sketch, ["lang", "source"])
    lang = quartiles(sketch, ["lang"]).withColumnsRenamed({"docs": "l_docs", "q1": "l_q1", "q3": "l_q3"})
    every = quartiles(sketch, []).select(F.col("rule").alias("e_rule"), F.col("q1").alias("e_q1"), F.col("q3").alias("e_q3"))
    joined = join_same(own, lang, ["lang", "rule"]).join(F.broadcast(every), F.col("rule") == F.col("e_rule"))

    def pick(q: str) -> Column:
        return (F.when(F.col("docs") >= min_group, F.col(q)).when(F.col("l_docs") >= min_group, F.col(f"l_{q}"))
                .otherwise(F.col(f"e_{q}")))

    joined = joined.select("lang", "source", "rule", pick("q1").alias("q1"), pick("q3").alias("q3"))
    out = []
    for r in rules:
        reach = F.greatest(F.lit(r.ranges) * (F.col("q3") - F.col("q1")), F.lit(float(r.least)))
        mine = F.col("rule") == r.name
        out += [F.max(F.when(mine, F.col("q1") - reach if r.both else F.lit(0.0))).alias(f"{r.name}_low"),
                F.max(F.when(mine, F.col("q3") + reach)).alias(f"{r.name}_high")]
    return joined.groupBy("lang", "source").agg(*out)


def judge(measured: DataFrame, limits: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds ``base_failed`` and ``kept``: joined filtering with the group's thresholds."""
    own = [c for c in measured.columns if c not in ("base_failed", "kept")]
    joined = join_same(measured.select(*[F.col(f"`{c}`") for c in own]), broadcast_if_small(limits), ["lang", "source"], "left")
    base = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    inside = F.lit(True)
    for r in rules:
        inside &= F.expr(r.value).between(F.col(f"{r.name}_low"), F.col(f"{r.name}_high"))
    return joined.select(*[F.col(f"`{c}`") for c in own], base.alias("base_failed"),
                         (~base & F.coalesce(inside, F.lit(True))).alias("kept"))


def quality_filter(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_group: int = MIN_GROUP) -> DataFrame:
    """Documents that pass, with their own columns only.  Texts are read twice
    and never shuffled: once for the sketches, once to filter."""
    mine, back = W.shielded(docs, ("doc_id", "text", "lang", "source"))
    limits = thresholds(measure(mine, keep_text=False), rules, min_group)
    return judge(measure(mine), limits, rules).filter("kept").select(*back)
