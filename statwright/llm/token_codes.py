"""Token ids in directly addressable codes.

Ids are cut into chunks of eight bits.  Level 0 has the low chunk of every id
and a bitmap that says whose code goes on; level 1 has the next chunk of those,
and so on.  A rank directory over each bitmap counts the marks before every
512th bit, so the i-th id is found by one rank per level, without decoding
anything before it.

A file set is a Parquet folder: one row per block of about ``BLOCK_IDS`` ids
with its levels, bitmaps, directories and its table of documents.  Spark
writes and reads it, so it may lie in any store the cluster reaches.  Blocks
of one shard follow each other in doc_id order, and so do shards; a block's
first position is the sum of all blocks before it.

Encoding asks the tokenizer for the distinct words of a piece of text that are
not known yet, hundreds at a time with a mark between two.  Where the mark's id
does not come out between all of them, they are asked one by one.  Words here
are cut at ASCII white space, which the tokenizer never joins over.  Where the
tokenizer itself lower-cases and then encodes runs of letters, single digits
and runs of other signs apart (``SPLIT``), words of ASCII and the letters À-ÿ
are cut there too and compared in lower case: far fewer are new.

Defined results: a null or empty text is only its end id; null doc_ids come
first; rows with equal doc_id follow each other, ordered by their ids; an
empty table gives an empty file set and no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.sizes import broadcast_if_small
from . import words as W

BLOCK_IDS = 1 << 18
RANK = 512
END_ID = 1
FILE = ("shard int, block int, n_ids long, doc_ids binary, doc_nulls binary, doc_counts binary, "
        "levels array<binary>, marks array<binary>, ranks array<binary>")
CACHE_WORDS = 1 << 19
MARK = b"\x01"
TOGETHER = 100
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: What begins a special token; words with it stay whole.
SPECIAL = "<|"
#: Of such texts the normalizer only changes the case.
PLAIN = re.compile("[\n\x01!-~À-ÖØ-öø-ÿ]*")
#: Blank, letter (or byte of one of À-ÿ), digit, other sign, and bytes whose words stay whole.
KIND = np.full(256, 4, dtype=np.uint8)
KIND[0x21:0x7F] = 3
KIND[[0x27]] = 4
KIND[0x30:0x3A] = 2
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0xC0), 0xC3]] = 1
KIND[W.BLANK] = 0
COUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


class Known:
    """Codes of words seen before, as flat arrays: word hashes in order, where each word's ids lie, and whether the word
    came again since the last time that room was made."""

    def __init__(self, path: str) -> None:
        # One thread: Spark already uses every core, and each thread holds memory of its own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.normal = self.tokenizer.normalizer
        self.cuts = self.cut_by_kind()
        self.mark = self.marked()
        self.clear()

    def clear(self) -> None:
        self.words, self.start, self.size = np.zeros(0, W.U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.again = np.zeros(0, np.uint32), np.zeros(0, dtype=bool)

    def make_room(self) -> None:
        """Drop the words that did not come again, or all where that leaves too many."""
        k = np.flatnonzero(self.again)
        if len(k) > CACHE_WORDS // 2:
            return self.clear()
        self.words, self.ids, self.size = self.words[k], self.ids[W.span(self.start[k], self.size[k])], self.size[k]
        self.start, self.again = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)[:-1], np.zeros(len(k), dtype=bool)

    def cut_by_kind(self) -> bool:
        """Whether ``parts`` are encoded as in their words."""
        made = [json.loads(x.__getstate__()) if x is not None else None for x in (self.normal, self.tokenizer.pre_tokenizer)]
        return made == [NORMAL, SPLIT] and all(SPECIAL in x.content for x in self.tokenizer.get_added_tokens_decoder().values())

    def marked(self) -> int:
        """The id of the mark between words, -1 where words asked together are not encoded as each alone."""
        mark, *each = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in (MARK.decode(), "ab", "The", "cd,", "9", "'s", "\u00e9"))
        between = self.tokenizer.encode(f"\n{MARK.decode()}\n".join(("ab", "The", "cd,", "9", "'s", "\u00e9")), add_special_tokens=False).ids
        want = each[0] + [x for ids in each[1:] for x in (*mark, *ids)]
        return mark[0] if len(mark) == 1 and between == want and want.count(mark[0]) == len(each) - 1 else -1

    def ask(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(size of each, ids) from the tokenizer."""
        sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        some = 50 * TOGETHER
        for a in range(0, len(words), some):
            parts = [words[i:i + TOGETHER] for i in range(a, min(a + some, len(words)), TOGETHER)]
            got = self.encoded([(b"\n" + MARK + b"\n").join(x) for x in parts]) if self.mark >= 0 else [None] * len(parts)
            for part, ids in zip(parts, got, strict=True):
                ends = np.flatnonzero(ids == self.mark) if ids is not None else None
                if ends is not None and len(ends) == len(part) - 1:
                    sizes.append(np.diff(np.concatenate([[-1], ends, [len(ids)]])) - 1)
                    flat.append(np.delete(ids, ends))
                else:
                    each = self.encoded(part)
                    sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
                    flat.extend(each)
        return np.concatenate(sizes), np.concatenate(flat)

    def encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        texts = [x.decode("utf-8", "replace") for x in texts]
        plain = self.cuts and all(PLAIN.fullmatch(x) and SPECIAL not in x for x in texts)
        if plain:
            self.tokenizer.normalizer = None
        try:
            got = self.tokenizer.encode_batch_fast([x.lower() for x in texts] if plain else texts, add_special_tokens=False)
        finally:
            if plain:
                self.tokenizer.normalizer = self.normal
        return [np.array(e.ids, np.uint32) for e in got]

    def keep(self, words: np.ndarray, start: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        if len(self.words) + len(words) > CACHE_WORDS:
            self.make_room()
        order = np.argsort(np.concatenate([self.words, words]), kind="stable")
        self.start = np.concatenate([self.start, len(self.ids) + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)])[order]
        self.ids = np.concatenate([self.ids, ids[W.span(start, size)]])
        self.words, self.size = np.concatenate([self.words, words])[order], np.concatenate([self.size, size])[order]
        self.again = np.concatenate([self.again, np.zeros(len(words), dtype=bool)])[order]


@functools.lru_cache(maxsize=2)
def known_words(path: str) -> Known:
    return Known(path)


def parts(column: pa.Array) -> tuple[W.Words, np.ndarray]:
    """Words cut between bytes of different kinds and between digits, with hashes of their lower case; and which of them
    are whole words, left as they are, for some byte in them is not in ``KIND`` or part of another letter than À-ÿ."""
    data, bounds = W.text_bytes(column)
    starts, ends, hashes, whole = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, W.U)], [np.zeros(0, dtype=bool)]
    for a, b in W.windows(data, bounds, W.BLANK):
        part = data[a:b]
        heads = bounds[np.searchsorted(bounds, a):np.searchsorted(bounds, b)] - a
        kind = KIND[part]
        inside = kind > 0
        first = np.ones(len(part), dtype=bool)
        first[1:] = ~inside[:-1]
        first[heads] = True
        cut = kind == 2
        cut[1:] |= kind[1:] != kind[:-1]
        cut &= inside & ~first
        first &= inside
        bad = kind == 4
        lead, tail, low = part == 0xC3, (part & 0xC0) == 0x80, W.LOWER[part]
        if lead.any() or tail.any():
            second = np.zeros(len(part), dtype=bool)
            second[1:] = lead[:-1]
            second[heads] = False
            then = np.zeros(len(part), dtype=bool)
            then[:-1] = (tail & second)[1:]
            bad |= (tail & (~second | (part == 0x97) | (part == 0xB7))) | (lead & ~then)
            low[second & tail & (part < 0x9F)] += 32
        bad[:-1] |= (part[:-1] == ord(SPECIAL[0])) & (part[1:] == ord(SPECIAL[1]))
        s = np.flatnonzero(first)
        spoiled = np.unique(np.searchsorted(s, np.flatnonzero(bad), side="right") - 1)
        if len(spoiled):
            cuts = np.flatnonzero(cut)
            cut[cuts[np.isin(np.searchsorted(s, cuts, side="right") - 1, spoiled)]] = False
        first |= cut
        inside[:-1] &= ~inside[1:] | first[1:]
        at, e = np.flatnonzero(first), np.flatnonzero(inside) + 1
        left = np.zeros(len(at), dtype=bool)
        if len(spoiled):
            left[np.searchsorted(at, s[spoiled])] = True
            same = W.span(at[left], (e - at)[left])
            low[same] = part[same]
        starts.append(at + a)
        ends.append(e + a)
        whole.append(left)
        hashes.append(W.run_hashes(low, at, e))
    begin = np.concatenate(starts)
    return W.Words(np.searchsorted(begin, bounds), np.concatenate(hashes), begin, np.concatenate(ends), data, bounds), np.concatenate(whole)


def encode(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(bounds by text, ids) of whole texts, without end ids."""
    known = known_words(path)
    w, whole = parts(column) if known.cuts else (W.words(column, lower=False), None)
    distinct, at, inverse, often = np.unique(w.hashes, return_index=True, return_inverse=True, return_counts=True)
    place = np.minimum(np.searchsorted(known.words, distinct), max(0, len(known.words) - 1))
    old = known.words[place] == distinct if len(known.words) else np.zeros(len(distinct), dtype=bool)
    new = np.flatnonzero(~old)
    if whole is not None:
        new = new[np.argsort(whole[at[new]], kind="stable")]
    raw = w.data.tobytes() if len(new) else b""
    sizes, ids = known.ask([raw[a:b] for a, b in zip(w.starts[at[new]].tolist(), w.ends[at[new]].tolist(), strict=True)])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if len(sizes) else sizes
    start, size = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64)
    start[old], size[old] = known.start[place[old]], known.size[place[old]]
    start[new], size[new] = len(known.ids) + starts, sizes
    flat = np.concatenate([known.ids, ids])
    per = size[inverse] if len(inverse) else np.zeros(0, np.int64)
    out = flat[W.span(start[inverse], per)] if len(per) else flat[:0]
    known.again[place[old]] = True
    again = np.arange(len(new)) if len(known.words) + len(new) <= CACHE_WORDS else np.flatnonzero(often[new] > 1)
    if len(again):
        known.keep(distinct[new[again]], starts[again], sizes[again], ids)
    return np.concatenate([[0], np.cumsum(per)])[w.first], out


def pack(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, continuation bitmaps and rank directories of ids."""
    levels, marks, ranks = [], [], []
    rest = ids.astype(np.uint64)
    while True:
        levels.append((rest & W.U(255)).astype(np.uint8).tobytes())
        more = rest > 255
        if not more.any():
            return levels, marks, ranks
        marks.append(np.packbits(more, bitorder="little").tobytes())
        upto = np.add.reduceat(more, np.arange(0, len(more), RANK), dtype=np.uint32)
        ranks.append(np.concatenate([[0], np.cumsum(upto)[:-1]]).astype(np.uint32).tobytes())
        rest = rest[more] >> W.U(8)


def fetch(levels: list[bytes], marks: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """The ids at the given positions; nothing else is decoded."""
    at = np.asarray(at, dtype=np.int64)
    out = np.zeros(len(at), dtype=np.uint64)
    alive = np.arange(len(at))
    for level, data in enumerate(levels):
        out[alive] |= np.frombuffer(data, np.uint8)[at].astype(np.uint64) << W.U(8 * level)
        if level == len(marks):
            break
        bits = np.frombuffer(marks[level], np.uint8)
        on = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        alive, at = alive[on], at[on]
        if not len(at):
            break
        at = rank(bits, np.frombuffer(ranks[level], np.uint32), at)
    return out.astype(np.uint32)


def rank(bits: np.ndarray, directory: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Marks before each position: the directory's count plus at most 512 bits."""
    out = directory[at // RANK].astype(np.int64)
    first, byte = (at // RANK) * (RANK // 8), at >> 3
    for k in range(RANK // 8):
        inside = first + k < byte
        out += np.where(inside, COUNT[bits[np.where(inside, first + k, 0)]], 0)
    return out + COUNT[bits[byte] & ((1 << (at & 7)) - 1).astype(np.uint8)]


def unpack(levels: list[bytes], marks: list[bytes]) -> np.ndarray:
    """All ids of a block."""
    upper = np.zeros(0, dtype=np.uint32)
    for level in range(len(levels) - 1, -1, -1):
        ids = np.frombuffer(levels[level], np.uint8).astype(np.uint32)
        if level < len(marks):
            on = np.unpackbits(np.frombuffer(marks[level], np.uint8), count=len(ids), bitorder="little").astype(bool)
            ids[on] |= upper << np.uint32(8)
        upper = ids
    return upper


def encoded(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, ids): ids as bytes, little-endian, two or four bytes each."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, ids = encode(batch.column("text"), path)
        tail = [] if end_id is None else [end_id]
        out = [np.append(ids[a:b], tail).astype(np.uint32) for a, b in zip(first, first[1:], strict=False)]
        out = [b"\2" + x.astype("<u2").tobytes() if not len(x) or x.max() < 1 << 16 else b"\4" + x.astype("<u4").tobytes() for x in out]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "ids"])
    return W.map_texts(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, ids binary", most=1 << 20)


def shards(docs: DataFrame, path: str, n: int, end_id: int | None = END_ID) -> DataFrame:
    """Blocks of the file set; shards are ranges of doc_id."""
    cuts = docs.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    cuts = sorted(set(cuts or []))
    at = F.coalesce(F.aggregate(F.array(*[F.lit(c) for c in cuts]) if cuts else F.expr("array(cast(null as double))"), F.lit(0),
                                lambda acc, c: acc + F.when(F.col("doc_id") > c, 1).otherwise(0)), F.lit(0))
    dealt = encoded(docs, path, end_id).withColumn("shard", at.cast("int"))
    dealt = dealt.repartition(n, "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "ids")

    def block(shard: int, number: int, rows: list[tuple]) -> dict:
        ids = np.concatenate([np.frombuffer(x, "<u2" if x[:1] == b"\2" else "<u4", offset=1).astype(np.uint32) for _, x in rows])
        levels, marks, ranks = pack(ids)
        return {"shard": shard, "block": number, "n_ids": len(ids),
                "doc_ids": np.array([d or 0 for d, _ in rows], dtype="<i8").tobytes(),
                "doc_nulls": np.packbits([d is None for d, _ in rows], bitorder="little").tobytes(),
                "doc_counts": np.array([(len(x) - 1) // x[0] for _, x in rows], dtype="<i8").tobytes(),
                "levels": levels, "marks": marks, "ranks": ranks}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()),
                            *[(k, pa.binary()) for k in ("doc_ids", "doc_nulls", "doc_counts")],
                            *[(k, pa.list_(pa.binary())) for k in ("levels", "marks", "ranks")]])
        shard, number, rows, size = None, 0, [], 0
        for batch in batches:
            for d, x, s in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "shard")), strict=True):
                if rows and (s != shard or size >= BLOCK_IDS):
                    yield pa.RecordBatch.from_pylist([block(shard, number, rows)], schema)
                    number, rows, size = number + 1, [], 0
                if s != shard:
                    shard, number = s, 0
                rows.append((d, x))
                size += (len(x) - 1) // x[0]
        if rows:
            yield pa.RecordBatch.from_pylist([block(shard, number, rows)], schema)

    return dealt.mapInArrow(W.tidy(run), FILE)


def write(docs: DataFrame, folder: str, path: str, end_id: int | None = END_ID, n: int | None = None) -> None:
    """Encode whole texts with the tokenizer file ``path`` and write a file set in ascending doc_id order."""
    n = n or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards(docs, path, n, end_id).write.mode("overwrite").parquet(folder)


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks with ``first_id``, the position of their first id among all ids."""
    files = spark.read.schema(FILE).parquet(folder)
    sizes = files.select("shard", "block", "n_ids")
    shard = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    base = shard.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    place = sizes.select("shard", "block", within.alias("within")).join(F.broadcast(base), "shard")
    return files.join(broadcast_if_small(place.select("shard", "block", (F.col("base") + F.col("within")).alias("first_id"))), ["shard", "block"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the file set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = unpack(row["levels"], row["marks"])
                counts = np.frombuffer(row["doc_counts"], "<i8")
                nulls = np.unpackbits(np.frombuffer(row["doc_nulls"], np.uint8), count=len(counts), bitorder="little").astype(bool)
                at = np.concatenate([[0], np.cumsum(counts)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at, at[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(row["doc_ids"], "<i8"), mask=nulls), pa.array(at[:-1] + row["first_id"]),
                     pa.array(counts), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return blocks(spark, folder).select("first_id", "doc_ids", "doc_nulls", "doc_counts", "levels", "marks").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(position, token): random access to the ids at the rows of ``wanted(position)``."""
    where = blocks(spark, folder).select("shard", "block", "first_id", "n_ids")
    hits = wanted.select("position").distinct().join(
        where, (F.col("position") >= F.col("first_id")) & (F.col("position") < F.col("first_id") + F.col("n_ids")))
    asked = hits.groupBy("shard", "block", "first_id").agg(F.collect_list("position").alias("positions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at = np.array(row["positions"], dtype=np.int64)
                got = fetch(row["levels"], row["marks"], row["ranks"], at - row["first_id"])
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(got.astype(np.int64))], names=["position", "token"])
    files = spark.read.schema(FILE).parquet(folder).select("shard", "block", "levels", "marks", "ranks")
    return files.join(asked, ["shard", "block"]).drop("shard", "block").mapInArrow(W.tidy(run), "position long, token long")
