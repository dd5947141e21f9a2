"""Repair of conversation structure by a square-root checkpointed program.

A conversation is right when its role initials read ``(s?(ua)+)?``.  Rows may
be kept (cost 0), given the role user or assistant (1) or deleted (2, a must
for blank rows and repeats); a user or assistant row without text may be put
in anywhere (5); a truncated row that stays costs 5 more.  The cheapest edits
are found by a dynamic program over four states (nothing yet, after s, u, a).
Its backward vectors, the cost from each state to a right end, are stored only
at about the square root of the rows; walking forward, the vectors between two
checkpoints are computed again and the ASCII-least tight edit is emitted.

Conversations may be of any length.  Rows are range partitioned by
conversation and turn and checkpointed; a piece is what one partition holds of
a conversation, at most ``PIECE_ROWS`` rows or ``PIECE_BYTES`` of text.  Nearly
all conversations are one piece and are settled in one pass.  For the others a
piece becomes a table of costs between its first and last states; the vectors
between pieces follow from these tables, then each piece is walked from its own
first state.  Only these tables come to the driver: one for each piece of a
conversation that has several, or that lies at the edge of a partition.

The SHA-256 of a repaired conversation is one stream of its bytes by
definition: one of several pieces is read in order by one task, which holds
one batch at a time.

Defined results: a null role or text is one blank; null conversations and
turns are values of their own, null turns come first; rows of one turn are
ordered by role and text (bytes); equal rows of one turn are repeats; a row of
``copies`` 0 only names its conversation, which then has zeros and an empty
audit; an empty table gives no rows; columns other than conv_id, turn, role,
text (and ``copies``, where it is asked for) are not looked at and not kept.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ordered import join_same
from ..functions.storage import materialise, written

PIECE_ROWS = 1 << 16
PIECE_BYTES = 1 << 26
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
COST = {"K": 0, "R": REROLE, "I": INSERT}
FAR = 1 << 50
#: States: nothing yet, after s, after u, after a.
NEXT = (2, 2, 3, 2)
KEEP = ({0: 1, 1: 2}, {1: 2}, {2: 3}, {1: 2})
NAMES = {2: "user", 3: "assistant"}
#: A row's code: its initial (0 s, 1 u, 2 a, 3 another), plus 4 where truncated; GONE must be deleted.
GONE = 8
LEGAL = {(0, 1), (1, 2), (2, 1)}

Vector = tuple[int, int, int, int]


def settled(v: list[int]) -> Vector:
    """Costs after any number of insertions."""
    for _ in range(3):
        v = [min(v[s], INSERT + v[NEXT[s]]) for s in range(4)]
    return tuple(v)


END = settled([0, FAR, FAR, 0])


@functools.lru_cache(maxsize=1 << 16)
def back(v: Vector, code: int) -> tuple[Vector, int]:
    """The vector before a row, less its least cost, and that cost."""
    out = [DELETE + c for c in v]
    if code < GONE:
        more, initial = (CUT if code & 4 else 0), code & 3
        for s in range(4):
            out[s] = min(out[s], REROLE + more + v[NEXT[s]])
            if initial in KEEP[s]:
                out[s] = min(out[s], more + v[KEEP[s][initial]])
    got = settled(out)
    least = min(got)
    return tuple(FAR if c - least > FAR // 2 else c - least for c in got), least


@functools.lru_cache(maxsize=1 << 16)
def move(v: Vector, code: int, state: int) -> tuple[str, int]:
    """Least tight edits up to and with a row, where ``v`` holds after it; and the state after them."""
    cur, least = back(v, code)
    letters = ""
    while True:
        left = cur[state] + least
        more, initial = (CUT if code & 4 else 0), code & 3
        if left == DELETE + v[state]:
            return letters + "D", state
        if left == INSERT + cur[NEXT[state]] + least:
            letters, state = letters + "I", NEXT[state]
            continue
        if code < GONE and initial in KEEP[state] and left == more + v[KEEP[state][initial]]:
            return letters + "K", KEEP[state][initial]
        return letters + "R", NEXT[state]


def before(codes: bytes, v: Vector) -> tuple[Vector, int]:
    """The vector before a run of rows, less its least cost, and that cost."""
    least = min(v)
    v, total = tuple(c - least for c in v), least
    for code in reversed(codes):
        v, more = back(v, code)
        total += more
    return v, total


def walk(codes: bytes, exits: Vector, state: int) -> Iterator[tuple[str, int]]:
    """Edits and the state after each row; vectors are kept at every k-th row only."""
    k = math.isqrt(len(codes)) + 1
    least = min(exits)
    marks = [tuple(c - least for c in exits)]
    for a in range((len(codes) - 1) // k * k, 0, -k):
        marks.append(before(codes[a:a + k], marks[-1])[0])
    for a in range(0, len(codes), k):
        block, v = codes[a:a + k], marks.pop()
        after = [v]
        for code in reversed(block[1:]):
            v, _ = back(v, code)
            after.append(v)
        for code in block:
            letters, state = move(after.pop(), code, state)
            yield letters, state


def closing(state: int) -> str:
    """Insertions at the end of a conversation."""
    out = ""
    while END[state]:
        out, state = out + "I", NEXT[state]
    return out


def between(codes: bytes) -> list[int]:
    """Costs from each first state (4 rows) to each last state of a run of rows."""
    out = [[FAR] * 4 for _ in range(4)]
    for e in range(4):
        v = [FAR] * 4
        v[e] = 0
        got, total = before(codes, tuple(v))
        for s in range(4):
            out[s][e] = got[s] + total
    return [c for row in out for c in row]


class Piece:
    """Rows of one conversation inside one partition, in order."""

    def __init__(self, conv, block: int) -> None:
        self.conv, self.block = conv, block
        self.codes, self.copies = bytearray(), []
        self.rows: list[tuple] = []
        self.bytes = 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.first = self.last = self.low = self.high = self.head = None

    def add(self, turn, initial: int, blank: bool, cut: bool, later: bool, copies: int, size: int) -> None:
        self.bytes += size
        if not copies:
            return
        if blank:
            self.blank += copies
        elif later:
            self.duplicate += copies
        else:
            self.duplicate += copies - 1
            self.truncated += cut
        self.illegal += copies - 1
        if self.last is None:
            self.first, self.head = initial, turn
        else:
            self.illegal += (self.last, initial) not in LEGAL
        self.last = initial
        if turn is not None:
            self.distinct += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.codes.append(GONE if blank or later else initial + 4 * cut)
        self.copies.append(copies)


def same(a, b) -> bool:
    return a == b or (a != a and b != b)


FLAGS = ["conv_id", "turn", "_initial", "_blank", "_cut", "_later", "_copies", "_size"]


def pieces(batches: Iterator[pa.RecordBatch], texts: bool, most: int) -> Iterator[Piece]:
    """The pieces of a sorted partition."""
    piece = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in FLAGS]
        rows = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True) if texts else [None] * batch.num_rows
        for conv, turn, initial, blank, cut, later, copies, size, own in zip(*columns, rows, strict=True):
            if piece is None or not same(conv, piece.conv):
                if piece is not None:
                    yield piece
                piece = Piece(conv, 0)
            elif piece.codes and (len(piece.codes) >= most or piece.bytes + size > PIECE_BYTES):
                block = piece.block + 1
                yield piece
                piece = Piece(conv, block)
            piece.add(turn, initial, blank, cut, later, copies, size)
            if texts and copies:
                piece.rows.append(own)
    if piece is not None:
        yield piece


def code_columns(rows: DataFrame) -> DataFrame:
    """What the program needs to know of a row, from its role and text."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    return rows.withColumns({
        "_initial": F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3),
        "_blank": stripped == "", "_cut": ~F.substring(stripped, -1, 1).isin(".", "!", "?"),
        "_size": (F.octet_length("role") + F.octet_length("text")).cast("long")})


def in_order(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """Rows sorted by conversation and turn over range partitions, each distinct row once with its
    number of copies and whether an earlier turn has the same role and text."""
    own = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
                      (F.lit(1) if copies is None else F.col(copies)).cast("long").alias("_copies"))
    key = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    marked = own.withColumn("_key", key)
    repeats = written(marked.filter("_copies > 0").groupBy("conv_id", "_key").agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.col("turn").isNull()).alias("_null"), F.min("turn").alias("_least")).filter("_n > 1").drop("_n"))
    later = F.coalesce(F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_least")), F.lit(False))
    flagged = join_same(marked, repeats, ["conv_id", "_key"], "left").withColumn("_later", later)
    once = flagged.groupBy("conv_id", "turn", "role", "text", "_later").agg(F.sum("_copies").alias("_copies"))
    order = ["conv_id", "turn", "role"]
    return materialise(once.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text"))


def arrow_type(rows: DataFrame) -> pa.DataType:
    """How a conversation's id arrives in a task."""
    return rows.select("conv_id").limit(0).toArrow().schema.field(0).type


class Place(NamedTuple):
    """Where a piece stands in a conversation of several pieces."""

    entry: int
    exits: Vector
    final: bool
    illegal: int
    shared: int


def places(ordered: DataFrame, most: int) -> dict[tuple[int, int, int], Place]:
    """Place of each piece of the conversations that have several, by (partition, number in it, block)."""
    flags = code_columns(ordered).select(*FLAGS)
    conv = ordered.schema["conv_id"].dataType.simpleString()

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, run = TaskContext.get().partitionId(), -1, []
        rows: list[tuple] = []

        def settle(last: bool) -> None:
            if run and (number == 0 or last or len(run) > 1):
                rows.extend((p.conv, part, number, p.block, between(bytes(p.codes)), p.first, p.last, p.head, p.high, len(p.codes)) for p in run)
        for p in pieces(batches, False, most):
            if p.block == 0:
                settle(False)
                number, run = number + 1, []
            run.append(p)
        settle(True)
        names = ["conv_id", "part", "number", "block", "costs", "first", "last", "head", "high", "rows"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    kinds = [arrow_type(ordered), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int32(), pa.int32(), pa.int64(),
             pa.int64(), pa.int64()]
    got = flags.mapInArrow(tables, f"conv_id {conv}, part int, number int, block int, costs array<long>, first int, last int, head long, high long, rows long")
    chains: list[list] = []
    for r in sorted((r for r in got.collect() if r.rows), key=lambda r: (r.part, r.number, r.block)):
        if chains and same(chains[-1][-1].conv_id, r.conv_id):
            chains[-1].append(r)
        else:
            chains.append([r])
    chains = [c for c in chains if len(c) > 1]
    if not chains:
        return {}
    exits: dict[tuple[int, int, int], Vector] = {}
    for chain in chains:
        v = END
        for r in reversed(chain):
            exits[r.part, r.number, r.block] = v
            v = tuple(min(r.costs[4 * s + e] + v[e] for e in range(4)) for s in range(4))
    shared = ordered.sparkSession.sparkContext.broadcast(exits)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, rows = TaskContext.get().partitionId(), -1, []
        for p in pieces(batches, False, most):
            number += p.block == 0
            v = shared.value.get((part, number, p.block))
            if v is not None and p.codes:
                last = []
                for s in range(4):
                    for _, state in walk(bytes(p.codes), v, s):
                        pass
                    last.append(state)
                rows.append((part, number, p.block, last))
        if rows:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["part", "number", "block", "ends"])

    last = {(r.part, r.number, r.block): r.ends for r in flags.mapInArrow(ends, "part int, number int, block int, ends array<int>").collect()}
    out: dict[tuple[int, int, int], Place] = {}
    for chain in chains:
        state = 0
        for k, r in enumerate(chain):
            at = r.part, r.number, r.block
            earlier = chain[k - 1] if k else None
            out[at] = Place(state, exits[at], k + 1 == len(chain), int(k > 0 and (earlier.last, r.first) not in LEGAL),
                            int(k > 0 and r.head is not None and earlier.high == r.head))
            state = last[at][state]
    return out


class Repair(NamedTuple):
    """``turns``: the repaired rows (conv_id, place, edit, role, text), in order of ``place``;
    ``report``: one row per conversation with faults, cost, audit and the hash of its repaired rows."""

    turns: DataFrame
    report: DataFrame


def edited(p: Piece, place: Place) -> Iterator[tuple[str, str, str, int]]:
    """(letters of a row, role and index of the rows that stay): one entry a letter; -1 is an inserted row."""
    state = place.entry
    for i, (letters, after) in enumerate(walk(bytes(p.codes), place.exits, state)):
        for letter in letters:
            if letter == "I":
                state = NEXT[state]
                yield "I", NAMES[state], "", -1
            elif letter == "D":
                yield "D", "", "", i
            else:
                role, text = p.rows[i] if p.rows else ("", "")
                yield letter, (role if letter == "K" else NAMES[NEXT[state]]), text, i
        state = after
        if p.copies[i] > 1:
            yield "D" * (p.copies[i] - 1), "", "", i
    if place.final:
        for letter in closing(state):
            state = NEXT[state]
            yield letter, NAMES[state], "", -1


ALONE = Place(0, END, True, 0, 0)


def repair(rows: DataFrame, copies: str | None = None, most: int = PIECE_ROWS) -> Repair:
    """Cheapest edits of every conversation; ``copies`` names a column that says how often a row
    stands, ``most`` bounds the rows of a piece."""
    ordered = in_order(rows, copies)
    known = places(ordered, most)
    shared = ordered.sparkSession.sparkContext.broadcast(known)
    full = code_columns(ordered).select(*FLAGS, "role", "text")
    field = T.StructField("conv_id", ordered.schema["conv_id"].dataType)
    kind = arrow_type(ordered)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, int, bool, Place]]:
        part, number = TaskContext.get().partitionId(), -1
        for p in pieces(batches, True, most):
            number += p.block == 0
            place = shared.value.get((part, number, p.block))
            yield p, part << 40 | p.block << 20, place is None, place or ALONE

    def sheets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*held, strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)
        for p, at, alone, place in placed(batches):
            letters, digest, lines, cost = [], hashlib.sha256(), 0, 0
            for letter, role, text, i in edited(p, place):
                letters.append(letter)
                if letter[0] == "D":
                    cost += DELETE * len(letter)
                    continue
                cost += COST[letter] + (CUT if i >= 0 and p.codes[i] & 4 else 0)
                digest.update((b"\n" if lines else b"") + f"{role}:{text}".encode())
                lines += 1
            held.append((p.conv, at, p.low, p.high, p.distinct - place.shared, p.blank, p.duplicate, p.truncated, p.illegal + place.illegal, cost, "".join(letters),
                         digest.hexdigest() if alone and p.codes else None))
            if len(held) >= 4096:
                yield batch()
        if held:
            yield batch()

    names = ["conv_id", "place", "low", "high", "distinct", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha"]
    kinds = [kind, *[pa.int64()] * 9, pa.string(), pa.string()]
    longs = [T.StructField(c, T.LongType()) for c in names[1:10]]
    sheet = T.StructType([field, *longs, T.StructField("audit", T.StringType()), T.StructField("sha", T.StringType())])

    def turns(batches: Iterator[pa.RecordBatch], several: bool) -> Iterator[pa.RecordBatch]:
        for p, at, alone, place in placed(batches):
            if several and alone:
                continue
            rows = [(p.conv, at + k, letter, role, text) for k, (letter, role, text, _) in enumerate(e for e in edited(p, place) if e[0][0] != "D")]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), [kind, pa.int64(), *[pa.string()] * 3], strict=True)],
                                                 names=["conv_id", "place", "edit", "role", "text"])

    turn = T.StructType([field, T.StructField("place", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("edit", "role", "text"))])
    all_turns = full.mapInArrow(lambda b: turns(b, False), turn)
    parts = full.mapInArrow(sheets, sheet)
    whole = parts.groupBy("conv_id").agg(
        (F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("distinct"), F.lit(0)).cast("long")).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        F.max("sha").alias("repaired_sha256"))
    if known:
        several = full.mapInArrow(lambda b: turns(b, True), turn)
        whole = join_same(whole, streamed(several), ["conv_id"], "left")
        whole = whole.withColumn("repaired_sha256", F.coalesce("repaired_sha256", "_streamed")).drop("_streamed")
    return Repair(all_turns, whole.fillna(hashlib.sha256().hexdigest(), ["repaired_sha256"]))


def streamed(turns: DataFrame) -> DataFrame:
    """Hash of the rows of each conversation, read in order."""
    field = turns.schema["conv_id"]
    kind = arrow_type(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(conv, digest) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([digest.hexdigest()])], names=["conv_id", "_streamed"])
        conv, digest = None, None
        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
                if digest is None or not same(c, conv):
                    if digest is not None:
                        yield out(conv, digest)
                    conv, digest = c, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    digest.update(f"\n{role}:{text}".encode())
        if digest is not None:
            yield out(conv, digest)
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return dealt.mapInArrow(run, T.StructType([field, T.StructField("_streamed", T.StringType())]))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the planned faults by crc32 of ``conv_id:turn``: dropped, emptied, without closing marks, repeated, or given to the user.
    ``copies`` says how often a row stands; a dropped one still names its conversation."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *named)) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.col("_fault") == 0
    return rows.withColumn("_fault", fault).select(
        "conv_id", F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(F.col("_fault") == 4, "user").otherwise(role).alias("role"),
        F.when(gone | (F.col("_fault") == 1), "").when(F.col("_fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(F.col("_fault") == 3, 2).otherwise(1).alias("copies"))
