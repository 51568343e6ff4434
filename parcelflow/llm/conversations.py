"""Conversation structure repair by Four-Russians block tables.

The rows of a conversation are symbols: the role (system, user, assistant or
another), whether the text is truncated, or that the row must go (blank or
duplicate).  Rows are kept, given another role, deleted, and empty ones
inserted, so that the roles read ``(s?(ua)+)?`` at least cost.  The cost to go
from a row, for each of the four places in that pattern (nothing yet, after
system, after user, after assistant), is a vector whose entries differ by a few
units only.  So there are few vectors up to a common amount (``Tables`` finds
them all), and for each of them and each block of ``BLOCK`` symbols a table
holds the vector in front of the block and the amount it adds.

* Rows are sorted by conversation and turn through a range shuffle, so a
  conversation with a third of all rows spans many tasks.  What a task holds of
  one conversation is a segment.
* Each segment, read backwards block by block through the table, becomes a map
  from every vector behind it to the one in front and the cost added.  Maps of a
  conversation's segments are chained from its end: a few numbers a segment.
* Each segment is then traced.  The vectors at its block ends come from the
  table; a block is expanded backwards to the vector of every row and then
  traced forwards, taking the least letter among the edits that stay on a
  cheapest path.  A place in the pattern and a letter fix the next place, so the
  first letters decide ties as the whole string would.  A segment is traced from
  each of the four places at first, as where it starts is only known once the
  segments in front are; the right trace is picked when they are chained.

Letters: D delete, I insert, K keep, R give another role.

Nulls: a null role or text is one space (so the text is blank), a null turn
comes first and counts for no gap, null conv_id is a conversation of its own
(one space in the damage's checksum).  Rows of one turn are ordered by role and
a digest of role and text; rows equal in all of these are interchangeable.  A conversation without
rows after the damage keeps a result of zeros.  An empty table gives no rows.
Other columns are dropped at the start and never clash.  SHA-256 of a repaired
conversation is by its definition computed in one go: its text streams through
one task, batch by batch, without being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import islice, product
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize

#: Symbols in a block; the table has (number of vectors) * 9 ** BLOCK entries.
BLOCK = 4
#: Rows of one conversation that a segment holds at most.
SEGMENT_ROWS = 100_000
START, SYSTEM, USER, ASSISTANT = range(4)
GONE = 8  # symbols: role (0 system, 1 user, 2 assistant, 3 another) + 4 if truncated; or this
_AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_NAMES = {USER: "user", ASSISTANT: "assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """The query's damage by crc32 of ``conv_id:turn`` modulo 20 -> conv_id,
    turn, role, text; and for every conversation one row whose role and text
    are null, which ``repair`` takes as its mere existence."""
    blank = F.lit(" ")
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                               F.coalesce(F.col("role").cast("string"), blank).alias("role"),
                               F.coalesce(F.col("text").cast("string"), blank).alias("text"))
    kind = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), blank))) % 20
    text = (F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    rows = (own.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), copies)).alias("copy")).drop("copy"))
    return rows.unionByName(own.select("conv_id").distinct(), allowMissingColumns=True)


# --- the costs of one row -------------------------------------------------

def _moves(symbol: int, place: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next place) of the edits that use up the row."""
    yield "D", 3, place
    if symbol == GONE:
        return
    more = int(symbol >= 4)  # an undeleted truncated row
    role = symbol % 4
    if role < 3 and place in _AFTER["sua"[role]]:
        yield "K", more, _AFTER["sua"[role]][place]
    for initial in "ua":
        if place in _AFTER[initial]:
            yield "R", 2 + more, _AFTER[initial][place]


def _inserted(place: int) -> int:
    return ASSISTANT if place == USER else USER


def _settle(vector: list[int]) -> tuple[int, ...]:
    """Costs to go once rows may be inserted first."""
    while True:
        new = [min(v, 2 + vector[_inserted(p)]) for p, v in enumerate(vector)]
        if new == vector:
            return tuple(new)
        vector = new


END = _settle([0, 99, 99, 0])


@cache
def _before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """The vector in front of a row, from the one behind it."""
    return _settle([min(c + behind[q] for _, c, q in _moves(symbol, p)) for p in range(4)])


class Tables:
    """All vectors less their least entry, and the block table."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[tuple[int, ...]] = []
        number: dict[tuple[int, ...], int] = {}

        def add(v):
            if v not in number:
                number[v] = len(self.vectors)
                self.vectors.append(v)
            return number[v]

        self.end, self.end_cost = add(tuple(x - min(END) for x in END)), min(END)
        one, cost, i = [], [], 0
        while i < len(self.vectors):
            new = [_before(s, self.vectors[i]) for s in range(9)]
            one.append([add(tuple(x - min(v) for x in v)) for v in new])
            cost.append([min(v) for v in new])
            i += 1
        self.one, self.one_cost = np.array(one), np.array(cost)  # by vector behind, symbol
        # by vector behind and block number, whose first symbol has the highest place
        numbers = np.array(list(product(range(9), repeat=block))).T
        self.many = np.empty((len(self.vectors), 9 ** block), np.int64)
        self.many_cost = np.empty_like(self.many)
        for v in range(len(self.vectors)):
            at, total = np.full(9 ** block, v), np.zeros(9 ** block, np.int64)
            for symbols in numbers[::-1]:
                total += self.one_cost[at, symbols]
                at = self.one[at, symbols]
            self.many[v], self.many_cost[v] = at, total

    def _cut(self, symbols: bytes) -> tuple[bytes, np.ndarray]:
        """The symbols in front that fill no block, and the block numbers."""
        odd = len(symbols) % self.block
        whole = np.frombuffer(symbols, np.uint8)[odd:].reshape(-1, self.block).astype(np.int64)
        return symbols[:odd], whole @ (9 ** np.arange(self.block - 1, -1, -1, dtype=np.int64))

    def through(self, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each vector behind the symbols the one in front and the cost."""
        odd, blocks = self._cut(symbols)
        at, total = np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        for b in blocks[::-1]:
            total += self.many_cost[at, b]
            at = self.many[at, b]
        for s in odd[::-1]:
            total += self.one_cost[at, s]
            at = self.one[at, s]
        return at, total

    def trace(self, symbols: bytes, behind: int, place: int) -> tuple[str, list[tuple[int, int, int]], int]:
        """The letters of all edits; of each repaired row its row number (that
        of the next row, if inserted), its place and what it is; and the place
        at the end."""
        odd, blocks = self._cut(symbols)
        ends = [behind]  # the vector behind each block, the last block's first
        for b in blocks[::-1]:
            ends.append(int(self.many[ends[-1], b]))
        letters: list[str] = []
        slots: list[tuple[int, int, int]] = []
        parts = [odd] + [symbols[i:i + self.block] for i in range(len(odd), len(symbols), self.block)]
        number = 0
        for part, end in zip(parts, ends[::-1]):
            rows = [self.vectors[end]]  # the vectors in front of the block's rows
            for s in part[::-1]:
                rows.append(_before(s, rows[-1]))
            rows.reverse()
            for k, s in enumerate(part):
                letter = "I"
                while letter == "I":
                    letter, place = _least(s, place, rows[k], rows[k + 1])
                    letters.append(letter)
                    if letter != "D":
                        slots.append((number, place, "KRI".index(letter)))
                number += 1
        return "".join(letters), slots, place


@cache
def _least(symbol: int, place: int, here: tuple[int, ...], behind: tuple[int, ...]) -> tuple[str, int]:
    """The least letter on a cheapest path, and the next place."""
    found = [(letter, q) for letter, c, q in _moves(symbol, place) if c + behind[q] == here[place]]
    if 2 + here[_inserted(place)] == here[place]:
        found.append(("I", _inserted(place)))
    return min(found)


#: Places of the rows inserted behind the last row, by the place there.
_CLOSING = {START: [], ASSISTANT: [], USER: [ASSISTANT], SYSTEM: [USER, ASSISTANT]}


@cache
def tables(block: int = BLOCK) -> Tables:
    """One set of tables per block length and Python worker."""
    return Tables(block)


# --- the Spark job --------------------------------------------------------

_SEGMENT = "conv string, seg long, symbols binary, front binary, cost binary, illegal long, head int, tail int"
_TRACED = "conv string, seg long, start int, last int, paid long, audit string, slots binary"
_KEEP, _ROLE, _INSERT, _CLOSE = range(4)  # what a repaired row is
_SLOTS = np.dtype([("row", "<i4"), ("place", "u1"), ("kind", "u1")])
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def _batches(rows: Iterator[tuple], schema: str, size: int = 2000) -> Iterator[pa.RecordBatch]:
    fields = [f.split(" ") for f in schema.split(", ")]
    while part := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, (_, t) in zip(zip(*part), fields)],
                                         [n for n, _ in fields])


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _ordered(conversations: DataFrame) -> DataFrame:
    """Rows with ``pos``, ascending by conversation, turn, role and a digest of
    role and text; the role's class; and the symbol that the row alone gives."""
    role = (F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1)
            .when(F.col("role").startswith("a"), 2).otherwise(3))
    symbol = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), GONE)
              .otherwise(role + F.when(F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 0).otherwise(4)))
    order = ["conv", "turn", "role", "digest"]
    return (conversations.select(
        "conv", "turn", "role", "text", role.cast("int").alias("kind"), symbol.cast("int").alias("symbol"),
        F.sha2(F.concat_ws("\0", F.length("role").cast("string"), "role", "text"), 256).alias("digest"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("pos", F.monotonically_increasing_id()))


def _segment(most: int):
    """(conv, pos, kind, symbol) by pos -> one row per segment, whose positions
    are consecutive."""
    def segments(rows: Iterator[tuple]) -> Iterator[tuple]:
        table = tables()
        conv, first, kinds, symbols = None, 0, bytearray(), bytearray()

        def out():
            front, cost = table.through(bytes(symbols))
            illegal = sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:]))
            return (conv, first, bytes(symbols), front.astype("<i4").tobytes(), cost.astype("<i8").tobytes(),
                    illegal, kinds[0], kinds[-1])

        for own, pos, kind, symbol in rows:
            if symbols and (own != conv or pos != first + len(symbols) or len(symbols) == most):
                yield out()
                symbols.clear()
                kinds.clear()
            if not symbols:
                conv, first = own, pos
            kinds.append(kind)
            symbols.append(symbol)
        if symbols:
            yield out()

    return lambda batches: _batches(segments(_rows_of(batches)), _SEGMENT)


def _chain_back(group: pd.DataFrame) -> pd.DataFrame:
    """The segments of one conversation, last first: the vector behind each."""
    group = group.sort_values("seg", ascending=False)
    table = tables()
    at, behind = table.end, []
    for front in group["front"]:
        behind.append(at)
        at = int(np.frombuffer(front, "<i4")[at])
    return pd.DataFrame({"conv": group["conv"], "seg": group["seg"], "behind": behind,
                         "is_first": group["seg"] == group["seg"].min(), "is_last": group["seg"] == group["seg"].max()})


def _chain_on(group: pd.DataFrame) -> pd.DataFrame:
    """The traces of one conversation's segments: those that follow each other."""
    group = group.sort_values("seg")
    last = {(s, p): q for s, p, q in zip(group["seg"], group["start"], group["last"])}
    place, segs, starts = START, sorted(set(group["seg"])), []
    for seg in segs:
        starts.append(place)
        place = last[seg, place]
    return pd.DataFrame({"conv": group["conv"].iloc[0], "seg": segs, "start": starts})


def _trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, seg, symbols, front, cost, behind, is_first, is_last) -> per place
    to start from the edits of the segment, and what its rows add to the cost."""
    table = tables()

    def traces():
        for conv, seg, symbols, front, cost, behind, is_first, is_last in _rows_of(batches):
            paid = int(np.frombuffer(cost, "<i8")[behind])
            if is_first:
                paid += table.vectors[np.frombuffer(front, "<i4")[behind]][START]
            for start in (START,) if is_first else range(4):
                audit, slots, last = table.trace(symbols, behind, start)
                if is_last:
                    slots += [(len(symbols) - 1, place, _CLOSE) for place in _CLOSING[last]]
                    audit += "I" * len(_CLOSING[last])
                yield conv, seg, start, last, paid, audit, np.array(slots, _SLOTS).tobytes()

    return _batches(traces(), _TRACED)


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, seg, slots) -> the repaired rows, each with ``pos`` of the row it
    is, or stands in front of (or, at the end, behind), and ``sub`` among them."""
    def rows():
        for conv, seg, slots in _rows_of(batches):
            row_before = sub = -1
            for row, place, kind in np.frombuffer(slots, _SLOTS).tolist():
                sub = sub + 1 if row == row_before else 0
                row_before = row
                yield conv, seg + row, sub, None if kind == _KEEP else _NAMES[place], kind
    return _batches(rows(), "conv string, pos long, sub int, role string, kind int", 20_000)


def _hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, line) in order -> SHA-256 of each conversation's lines joined by
    line feeds; only the digest's state is held."""
    def rows():
        conv, state = None, None
        for own, line in _rows_of(batches):
            if state is None or own != conv:
                if state:
                    yield conv, state.hexdigest()
                conv, state = own, hashlib.sha256(line.encode())
            else:
                state.update(b"\n")
                state.update(line.encode())
        if state:
            yield conv, state.hexdigest()
    return _batches(rows(), "conv string, repaired_sha256 string")


class Repaired(NamedTuple):
    """What ``repair`` finds; each table has ``conv``, a string for conv_id."""
    conversations: DataFrame  #: conv, conv_id: all there are, also those without rows
    rows: DataFrame  #: conv, turn, role, text, pos, in the order of pos
    faults: DataFrame  #: conv, pos, fault (1 blank, 2 duplicate, 3 truncated, else 0)
    edits: DataFrame  #: conv, audit, cost
    illegal: DataFrame  #: conv, illegal: neighbouring roles that may not follow each other
    repaired: DataFrame  #: conv, pos, sub, role, text: the repaired rows, in the order of (pos, sub)


def repair(conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> Repaired:
    """``conversations``: conv_id, turn, role, text; a row whose role and text
    are both null only says that there is such a conversation."""
    own = materialize(conversations.select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")), "conversations")
    rows = materialize(_ordered(own.where("role is not null or text is not null").fillna(" ", ["role", "text"])), "turns")
    firsts = (rows.where(F.col("symbol") != GONE).groupBy("conv", "digest").agg(F.min("pos").alias("pos"))
              .select("pos", F.lit(True).alias("is_first")))
    fault = (F.when(F.col("symbol") == GONE, 1).when(F.col("is_first").isNull(), 2)
             .when(F.col("symbol") >= 4, 3).otherwise(0))
    marks = materialize(rows.select("conv", "pos", "kind", "symbol").join(firsts, "pos", "left").select(
        "conv", "pos", "kind", F.when(F.col("is_first").isNull(), GONE).otherwise(F.col("symbol")).alias("symbol"),
        fault.alias("fault")), "marks")

    segments = materialize(marks.select("conv", "pos", "kind", "symbol").repartitionByRange("pos")
                           .sortWithinPartitions("pos").mapInArrow(_segment(segment_rows), _SEGMENT), "segments")
    split = segments.groupBy("conv").count().where("count > 1").select("conv")
    behind = segments.join(split, "conv", "left_semi").groupBy("conv").applyInPandas(
        _chain_back, "conv string, seg long, behind int, is_first boolean, is_last boolean")
    whole = F.lit(True)
    traced = materialize(segments.join(behind, ["conv", "seg"], "left").select(
        "conv", "seg", "symbols", "front", "cost", F.coalesce("behind", F.lit(tables().end)),
        F.coalesce("is_first", whole), F.coalesce("is_last", whole)).mapInArrow(_trace, _TRACED), "traces")
    starts = (traced.join(split, "conv", "left_semi").select("conv", "seg", "start", "last").groupBy("conv")
              .applyInPandas(_chain_on, "conv string, seg long, start int"))
    chosen = traced.join(split, "conv", "left_anti").unionByName(
        traced.join(starts, ["conv", "seg", "start"], "left_semi"))
    in_order = F.array_sort(F.collect_list(F.struct("seg", "audit")))
    edits = chosen.groupBy("conv").agg(F.array_join(F.transform(in_order, lambda x: x["audit"]), "").alias("audit"),
                                       F.sum("paid").alias("cost"))

    follows = F.lag("tail").over(Window.partitionBy("conv").orderBy("seg"))
    allowed = F.array(*[F.lit(a * 4 + b) for a, b in sorted(_LEGAL)])
    crossing = F.when(F.col("before").isNull() | F.array_contains(allowed, F.col("before") * 4 + F.col("head")), 0)
    illegal = (segments.select("conv", "illegal", "head", follows.alias("before")).groupBy("conv")
               .agg(F.sum(F.col("illegal") + crossing.otherwise(1)).alias("illegal")))

    slots = (chosen.select("conv", "seg", "slots")
             .mapInArrow(_expand, "conv string, pos long, sub int, role string, kind int"))
    repaired = (slots.join(rows.select("pos", F.col("role").alias("own"), "text"), "pos")
                .select("conv", "pos", "sub", F.coalesce("role", "own").alias("role"),
                        F.when(F.col("kind") <= _ROLE, F.col("text")).otherwise("").alias("text")))
    return Repaired(own.select("conv", "conv_id").distinct(), rows.select("conv", "turn", "role", "text", "pos"),
                    marks.select("conv", "pos", "fault"), edits, illegal, repaired)


def report(found: Repaired) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256."""
    turns = found.rows.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    faults = found.faults.groupBy("conv").agg(*[
        F.sum((F.col("fault") == i).cast("long")).alias(name)
        for i, name in enumerate(("blank", "duplicate", "truncated"), 1)])
    lines = (found.repaired.select("conv", "pos", "sub", F.concat("role", F.lit(":"), "text").alias("line"))
             .repartition("conv").sortWithinPartitions("conv", "pos", "sub").select("conv", "line"))
    digest = lines.mapInArrow(_hash_lines, "conv string, repaired_sha256 string")
    zero = F.lit(0).cast("long")
    out = found.conversations
    for part in (turns, faults, found.illegal, found.edits, digest):
        out = out.join(part, "conv", "left")
    return out.select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
