"""Sequence packing: shortest-pack-first over the length histogram.

Each document becomes token ids plus an end id and is cut into pieces of
``max_tokens`` ids and one remainder.  Only the histogram of piece lengths (at
most ``max_tokens`` numbers) reaches the driver, which places lengths longest
first, each into the packs that are shortest so far and still have room, and
counts packing patterns rather than documents.  Pieces then find their
sequence by their rank among the pieces of their length.  Ranks come from
counts per (length, salt), so a length that a third of all rows share is
spread over many tasks.

Null text counts as empty (its one piece is the end id).  Rows with equal or
null doc_id are packed as separate documents.  Pieces of one length are ranked
by salt, doc_id, start and ids; equal ones may change places, with equal
results.  No rows give no pieces.  Only doc_id and text are read, so other
columns never clash.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize
from parcelflow.llm.textbatch import slices
from parcelflow.llm.tokens import encoder

#: Pieces a salt group is meant to hold, over all lengths.
SALT_ROWS = 20_000
#: Bytes of text whose words are looked up together.
SLICE = 1 << 20


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 1024, end_id: int = 0,
           with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and the
    ids themselves (little-endian unsigned 32-bit) where ``with_ids``."""
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part, _, _ in slices(batch, limit=SLICE):
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows: list[tuple] = []
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode(texts)):
                    ids += end
                    for at in range(0, len(ids), 4 * max_tokens):
                        own = ids[at:at + 4 * max_tokens]
                        rows.append((doc_id, at // 4, len(own) // 4, zlib.crc32(own), len(ids) // 4)
                                    + ((own,) if with_ids else ()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.binary()) for c in columns[5:]],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).mapInArrow(cut, schema)


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in one sequence) and how many sequences follow each.

    Lengths are placed longest first.  All items of a length go to the packs
    with the most room (the shortest packs), as many at a time as there are
    packs of that pattern; what fits nowhere opens new packs.
    """
    open_packs: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by room left
    for length in range(size, 0, -1):
        left = int(histogram.get(length, 0))
        while left:
            room = max((r for r, packs in open_packs.items() if packs and r >= length), default=None)
            if room is None:
                open_packs[size - length].append(((length,), left))
                break
            pattern, count = open_packs[room].pop()
            take = min(count, left)
            if count > take:
                open_packs[room].append((pattern, count - take))
            open_packs[room - length].append((pattern + (length,), take))
            left -= take
    return [x for _, packs in sorted(open_packs.items()) for x in packs]


def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, first sequence and offset of each of its slots."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    base = 0
    for lengths, count in patterns:
        at = 0
        for n in lengths:
            found[n].append((count, base, at))
            at += n
        base += count
    out = {}
    for n, slots in found.items():
        count, first, at = map(np.array, zip(*slots))
        out[n] = (np.concatenate([[0], np.cumsum(count)[:-1]]), first, at)
    return out


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = 1024, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset (gapless from 0 in each sequence)."""
    cut = materialize(pieces(docs, tokenizer, max_tokens, end_id, with_ids), "pieces")
    by_length = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = _slots(shortest_pack_first(by_length, max_tokens))
    salts = 16 + sum(by_length.values()) // SALT_ROWS

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").count()
              .select("length", "salt", (F.sum("count").over(Window.partitionBy("length").orderBy("salt"))
                                         - F.col("count")).alias("before")))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (salted.withColumn("rank", F.row_number().over(order) - 1)
              .join(before, ["length", "salt"])
              .withColumn("rank", F.col("rank") + F.col("before")))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((2, len(length)), np.int64)
        size, at = length.to_numpy(), rank.to_numpy()
        for n in np.unique(size):
            own = np.flatnonzero(size == n)
            first_rank, first_sequence, offset = slots[int(n)]
            slot = np.searchsorted(first_rank, at[own], "right") - 1
            out[0, own] = first_sequence[slot] + at[own] - first_rank[slot]
            out[1, own] = offset[slot]
        return pd.DataFrame({"sequence_id": out[0], "offset": out[1]})

    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    return (ranked.withColumn("at", place("length", "rank"))
            .select(*keep, F.col("at.sequence_id"), F.col("at.offset")))


def sequences(packed: DataFrame, max_tokens: int = 1024) -> DataFrame:
    """From pieces packed with their ids: one row per sequence with its ids
    (pieces by offset, 4 bytes an id) and its padding up to ``max_tokens``, or
    none where its length is a power of two."""
    full = (packed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p")))
    total = F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["length"])
    return (full.select("sequence_id", total.alias("length"),
                        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
            .withColumn("padding", F.when(F.bit_count("length") == 1, 0).otherwise(max_tokens - F.col("length"))))
