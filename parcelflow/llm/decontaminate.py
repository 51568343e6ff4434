"""Benchmark decontamination by a broadcast hash set of item n-grams.

Words are runs of digits, lower-cased Latin letters and non-ASCII characters.
Each window of ``n`` consecutive item words (a shorter item is one window) is
hashed; the hashes and the windows' words are broadcast in blocks of at most
``BLOCK_WINDOWS`` windows, so a broadcast never grows with the benchmark.
Documents stream past each block without a shuffle: all their windows are
hashed at once, and a hash hit counts only when the words are the same.

Null text has no words, and an item without words no window.  An item with a
null id is named "null".  Repeated documents and items are judged each on its
own; an empty benchmark or table hits nothing.  Columns of the input other
than those named are passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import with_own_names
from parcelflow.llm.textbatch import ALNUM_WORDS, Words, hash_runs, slices

BLOCK_WINDOWS = 200_000
_FOUND = [("_n_words", pa.int64()), ("_hits", pa.list_(pa.int64())), ("_items", pa.list_(pa.string()))]


def item_windows(items: DataFrame, n: int) -> DataFrame:
    """(hash, size, words, item): the distinct windows of each item."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                w, rows = Words(data, offsets, ALNUM_WORDS), []
                for d, item in enumerate(part.column(0).to_pylist()):
                    first, last = w.first[d], w.first[d + 1]
                    size = int(min(n, last - first))
                    if size:
                        at = np.arange(first, last - size + 1)
                        for i, h in zip(at, hash_runs(w.hash, at, size)):
                            rows.append((int(h.astype(np.int64)), size,
                                         b" ".join(w.word(j) for j in range(i, i + size)), item))
                h, size, words, item = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(size, pa.int32()), pa.array(words, pa.binary()),
                     pa.array(item, pa.string())], ["hash", "size", "words", "item"])

    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                         F.col("text").cast("string").alias("text"))
    return named.mapInArrow(cut, "hash long, size int, words binary, item string").distinct()


def _merged(flat: list[int]) -> list[int]:
    """The union of runs given as begin, end, begin, end, ... in any order."""
    out: list[int] = []
    for begin, end in sorted(zip(flat[::2], flat[1::2])):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [begin, end]
    return out


def _scan(block: list[tuple[int, int, bytes, str]]):
    """A pass over documents that adds one block's hits to what passes before
    found; _hits holds begin and end word of each maximal hit run, flat."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, dict[int, dict[bytes, list[str]]]] = {}
        for h, size, words, item in block:
            known.setdefault(size, {}).setdefault(h & (1 << 64) - 1, {}).setdefault(words, []).append(item)
        tables = {}
        for size, by_hash in known.items():
            maybe = np.zeros(1 << 20, bool)
            hashes = np.sort(np.fromiter(by_hash, np.uint64, len(by_hash)))
            maybe[hashes >> np.uint64(44)] = True
            tables[size] = maybe, hashes
        for batch in batches:
            for part, data, offsets in slices(batch):
                w = Words(data, offsets, ALNUM_WORDS)
                hits: list[list[int]] = [list(x or ()) for x in part.column("_hits").to_pylist()]
                items = [set(x or ()) for x in part.column("_items").to_pylist()]
                last = np.repeat(w.first[1:], w.count)
                for size, (maybe, hashes) in tables.items():
                    at = np.arange(len(w.hash))
                    at = at[at + size <= last]
                    got = hash_runs(w.hash, at, size)
                    at, got = (x[maybe[got >> np.uint64(44)]] for x in (at, got))
                    near = np.searchsorted(hashes, got)
                    same = hashes[np.minimum(near, len(hashes) - 1)] == got
                    at, got = at[same], got[same]
                    for i, h, d in zip(at.tolist(), got.tolist(), np.searchsorted(w.first, at, "right") - 1):
                        owners = known[size][h].get(b" ".join(w.word(j) for j in range(i, i + size)))
                        if owners:
                            begin = i - int(w.first[d])
                            hits[d] += [begin, begin + size]
                            items[d].update(owners)
                columns = [part.column(i) for i in range(part.num_columns - 3)]
                columns += [pa.array(w.count, pa.int64()), pa.array([_merged(x) for x in hits], _FOUND[1][1]),
                            pa.array([sorted(x) for x in items], _FOUND[2][1])]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return scan


def find(docs: DataFrame, items: DataFrame, n: int = 10, then=None) -> DataFrame:
    """The documents with ``_n_words``, ``_hits`` (begin and end word of each
    maximal hit run, flat) and ``_items`` (sorted item names).  ``then`` is
    applied to the batches behind the last pass, in the same Python workers."""
    found = item_windows(items, n)
    blocks = max(1, -(-found.count() // BLOCK_WINDOWS))
    docs = docs.drop(*(c for c, _ in _FOUND))
    out = docs.withColumns({"text": F.col("text").cast("string"), "_n_words": F.lit(None).cast("long"),
                            "_hits": F.lit(None).cast("array<long>"),
                            "_items": F.lit(None).cast("array<string>")})
    out = out.select(*[c for c in out.columns if not c.startswith("_") or c in docs.columns],
                     *[c for c, _ in _FOUND])
    for b in range(blocks):
        block = [tuple(r) for r in found.where(F.pmod("hash", F.lit(blocks)) == b)
                 .orderBy("hash", "words", "item").collect()]
        scan = _scan(block)
        out = out.mapInArrow((lambda batches, scan=scan: then(scan(batches))) if then and b == blocks - 1 else scan, out.schema)
    return out


def report(found: DataFrame) -> DataFrame:
    """One row per document: counts of words, hit words and items."""
    return (found.withColumn("n_hit", F.aggregate(
        F.transform("_hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
        F.lit(0).cast("long"), lambda total, x: total + x))
            .select("doc_id", F.col("_n_words").alias("n_words"), "n_hit",
                    F.size("_items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", F.array_sort("_items")), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated")))


def clean(docs: DataFrame, items: DataFrame, n: int = 10, max_share: float = 0.5) -> DataFrame:
    """Documents in which at most ``max_share`` of the words are hit, without
    their hit spans; the others are removed.  ``text`` changes only where
    something was hit, and ``n_chars`` (if there) with it; all other columns
    come back as they were, whatever their names."""
    return with_own_names(docs, [c for c, _ in _FOUND], lambda own: _clean(own, items, n, max_share))


def _clean(docs: DataFrame, items: DataFrame, n: int, max_share: float) -> DataFrame:
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for part, data, offsets in slices(batch):
                texts, keep, w = part.column(text).to_pylist(), np.ones(part.num_rows, bool), None
                for d, flat in enumerate(part.column("_hits").to_pylist()):
                    if not flat:
                        continue
                    w = w or Words(data, offsets, ALNUM_WORDS)
                    runs = list(zip(flat[::2], flat[1::2]))
                    if sum(e - s for s, e in runs) > max_share * w.count[d]:
                        keep[d] = False
                        continue
                    at, kept = offsets[d], []
                    for s, e in runs:
                        kept.append(data[at:w.start[w.first[d] + s]].tobytes())
                        at = w.end[w.first[d] + e - 1]
                    texts[d] = b"".join([*kept, data[at:offsets[d + 1]].tobytes()]).decode("utf-8", "replace")
                columns = [pa.array(texts, pa.string()) if i == text else part.column(i)
                           for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names).filter(pa.array(keep))

    out = find(docs, items, n, strip)
    if "n_chars" in docs.columns:
        changed = F.size("_hits") > 0
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def items_digest(items: list[str]) -> str:
    """What ``report`` gives as items_sha256, for a list of names."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
