"""Removal of long repeated strings by two-stage suffix sorting.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else, in another document or the same one.

1. Anchors.  Every ``GRAM``-byte gram is hashed; a string's anchor is the least
   gram hash inside it.  Equal strings have equal anchors, so a run of
   consecutive strings with one anchor is a segment, and only segments of one
   anchor can hold a common string.  Anchors met once end here.
2. Segments of equal content are counted and one of them goes on (a grouped
   count, so copies cost nothing more).
3. The segments of an anchor meet in one task, many anchors at a time, and are
   sorted as suffixes in two stages: the suffixes smaller than their
   successors directly, the others induced by scanning the buckets of first
   bytes in order.  Adjacent common prefixes of ``length`` bytes or more mark
   what is repeated; a segment counted more than once is repeated throughout.
4. Marks go back to all places of their segment, and each document is cut.

An anchor with more than ``HOT_VARIANTS`` different segments is not given to
one task: its strings are counted by their hashes, spread over all tasks.

Null text is empty.  Rows are told apart by doc_id and text, and repeated rows
count as copies of each other.  A string that starts at several places ties
with itself only: all of them go.  An empty table gives no rows.  Only doc_id
and text are read, so other columns never clash.  Strings are compared through
64-bit hashes where whole segments are equal and in anchors beyond
``HOT_VARIANTS``; all else is compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize, text_or_empty
from parcelflow.llm.textbatch import _powers, mix, slices

GRAM = 32
CHUNK_BYTES = 1 << 19
HOT_VARIANTS = 20_000
#: Bytes of text looked at together.
SLICE = 1 << 20
_BREAK = 0xFF  # between segments; no byte of UTF-8

_ODD = mix(np.arange(1, 20, dtype=np.uint64)) | np.uint64(1)
_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD[0])


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-byte grams, joined from halves."""
    out, have, parts = _CODE[data], 1, []
    at = 0
    while True:
        if size & have:
            parts.append((at, have, out))
            at += have
        if at == size:
            break
        out = out[:len(out) - have] * _ODD[have.bit_length()] + out[have:]
        have *= 2
    n = max(len(data) - size + 1, 0)
    total = np.zeros(n, np.uint64)
    for shift, have, part in parts:
        total = total * _ODD[18 - have.bit_length()] + part[shift:shift + n]
    return mix(total)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def segments(data: np.ndarray, offsets: np.ndarray, length: int):
    """Of a slice: document, anchor, content hash, begin and end of each
    segment, and whether its anchor's gram stands in it more than once (only
    then can a segment hold a string twice)."""
    gram = min(GRAM, length)
    sizes = np.diff(offsets)
    docs = np.flatnonzero(sizes >= length)
    if not len(docs):
        return (*(np.zeros(0, np.int64),) * 5, np.zeros(0, bool))
    grams = gram_hashes(data, gram)
    low = _least(grams, length - gram + 1)
    starts = np.concatenate([np.arange(offsets[d], offsets[d + 1] - length + 1) for d in docs])
    anchor = low[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (anchor[1:] != anchor[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    begin, end = starts[first], starts[last] + length
    mult = _ODD[1]
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * _powers(mult, len(data)), out=total[1:])
    back = _powers(np.uint64(pow(int(mult), -1, 1 << 64)), len(data))
    content = mix((total[end] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    doc = np.searchsorted(offsets, begin, "right") - 1
    size = end - begin - gram + 1
    cut = np.cumsum(size) - size
    inside = np.arange(size.sum()) + np.repeat(begin - cut, size)
    twice = np.add.reduceat(grams[inside] == np.repeat(anchor[first], size), cut, dtype=np.int64) > 1
    return (doc, anchor[first].view(np.int64), content.view(np.int64), begin - offsets[doc], end - offsets[doc], twice)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes by their first ``depth`` bytes at least, in two stages."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth, np.uint8)])
    step = np.sign(text[1:].astype(np.int16) - text[:-1])  # 1: smaller than its successor by the first byte
    change = np.flatnonzero(step)
    follow = np.searchsorted(change, np.arange(n - 1))
    kind = np.append(step, 0)[np.append(change, n - 1)[follow]] if n > 1 else np.zeros(0, int)
    smaller = np.append(kind >= 0, True)  # equal bytes to the end: sorted directly too
    direct = np.flatnonzero(smaller)
    keys = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(keys).view(f"S{depth}").ravel(), kind="stable")]
    edge = np.searchsorted(text[direct], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in np.unique(text).tolist():
        induced = []
        found = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(found):  # runs of the same byte, a byte longer each time
            induced.append(found)
            found = found[found > 0] - 1
            found = found[(text[found] == c) & ~smaller[found]]
        bucket = np.concatenate([*induced, direct[edge[c]:edge[c + 1]]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[text[before] > c]  # all larger than their successors
        before = before[np.argsort(text[before], kind="stable")]
        byte, first = np.unique(text[before], return_index=True)
        for b, part in zip(byte.tolist(), np.split(before, first[1:])):
            waiting[b].append(part)
    return np.concatenate(out)


def repeated(parts: list[bytes], counts: list[int], length: int) -> list[list[int]]:
    """Per part, begin and end of each stretch covered by strings that also
    start elsewhere among the parts, or all of a part counted twice or more."""
    text = np.frombuffer(bytes([_BREAK]).join(parts) + bytes([_BREAK]), np.uint8)
    sizes = np.array([len(p) for p in parts])
    base = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    room = np.repeat(base + sizes, sizes + 1) - np.arange(len(text))  # bytes left in the part
    order = suffix_order(text, length)
    order = order[room[order] >= length]
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    a, b = order[:-1], order[1:]
    alike = np.ones(len(a), bool)
    for s in range(0, len(a), 1 << 15):
        same = view[a[s:s + (1 << 15)]] == view[b[s:s + (1 << 15)]]
        alike[s:s + (1 << 15)] = same.all(axis=1)  # their common prefix reaches the length
    marks = np.unique(np.concatenate([a[alike], b[alike]]))
    part = np.searchsorted(base, marks, "right") - 1
    new = np.ones(len(marks), bool)
    new[1:] = (part[1:] != part[:-1]) | (marks[1:] > marks[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first, len(marks))[1:] - 1
    out: list[list[int]] = [[] for _ in parts]
    for p, s, e in zip(part[first].tolist(), marks[first].tolist(), marks[last].tolist()):
        out[p] += [s - int(base[p]), e - int(base[p]) + length]
    for p, n in enumerate(counts):
        if n > 1:
            out[p] = [0, len(parts[p])]
    return out


def _places(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch, limit=SLICE):
                doc, anchor, content, begin, end, twice = segments(data, offsets, length)
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(anchor), pa.array(content),
                     pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(twice)],
                    ["d", "key", "a", "s", "b", "e", "twice"])

    return run


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, limit=SLICE):
            rows = []
            for d, own in enumerate(part.column(1).to_pylist()):
                text = data[offsets[d]:offsets[d + 1]]
                rows += [(x["a"], x["s"], x["n"], x["hot"], text[x["b"]:x["e"]].tobytes()) for x in own]
            c = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()),
                 pa.array(c[3], pa.bool_()), pa.array(c[4], pa.binary())], ["a", "s", "n", "hot", "bytes"])


def _sort_groups(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def out():
            marks = repeated([x[3] for x in held], [x[2] for x in held], length)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in held], pa.int64()), pa.array([x[1] for x in held], pa.int64()),
                 pa.array(marks, pa.list_(pa.int32()))], ["a", "s", "marks"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size >= CHUNK_BYTES and row[0] != held[-1][0]:  # whole anchors only
                    yield out()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield out()

    return run


def _strings(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, s, n, raw in zip(*(batch.column(i).to_pylist() for i in range(4))):
                w = gram_hashes(np.frombuffer(raw, np.uint8), length).view(np.int64)
                k = len(w)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w), pa.array(np.full(k, a)), pa.array(np.full(k, s)), pa.array(np.full(k, n)),
                     pa.array(np.arange(k, dtype=np.int32))], ["w", "a", "s", "n", "at"])

    return run


def deduplicate(docs: DataFrame, length: int = 200, hot_variants: int = HOT_VARIANTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (begin and end byte of each
    maximal removed run, flat) and kept (the other bytes)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    # A row is (d, key), neither of them null; the key tells a null doc_id from 0.
    texts = texts.select("doc_id", F.coalesce("doc_id", F.lit(0)).alias("d"), F.xxhash64("doc_id", "text").alias("key"),
                         "text")
    places = materialize(texts.select("d", "key", "text").mapInArrow(
        _places(length), "d long, key long, a long, s long, b int, e int, twice boolean"), "places")
    shared = places.groupBy("a").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n")).where("n > 1").select("a")
    places = materialize(places.join(shared, "a"), "shared")

    kinds = places.groupBy("a", "s").agg(F.count("*").alias("n"), F.min(F.struct("d", "key", "b", "e")).alias("x"))
    wide = (kinds.groupBy("a").agg(F.count("*").alias("variants"))
            .select("a", (F.col("variants") > hot_variants).alias("hot")))
    wanted = (kinds.join(wide, "a").select("x.d", "x.key", F.struct("a", "s", "n", "hot", "x.b", "x.e").alias("segment"))
              .groupBy("d", "key").agg(F.collect_list("segment").alias("segments")))
    one = texts.select("d", "key", "text").dropDuplicates(["d", "key"])  # dealt out as the join wants it
    cut = (one.join(wanted, ["d", "key"]).select(F.lit(0), "segments", "text")
           .mapInArrow(_cut_segments, "a long, s long, n long, hot boolean, bytes binary"))
    cut = materialize(cut, "segments")
    sorted_in = cut.where("not hot").select("a", "s", "n", "bytes").repartition("a").sortWithinPartitions("a")
    marks = sorted_in.mapInArrow(_sort_groups(length), "a long, s long, marks array<int>")

    strings = cut.where("hot").select("a", "s", "n", "bytes").mapInArrow(
        _strings(length), "w long, a long, s long, n long, at int")
    twice = strings.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
    marks = marks.union(strings.join(twice, "w").groupBy("a", "s").agg(F.collect_list("at").alias("at"))
                        .select("a", "s", F.flatten(F.transform("at", lambda x: F.array(x, x + length)))))
    marks = materialize(marks.where("size(marks) > 0"), "marks")

    found = (places.join(marks, ["a", "s"])
             .select("d", "key", F.transform("marks", lambda x: x + F.col("b")).alias("m"))
             .groupBy("d", "key").agg(F.flatten(F.collect_list("m")).alias("marks")))
    return (texts.join(found, ["d", "key"], "left").select("doc_id", "marks", "text")
            .mapInArrow(_apply, "doc_id long, n_bytes long, spans array<int>, kept binary"))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in slices(batch, limit=SLICE):
            spans, kept = [], []
            for d, flat in enumerate(part.column(1).to_pylist()):
                text, runs, at, rest = data[offsets[d]:offsets[d + 1]], [], 0, []
                for b, e in sorted(zip(flat[::2], flat[1::2])) if flat else ():
                    if runs and b <= runs[-1]:
                        runs[-1] = max(runs[-1], e)
                    else:
                        runs += [b, e]
                for b, e in zip(runs[::2], runs[1::2]):
                    rest.append(text[at:b].tobytes())
                    at = e
                spans.append(runs)
                kept.append(b"".join([*rest, text[at:].tobytes()]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.diff(offsets)), pa.array(spans, pa.list_(pa.int32())),
                 pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def report(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
