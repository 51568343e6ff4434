"""Embedding near-duplicates by sorted passes over random projections.

Equal vectors (after scaling to length 1) collapse into one class first.  In
every pass each class gets a key of concatenated random hashes, the signs of
projections drawn for that pass, and a tie-break, the value of one more
projection.  Classes are ordered lexicographically by label, key and tie-break
through a range shuffle, so a label with a third of all rows spans many tasks,
and numbered; each is compared by cosine in double precision with the
``WINDOW`` classes behind it.  Blocks of ``WINDOW`` consecutive numbers meet in
one task with the block behind them, whatever the data.

A run of equal keys longer than the window is compared whole as well, in tiles
of two blocks, so a dense group loses no link.  With that, every pair that
agrees in all signs of some pass is found.  Bits and passes follow the size of
the label: evenly spread vectors give runs of about a window, and a pair at the
threshold agrees in no pass with probability at most ``MISS`` (two vectors at an
angle of a agree in a sign with probability 1 - a / pi).

A pair is counted in the first pass that compares it, which the numbers of both
in all passes tell.  No list of pairs is made: a task gives the number of links
of each class and the edge to its root among them.  Components of those edges
unite the verified pairs of all passes.

Null labels, null, zero, empty or non-finite vectors link with nothing, nor do
vectors of different lengths.  Rows with the same vec_id are one node; a null
vec_id stands alone.  An empty table gives no rows.  Only vec_id, label and
embedding are read, so other columns never clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize
from parcelflow.llm.graph import components, contract

WINDOW = 1024
MISS = 1e-5


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    cut = np.concatenate([[0], np.cumsum(np.array([0 if n is None else n for n in
                                                   column.value_lengths().to_pylist()]))])
    return [flat[cut[i]:cut[i + 1]] for i in range(len(column))]


def unit_vectors(rows: DataFrame) -> DataFrame:
    """vec_id, label and unit vector (doubles as bytes; null where it can link
    with nothing)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, v in zip(batch.column(1).to_pylist(), _vectors(batch.column(2))):
                top = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
                if label is None or not top > 0:
                    out.append(None)
                else:
                    v = v / top
                    out.append((v / np.sqrt((v * v).sum())).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())],
                                             ["vec_id", "label", "unit"])

    return (rows.select(F.col("vec_id").cast("long"), F.col("label").cast("string"),
                        F.col("embedding").cast("array<double>"))
            .mapInArrow(run, "vec_id long, label string, unit binary"))


def cut(n: int, least: float, window: int) -> tuple[int, int]:
    """Bits and passes for a label of n classes."""
    bits = max(0, math.ceil(math.log2(n / window))) if n > window else 0
    agree = (1 - math.acos(max(-1.0, min(least, 1.0))) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree)) if agree < 1 - MISS else 1


def _keys(units: list[bytes], bits: int, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """For vectors of one length: in each pass the signs of ``bits`` random
    projections, as a number, and the value of one more."""
    v = np.frombuffer(b"".join(units)).reshape(len(units), -1)
    key, tie = np.zeros((len(units), passes), np.int64), np.zeros((len(units), passes))
    for k in range(passes):
        planes = np.random.default_rng([k, v.shape[1]]).standard_normal((v.shape[1], bits + 1))
        value = v @ planes
        key[:, k] = (value[:, :bits] > 0) @ (1 << np.arange(bits - 1, -1, -1))
        tie[:, k] = value[:, bits]
    return key, tie


def _keyed(least: float, window: int):
    """(class, label, unit, members) -> class, label, size, and per pass a row
    with its key and tie-break."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2).to_pylist()
            kinds: dict[tuple, list[int]] = {}
            for i, (u, n) in enumerate(zip(units, batch.column(3).to_pylist())):
                kinds.setdefault((len(u), *cut(n, least, window)), []).append(i)
            for (size, bits, passes), own in kinds.items():
                key, tie = _keys([units[i] for i in own], bits, passes)
                at = pa.array(np.repeat(own, passes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(passes, dtype=np.int32), len(own))), batch.column(1).take(at),
                     pa.array(np.full(len(at), size, np.int32)), pa.array(key.ravel()), pa.array(tie.ravel()),
                     batch.column(0).take(at)], _ORDER)

    return run


_ORDER = ["pass", "label", "size", "key", "tie", "class"]


def ranked(classes: DataFrame, least: float, window: int) -> DataFrame:
    """class, and per pass its number in the order (``ranks``), and the first
    number and length of its run where that is longer than the window
    (``runs``, ``lengths``; else -1 and 0)."""
    sized = classes.select("class", "label", "unit", F.length("unit").alias("size"))
    members = sized.groupBy("label", "size").agg(F.count("*").alias("members"))
    keyed = (sized.join(members, ["label", "size"]).select("class", "label", "unit", "members")
             .mapInArrow(_keyed(least, window), "pass int, label string, size int, key long, tie double, class long"))
    placed = materialize(keyed.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
                         .withColumn("at", F.monotonically_increasing_id()), "order")
    # One row per task of the sort: where its numbers begin.
    part = F.shiftright("at", 33).alias("part")
    before = placed.groupBy(part).agg(F.count("*").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    ranks = placed.select("*", part).join(F.broadcast(before), "part").withColumn(
        "rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    run = ["pass", "label", "size", "key"]
    runs = (ranks.groupBy(*run).agg(F.min("rank").alias("run"), F.count("*").alias("length"))
            .where(F.col("length") > window + 1))
    rows = ranks.join(runs, run, "left").groupBy("class").agg(F.array_sort(F.collect_list(F.struct(
        "pass", "rank", F.coalesce("run", F.lit(-1)).alias("run"), F.coalesce("length", F.lit(0)).alias("length")))).alias("p"))
    return materialize(rows.select("class", *[F.col(f"p.{c}").alias(f"{c}s") for c in ("rank", "run", "length")]), "ranks")


def _compare(least: float, window: int, tiles: bool):
    """Of two blocks of neighbours, or of two blocks of a run: each class that
    has links no earlier pass has compared, their number and the class's edge."""
    def one(rows: pa.Table, k: int, first: int) -> list[np.ndarray]:
        number, rep, copies, block = (rows[c].to_numpy() for c in ("class", "rep", "copies", "block"))
        ranks, runs = (np.array(rows[c].to_pylist(), np.int64).reshape(len(rep), -1) for c in ("ranks", "runs"))
        order = np.argsort(ranks[:, k], kind="stable")
        number, rep, copies, block, ranks, runs = (x[order] for x in (number, rep, copies, block, ranks, runs))
        units = rows["unit"].to_pylist()
        v = np.frombuffer(b"".join([units[i] for i in order])).reshape(len(order), -1)
        links, ends = np.zeros(len(order), np.int64), [np.zeros((2, 0), np.int64)]
        own = np.flatnonzero(block == first)  # only these begin a pair; they come first
        for s in range(0, len(own), 256):
            e = min(s + 256, len(own))
            x, y = np.nonzero(v[s:e] @ v[s:].T >= least)
            x, y = x + s, y + s
            gap = ranks[y, k] - ranks[x, k]
            ok = (gap > window) & (block[y] != first) if tiles else (gap > 0) & (gap <= window)
            x, y = x[ok], y[ok]
            for j in range(k):  # compared in an earlier pass
                new = (np.abs(ranks[x, j] - ranks[y, j]) > window) & ((runs[x, j] < 0) | (runs[x, j] != runs[y, j]))
                x, y = x[new], y[new]
            links += np.bincount(x, copies[y], len(links)).astype(np.int64)
            links += np.bincount(y, copies[x], len(links)).astype(np.int64)
            ends.append(np.stack([x, y]))
        x, y = np.concatenate(ends, axis=1)
        node, root = contract(x, y) if len(x) else (x, x)
        return [number[node], links[node], rep[node], rep[root]]

    def run(rows: pa.Table) -> pa.Table:
        k, first = (rows[c][0].as_py() for c in ("pass", "i" if tiles else "block_key"))
        found = [[np.zeros(0, np.int64)] * 4]
        kinds = rows.group_by(["label", "size"]).aggregate([])
        for label, size in zip(kinds["label"].to_pylist(), kinds["size"].to_pylist()):
            own = rows.filter(pc.and_(pc.equal(rows["label"], label), pc.equal(rows["size"], size)))
            found.append(one(own, k, first))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*found)], ["class", "links", "a", "b"])

    return run


def link(classes: DataFrame, least: float, window: int) -> DataFrame:
    """classes: class, rep, label, unit, copies -> class, links (a number) and
    a, b (ids; the edges connect what the links connect)."""
    ranks = ranked(classes, least, window)
    rows = classes.withColumn("size", F.length("unit")).join(ranks, "class")
    rows = rows.select("*", F.posexplode(F.arrays_zip("ranks", "runs", "lengths")).alias("pass", "p"))
    keep = ["class", "rep", "copies", "label", "size", "unit", "ranks", "runs", "block"]
    told = "class long, links long, a long, b long"

    block = F.floor(F.col("p.ranks") / window)
    near = rows.withColumn("block", block).withColumn("block_key", F.explode(F.array(block, block - 1)))
    near = near.select("pass", "block_key", *keep).groupBy("pass", "block_key").applyInArrow(
        _compare(least, window, False), told)

    block = F.floor((F.col("p.ranks") - F.col("p.runs")) / window)
    tiles = (rows.where("p.runs >= 0").withColumns({"block": block, "run": F.col("p.runs")})
             .withColumn("x", F.explode(F.sequence(F.lit(0), F.floor((F.col("p.lengths") - 1) / window)))))
    tiles = tiles.withColumns({"i": F.least("block", "x"), "j": F.greatest("block", "x")}).where("i < j")
    tiles = tiles.select("pass", "run", "i", "j", *keep).groupBy("pass", "run", "i", "j").applyInArrow(
        _compare(least, window, True), told)
    return materialize(near.union(tiles), "links")


def near_duplicates(rows: DataFrame, least: float = 0.98, window: int = WINDOW) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    units = materialize(unit_vectors(rows), "units")
    live = units.where("unit is not null and vec_id is not null")
    classes = live.groupBy("label", "unit").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))
    classes = materialize(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    linked = link(classes.select("class", "rep", "label", "unit", "copies"), least, window)
    roots = components(linked.select("a", "b"))
    links = linked.groupBy("class").agg(F.sum("links").alias("links"))
    told = (classes.join(links, "class", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("label", "unit", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                    F.coalesce("root", "rep").alias("component")))
    named = F.col("vec_id").isNotNull()
    return (units.join(told, ["label", "unit"], "left")
            .select("vec_id", F.coalesce(F.when(named, F.col("n_links")), F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(F.when(named, F.col("component")), "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
