"""Connected components of an edge table, by alternating star contraction.

Each round first contracts the edges of every task, about ``TASK_EDGES`` of
them, by union-find in numpy.  When all that is left fits one task, that was
the last step.  Otherwise it links all larger neighbours of a node to its least neighbour
(large star) and all smaller ones to the least (small star).  Both are a
grouped minimum (partial aggregation) and an equi-join that AQE may split, so
a node with a third of all edges never meets in one task.  Rounds grow with
the logarithm of the longest path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize

#: Edges that one task contracts.
TASK_EDGES = 500_000


def contract(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the given edges and the least node each one reaches."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        for x in (u, v, label[u], label[v]):
            np.minimum.at(new, x, least)
        new = new[new]
        if np.array_equal(new, label):
            return ids, ids[label]
        label = new


def _contract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def out(group):
        t = pa.Table.from_batches(group)
        node, root = contract(t["a"].to_numpy(), t["b"].to_numpy())
        keep = node != root
        return pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(root[keep])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= 2 * TASK_EDGES:
            yield out(held)
            held = []
    if held:
        yield out(held)


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids, in any order, loops and repeats allowed ->
    one row (node, root) per node that has an edge to another node; root is
    the least node it reaches.  No edges give no rows."""
    e = edges.select(F.greatest("a", "b").cast("long").alias("a"),
                     F.least("a", "b").cast("long").alias("b")).where("a > b")
    e, seen = materialize(e, "edges"), None
    while True:
        tasks = -(-e.count() // TASK_EDGES)
        e = e.coalesce(max(1, tasks)).mapInArrow(_contract_batches, "a long, b long")
        e = materialize(e if tasks <= 1 else e.distinct(), "edges")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tasks <= 1 or state == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
        both = e.select("a", "b").union(e.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        e = (large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
             .union(low.select("a", F.col("m").alias("b")))
             .where("a > b"))
        e = materialize(e, "edges")
