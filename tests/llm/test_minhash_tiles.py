"""Groups of near copies around the threshold: whole components, few links."""

import random

import pytest

from parcelflow.llm import graph, minhash_dedup
from tests.llm.test_operators import minhash_brute


def mutated(rnd, words, share):
    return " ".join(w if rnd.random() > share else f"{w}{rnd.randrange(50)}" for w in words)


@pytest.mark.parametrize("tile,tile_bytes", [(16, 1 << 24), (2048, 4000), (2048, 1 << 24)])
def test_near_copies_around_the_threshold(spark, monkeypatch, tile, tile_bytes):
    monkeypatch.setattr(minhash_dedup, "TILE", tile)
    monkeypatch.setattr(minhash_dedup, "TILE_BYTES", tile_bytes)
    rnd = random.Random(4)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(120)]
    rows = [(i, mutated(rnd, base, share)) for i, share in enumerate([0.004, 0.012, 0.02] * 40)]
    rows += [(500 + i, mutated(rnd, base[:60], 0.01)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    plan = minhash_dedup.Plan(words=5, percent=85)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df, plan).collect()}
    want, _ = minhash_brute(rows, 85)
    assert got == want and 1 < len(set(want.values())) < len(rows)


def test_a_tile_gives_fewer_links_than_members(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    rows = [(i, mutated(rnd, base, 0.003)) for i in range(90)]
    seen = []
    residual = minhash_dedup._residual

    def spy(*args):
        out = residual(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(minhash_dedup, "_residual", spy)
    monkeypatch.setattr(minhash_dedup, "FIRST_LINKS", 0)  # no links but those of the tiles
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(df).collect()}
    assert got == minhash_brute(rows, 85)[0]
    assert 0 < max(seen) < 2 * len(rows)  # of 4,005 pairs, over all buckets


@pytest.mark.parametrize("task_edges", [7, 500_000])
def test_components_over_many_tasks(spark, monkeypatch, task_edges):
    monkeypatch.setattr(graph, "TASK_EDGES", task_edges)
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rnd.randrange(40), 100 + rnd.randrange(40)) for _ in range(30)]
    edges += [(1000, 1001 + i) for i in range(50)] + [(5, 5), (7, 6)]
    root = {n: n for e in edges for n in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = graph.components(spark.createDataFrame(edges, "a long, b long").repartition(6))
    found = [(r.node, r.root) for r in got.collect()]
    assert sorted(found) == sorted((n, r) for n, r in root.items() if n != r)
