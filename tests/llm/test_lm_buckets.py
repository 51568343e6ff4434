"""The language model in turns and buckets: disk, and contexts too large for a bucket."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import lm_score
from parcelflow.session import ensure_checkpoint_dir


def brute(rows):
    """Score of each held-out or training row, with a tree held in memory."""
    rows = [(i, h, t.split() + [None]) for i, h, t in rows]
    count = Counter(w for _, h, ws in rows if not h for w in ws)
    z = sum(count.values()) + 0.1 * (len(count) + 1)
    own = {}
    for _, h, ws in rows:
        for i, w in enumerate(ws):
            for k in range(1, min(i, 3) + 1 if not h else 0):
                own.setdefault(tuple(ws[i - k:i]), Counter())[w] += 1
    size = {s: sum(c.values()) for s, c in own.items() if sum(c.values()) >= lm_score.MIN_COUNT}

    def probability(s, x):
        if not s:
            return (count[x] + 0.1) / z
        return (max(own[s][x] - 0.5, 0) + len(own[s]) / 2 * probability(s[1:], x)) / size[s]

    def divergence(s):
        return sum(n / size[s] * math.log(n / size[s] / probability(s[1:], x)) for x, n in own[s].items())

    single = {s for s in size if divergence(s) >= lm_score.MIN_DIVERGENCE}
    tree = {s[k:] for s in single for k in range(len(s))}
    scores = Counter()
    for i, _, ws in rows:
        logs = 0.0
        for at, x in enumerate(ws):
            s = next((s for k in (3, 2, 1) if at >= k and (s := tuple(ws[at - k:at])) in tree), ())
            logs += math.log10(probability(s, x))
        scores[i, round(logs, 6)] += 1
    return scores, tree, single, size, own


def size_of(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


@pytest.mark.parametrize("once", [False, True])
def test_lm_contexts_too_large_for_a_bucket(spark, monkeypatch, once):
    rng = random.Random(3)
    # Any word after any other: what follows two words differs little from what follows one.
    texts = [" ".join(rng.choice("abcd") for _ in range(rng.randrange(120))) for _ in range(90)]
    texts += ["the cat sat on the mat and the cat ran"] * 40 + ["a b c the cat sat on a"] * 30
    texts += [" ".join(rng.choice("abcdefghijklm") for _ in range(30)) for _ in range(30)]
    rows = [(None if n == 7 else n // 2, n % 9 == 0, t) for n, t in enumerate(texts)]
    scores, tree, single, size, own = brute(rows)
    monkeypatch.setattr(lm_score, "HOT", 25, raising=False)
    monkeypatch.setattr(lm_score, "BUCKET", 10, raising=False)
    hot = {s for s, n in size.items() if n >= 25}
    # Hot contexts of every size; kept, needed by longer ones only, and not kept.
    assert {len(s) for s in hot} == {1, 2, 3} and hot & single and hot & tree - single and hot - tree
    table = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    # the documents scored are those it was fitted to, or others
    model = lm_score.fit(table, "not held_out") if once else lm_score.fit(table.where("not held_out"))
    assert len(model.hot.context) == len(hot)
    got = lm_score.score(table, model).collect()
    assert Counter((r.doc_id, round(r.score, 6)) for r in got) == scores
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, h) for i, h, _ in rows)
    assert {r.train_tokens for r in got} == {sum(len(t.split()) + 1 for _, h, t in rows if not h)}
    states = {(r.n_context, round(r.rest, 9)) for r in model.states.collect()}
    assert model.states.count() == len(tree)
    assert states == {(size[s], round(len(own[s]) / 2 / size[s], 9)) for s in tree}
    assert sorted(r.n for r in model.pairs.collect()) == sorted(n for s in tree for n in own[s].values())


def test_lm_writes_no_table_of_all_ngrams(spark):
    """Most n-grams of a corpus are seen once; what is written is of the size of
    the texts, not of their n-grams."""
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(3000)], k=400))) for i in range(500)]
    table = (spark.createDataFrame(rows, "doc_id long, text string")
             .withColumn("held_out", F.col("doc_id") % 10 == 0).repartition(4))
    before = size_of(ensure_checkpoint_dir(spark).removeprefix("file:"))
    lm_score.score(table, lm_score.fit(table.where("not held_out"))).collect()
    written = size_of(ensure_checkpoint_dir(spark).removeprefix("file:")) - before
    assert 0 < written < 1.5 * sum(len(t) for _, t in rows)
