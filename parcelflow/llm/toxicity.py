"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of three rows of a hashed embedding table: its own and those
of its first 5 and 7 bytes, so that inflected forms share what they have.  Filters of widths 1, 2 and 3
run over the whole text, each keeps its largest response (max pooling), and a
linear layer gives a logit.  A threshold on the logit is calibrated for each
language on labelled rows that the fit did not see, and the score is
sigmoid(logit - threshold), so 0.5 decides alike in every language.  The
language is guessed from the text's function words: labels, lang, source and
doc_id are no inputs of a score.

The fit reads every labelled row: four fifths by hash of doc_id train, the rest
calibrate.  Training rows are dealt by hash to shards of about ``SHARD_ROWS``.
In each of ``ROUNDS`` rounds every shard starts from the common network, takes
the steps of Adagrad over all of its rows, and sends what it changed; the next
network is the mean of the changes, weighted by rows, of an embedding row over
the shards that met it.  Rows weigh so that both labels weigh the same.  The
thresholds are read from counts of all calibration rows by language, label and
logit to 1 / ``STEPS``.  Embedding rows that no training text has are zero.  The
driver holds one network and these counts, whatever the input.

Null and empty texts have no words and get the score of the bare biases.  Rows
labelled null are not read.  Without rows of both labels every score is 0; a
part that lacks a label is replaced by all rows.  Repeated rows are scored, and
learned from, each.  An empty table gives no rows.  A column ``score`` of the
input is replaced; others come back as they were.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.common import BROADCAST_IDS, materialize
from parcelflow.llm.textbatch import ALNUM_WORDS, Words, slices

BITS, DIM, FILTERS, WIDTHS = 16, 8, 8, (1, 2, 3)
PREFIXES = (5, 7)
PAD = 1 << BITS  # the last row of the table, always zero
ROUNDS, SHARD_ROWS, BATCH = 5, 1 << 14, 32
STEPS, FARTHEST = 100, 60  # of a logit, when thresholds are read
GRID = float(1 << 24)  # changes are summed in whole parts of this, in any order

# Function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": "the of and is that for with this are",
    "de": "der die und das ist von mit den nicht",
    "fr": "le les et des du pour est dans une",
    "es": "el los y del las por con una es",
}


def _hash_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return Words(raw, np.array([0, len(raw)]), ALNUM_WORDS).hash


_LANGUAGE = [np.sort(_hash_words(w)) for w in FUNCTION_WORDS.values()]


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The three rows of the table for each word of a slice, the words' ranges by
    document, and each document's language (-1: none found)."""
    w = Words(data, offsets, ALNUM_WORDS)
    hits = np.zeros((len(_LANGUAGE), len(w.count)), np.int64)
    for i, known in enumerate(_LANGUAGE):
        at = np.minimum(np.searchsorted(known, w.hash), len(known) - 1)
        total = np.concatenate([[0], np.cumsum(known[at] == w.hash)])
        hits[i] = total[w.first[1:]] - total[w.first[:-1]]
    language = np.where(hits.max(axis=0) > 0, hits.argmax(axis=0), -1)
    hashes = np.stack([w.hash, *(w.prefix_hash(n) * np.uint64(2 * n + 1) for n in PREFIXES)], axis=1)
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32), w.first, language


def _layout(rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with three pads behind each document, and the begin and end of
    the positions where a document's windows start (one pad included)."""
    size = np.diff(first)
    begin = first[:-1] + 3 * np.arange(len(size))
    out = np.full((first[-1] + 3 * len(size) + 1, rows.shape[1]), PAD, np.int32)
    out[np.arange(first[-1]) + 3 * np.repeat(np.arange(len(size)), size)] = rows
    return out, begin, begin + size + 1


@dataclass
class Network:
    table: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(FUNCTION_WORDS) + 1))
    fitted: bool = True

    def responses(self, ids: np.ndarray) -> np.ndarray:
        """Of every filter at every position that three words follow."""
        x, n = self.table[ids[:, 0]], len(ids) - 2
        for i in range(1, ids.shape[1]):
            x += self.table[ids[:, i]]
        out = np.empty((n, len(WIDTHS) * FILTERS), np.float32)
        for k, f in zip(WIDTHS, self.filters):
            z = x[:n] @ f[:DIM]
            for j in range(1, k):
                z += x[j:j + n] @ f[j * DIM:(j + 1) * DIM]
            out[:, (k - 1) * FILTERS:k * FILTERS] = z
        return out

    def pooled(self, rows: np.ndarray, first: np.ndarray):
        ids, begin, end = _layout(rows, first)
        z = self.responses(ids)
        top = np.maximum.reduceat(z, np.stack([begin, end], axis=1).ravel(), axis=0)[::2]
        return ids, begin, end, z, np.maximum(top + self.bias, 0)

    def logits(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(rows, first)[4] @ self.out + self.out_bias


def _step(net: Network, rows, first, label, square: dict, rate: float, weight=1.0) -> None:
    """One step of Adagrad on a batch of documents."""
    ids, begin, end, z, pool = net.pooled(rows, first)
    p = 1 / (1 + np.exp(-(pool @ net.out + net.out_bias)))
    g = (weight * (p - label) / len(label)).astype(np.float32)
    at = np.stack([b + z[b:e].argmax(axis=0) for b, e in zip(begin, end)])  # document x filter
    back = g[:, None] * net.out * (pool > 0)

    def adjust(name, value, grad):
        square[name] = square.get(name, 1e-6) + grad * grad
        value -= rate * grad / np.sqrt(square[name])

    windows = ids[at[..., None] + np.arange(3)]  # document x filter x 3 x parts of a word
    met, place = np.unique(windows, return_inverse=True)
    place = place.reshape(windows.shape)
    table_grad = np.zeros((len(met), net.table.shape[1]), net.table.dtype)
    filter_grads = []
    for k, f in zip(WIDTHS, net.filters):
        own = slice((k - 1) * FILTERS, k * FILTERS)
        grad = np.zeros_like(f)
        for j in range(k):
            for i in range(ids.shape[1]):
                word = windows[:, own, j, i]  # document x filter
                grad[j * DIM:(j + 1) * DIM] += np.einsum("bfd,bf->df", net.table[word], back[:, own])
                np.add.at(table_grad, place[:, own, j, i], back[:, own, None] * f[j * DIM:(j + 1) * DIM].T[None])
        filter_grads.append(grad)
    table_grad[met == PAD] = 0
    square.setdefault("table", np.full(net.table.shape, 1e-6, np.float32))
    square["table"][met] += table_grad ** 2
    net.table[met] -= rate * table_grad / np.sqrt(square["table"][met])
    for i, (f, grad) in enumerate(zip(net.filters, filter_grads)):
        adjust(i, f, grad)
    adjust("bias", net.bias, back.sum(axis=0))
    adjust("out", net.out, (g[:, None] * pool).sum(axis=0))
    square["b"] = square.get("b", 1e-6) + float(g.sum()) ** 2
    net.out_bias -= rate * float(g.sum()) / np.sqrt(square["b"])


def _threshold(logit: np.ndarray, label: np.ndarray, prior: float, count: np.ndarray | None = None) -> float:
    """The cut with the best expected accuracy at the prior, amid its gap."""
    count = np.ones(len(label)) if count is None else count
    z, at = np.unique(logit, return_inverse=True)
    toxic, plain = np.bincount(at, count * label), np.bincount(at, count * (1 - label))
    missed = np.concatenate([[0], np.cumsum(toxic)]) / max(toxic.sum(), 1)  # cut below index i
    wrong = (plain.sum() - np.concatenate([[0], np.cumsum(plain)])) / max(plain.sum(), 1)
    loss = prior * missed + (1 - prior) * wrong
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    edges = np.concatenate([[z[0] - 2], z, [z[-1] + 2]])
    return float((edges[best[0]] + edges[best[-1] + 1]) / 2)


def _dense(net: Network) -> list[np.ndarray]:
    return [*net.filters, net.bias, net.out]


def _pack(net: Network, square: dict) -> np.ndarray:
    """All weights and their squares as rows of 2 * DIM: the table's, then the others'."""
    sides = []
    for table, rest in ((net.table, [*_dense(net), net.out_bias]),
                        (square["table"], [square[x] for x in (*range(len(WIDTHS)), "bias", "out", "b")])):
        flat = np.concatenate([np.ravel(x) for x in rest])
        sides.append(np.concatenate([table, np.pad(flat, (0, -len(flat) % DIM)).reshape(-1, DIM)]))
    return np.concatenate(sides, axis=1, dtype=np.float64)


def _unpack(state: np.ndarray, net: Network) -> dict:
    """Sets the network's weights; returns the squares."""
    square: dict = {}
    for side in (0, 1):
        own = state[:, side * DIM:(side + 1) * DIM].astype(np.float32)
        table, flat, at = own[:PAD + 1].copy(), own[PAD + 1:].ravel(), 0
        rest = []
        for x in _dense(net):
            rest.append(flat[at:at + x.size].reshape(x.shape).copy())
            at += x.size
        if side:
            square = dict(zip((*range(len(WIDTHS)), "bias", "out"), rest)) | {"table": table, "b": float(flat[at])}
        else:
            net.table, net.filters, (net.bias, net.out), net.out_bias = table, rest[:-2], rest[-2:], float(flat[at])
    return square


def _start(seed: int = 7) -> tuple[Network, np.ndarray]:
    rng = np.random.default_rng(seed)
    net = Network(rng.normal(0, 0.1, (PAD + 1, DIM)).astype(np.float32),
                  [rng.normal(0, 0.3, (k * DIM, FILTERS)).astype(np.float32) for k in WIDTHS],
                  np.full(len(WIDTHS) * FILTERS, 0.1, np.float32),
                  rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32))
    net.table[PAD] = 0
    square = {i: np.full(x.shape, 1e-6) for i, x in zip((*range(len(WIDTHS)), "bias", "out"), _dense(net))}
    return net, _pack(net, square | {"table": np.full(net.table.shape, 1e-6), "b": 1e-6})


class _Shard:
    """A shard's own training from the common state."""

    def __init__(self, number: int, net: Network, state: np.ndarray):
        self.number, self.net, self.state = number, copy.copy(net), state
        self.square = _unpack(state, self.net)
        self.before = _pack(self.net, self.square)
        self.met = np.zeros(len(state), bool)
        self.met[PAD + 1:] = True
        self.docs = 0

    def step(self, rows: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray, rate: float) -> None:
        _step(self.net, rows, first, label, self.square, rate, weight)
        self.met[rows.ravel()] = True
        self.docs += len(label)

    def out(self) -> pa.RecordBatch:
        """id, rows learned from, and the changes of the 2 * DIM numbers times these rows."""
        at = np.flatnonzero(self.met)
        change = np.round((_pack(self.net, self.square)[at] - self.before[at]) * self.docs * GRID) / GRID
        return pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(np.full(len(at), self.docs)), *map(pa.array, change.T)], _CHANGE)


_CHANGE = ["id", "docs", *(f"v{i}" for i in range(2 * DIM))]


def train(rows: DataFrame, weight: tuple[float, float], rate: float = 0.08) -> Network:
    """``rows``: shard, label and text, the rows of a shard side by side;
    ``weight`` by label."""
    net, state = _start()
    weights, seen = np.array(weight), np.zeros(PAD + 1, bool)

    def round_of(shared):
        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = None
            for batch in batches:
                for part, data, offsets in slices(batch):
                    words, first, _ = encode(data, offsets)
                    shard, label = part.column(0).to_numpy(), part.column(1).to_numpy()
                    ends = np.union1d(np.arange(0, len(shard), BATCH), np.flatnonzero(np.diff(shard)) + 1)
                    for a, b in pairwise([*ends.tolist(), len(shard)]):
                        if own is None or own.number != shard[a]:
                            if own:
                                yield own.out()
                            own = _Shard(shard[a], net, shared.value)
                        own.step(words[first[a]:first[b]], first[a:b + 1] - first[a],
                                 label[a:b].astype(np.float32), weights[label[a:b]], rate)
            if own:
                yield own.out()
        return learn

    schema = "id int, docs long, " + ", ".join(f"{c} double" for c in _CHANGE[2:])
    for _ in range(ROUNDS):
        shared = rows.sparkSession.sparkContext.broadcast(state.astype(np.float32))
        # at most a row per row of the state, whatever the input
        sums = (rows.select("shard", "label", "text").mapInArrow(round_of(shared), schema)
                .groupBy("id").agg(*(F.sum(c).alias(c) for c in _CHANGE[1:])).toArrow())
        at, docs = sums["id"].to_numpy(), sums["docs"].to_numpy()
        state[at] += np.stack([sums[c].to_numpy() for c in _CHANGE[2:]], axis=1) / docs[:, None]
        seen[at[at <= PAD]] = True
        shared.unpersist()
    _unpack(state, net)
    net.table[~seen] = 0
    return net


def calibrate(rows: DataFrame, net: Network, prior: float) -> None:
    """Sets the thresholds; ``rows``: label and text."""
    shared = rows.sparkSession.sparkContext.broadcast(net)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                words, first, language = encode(data, offsets)
                z = np.round(np.clip(shared.value.logits(words, first), -FARTHEST, FARTHEST) * STEPS)
                yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int32)), pa.array(z.astype(np.int32)),
                                                  part.column(0)], ["language", "z", "label"])

    # at most languages * labels * 2 * FARTHEST * STEPS rows
    got = (rows.select("label", "text").mapInArrow(place, "language int, z int, label int")
           .groupBy("language", "z", "label").count().toArrow())
    language, z, label, count = (got[c].to_numpy() for c in ("language", "z", "label", "count"))
    net.thresholds[:] = _threshold(z / STEPS, label, prior, count)
    for i in range(len(FUNCTION_WORDS)):
        mine = language == i
        if min(count[mine & (label == y)].sum() for y in (0, 1)) >= 20:
            net.thresholds[i] = _threshold(z[mine] / STEPS, label[mine], prior, count[mine])


def fit(docs: DataFrame, labels: DataFrame) -> Network:
    """``labels``: doc_id and label (1: toxic, 0: not)."""
    labels = (labels.where("label in (0, 1) and doc_id is not null")
              .select("doc_id", F.col("label").cast("int").alias("label")))
    share, number = labels.agg(F.avg("label"), F.count("*")).first()
    wanted = F.broadcast(labels) if number <= BROADCAST_IDS else labels
    row = lambda seed: F.xxhash64("doc_id", "text", "label", F.lit(seed))
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text")).join(wanted, "doc_id")
            .select((F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(5)) > 0).alias("trains"), "label", "text",
                    F.pmod(row(2), F.lit(1 + number // SHARD_ROWS)).cast("int").alias("shard"), row(3).alias("place")))
    order = ["shard", "place", "label", "text"]
    rows = materialize(rows.repartition("shard").sortWithinPartitions(*order).drop("place"), "labelled")
    found = {(r["trains"], r["label"]): r["count"] for r in rows.groupBy("trains", "label").count().collect()}
    if len({y for _, y in found}) < 2:
        return Network(np.zeros((PAD + 1, DIM), np.float32), [], np.zeros(0), np.zeros(0), fitted=False)
    parts = {}
    for part in (True, False):
        own = {y: found.get((part, y), 0) for y in (0, 1)}
        if all(own.values()):
            parts[part] = rows.where(F.col("trains") == part), own
        else:
            parts[part] = rows, {y: found.get((True, y), 0) + found.get((False, y), 0) for y in (0, 1)}
    learned, own = parts[True]
    net = train(learned, tuple((own[0] + own[1]) / (2 * own[y]) for y in (0, 1)))
    calibrate(parts[False][0], net, share)
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """The documents with ``score``, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 2 MB, whatever the input
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part, data, offsets in slices(batch):
                if net.fitted:
                    rows, first, language = encode(data, offsets)
                    z = net.logits(rows, first).astype(np.float64) - net.thresholds[language]
                    out = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
                else:
                    out = np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out)], names=[*part.schema.names, "score"])

    return docs.mapInArrow(apply, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
