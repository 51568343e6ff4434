"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document is the mean of hashed features: its words, for each blank-separated
word a shape (case, first and last byte classes, length), and for each word
whether it repeats the one before.  One
weight vector is shared by all grades; ordered thresholds t_0 < t_1 < ... give
P(grade > k) = sigmoid(score - t_k).  From it come the expected grade and the
tail probability by which documents are selected.

The fit reads a bounded sample of rated rows: the ``sample_rows`` rows of
smallest hash of doc_id (a documented parameter, the same at every size).
Whole texts are used, in the fit and in scoring.

Null or empty text has no features and scores 0 - t_k.  Rows rated null are
not sampled; a document rated twice counts twice.  Without rated rows, or with
one grade only, every tail probability is 1 and every document is kept.
Repeated rows are scored each; equal hashes in the sample go by doc_id, then
grade; a tail probability equal to the bound keeps the document.  An empty
table gives no rows.  ``select`` keeps all columns, whatever their names;
``score`` replaces columns named like its own two.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelflow.llm.common import with_own_names
from parcelflow.llm.textbatch import ALNUM_WORDS, BLANK_WORDS, Words, mix, slices

BITS = 18
SAMPLE_ROWS = 4096

_CLASS = np.zeros(256, np.uint64)  # byte classes of shapes: lower, upper, digit, non-ASCII, else the mark itself
_CLASS[:] = np.arange(256)
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A], _CLASS[0x80:] = 256, 257, 258, 259


_REPEAT = np.uint64(1)  # the feature of a repeated word


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a slice: document, feature and value of each nonzero entry."""
    words, shaped = Words(data, offsets, ALNUM_WORDS), Words(data, offsets, BLANK_WORDS)
    first, last = _CLASS[data[shaped.start]], _CLASS[data[shaped.end - 1]]
    before = _CLASS[data[np.maximum(shaped.end - 2, shaped.start)]]
    size = np.minimum(shaped.end - shaped.start, 20).astype(np.uint64)
    shape = mix(((first * np.uint64(260) + before) * np.uint64(260) + last) * np.uint64(32) + size)
    shift = np.uint64(64 - BITS)
    owner = words.doc_of()
    again = np.flatnonzero((words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1]))
    doc = np.concatenate([owner, shaped.doc_of(), owner[again]])
    feature = np.concatenate([words.hash >> shift, shape >> shift, np.full(len(again), _REPEAT)]).astype(np.int64)
    key, count = np.unique(doc << BITS | feature, return_counts=True)
    doc, feature = key >> BITS, key & (1 << BITS) - 1
    total = np.maximum(words.count + shaped.count, 1)
    return doc, feature, count / total[doc]


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; no thresholds means unfitted."""
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, feature, value = features(data, offsets)
        return np.bincount(doc, self.weights[feature] * value, len(offsets) - 1)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k), a column per threshold."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -60, 60)))


def fit_ordinal(doc: np.ndarray, feature: np.ndarray, value: np.ndarray, grade: np.ndarray,
                steps: int = 60, rate: float = 0.5, decay: float = 1e-3) -> OrdinalModel:
    """Maximum likelihood by Adam over the whole sample.  Grades are 0..K-1."""
    grades, top = len(grade), int(grade.max())
    freq = np.bincount(feature, minlength=1 << BITS)
    value = value * 20.0  # means are small; this sets the scale of the weights
    above = np.array([(grade > k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    theta = -np.log(above / (1 - above))
    raw = np.concatenate([theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])  # t_0 and log gaps
    w = np.zeros(1 << BITS)
    m, v = np.zeros(len(w) + top), np.zeros(len(w) + top)
    for step in range(1, steps + 1):
        gaps = np.exp(raw[1:])
        theta = raw[0] + np.concatenate([[0], np.cumsum(gaps)])
        s = np.bincount(doc, w[feature] * value, grades)
        edge = np.concatenate([[-np.inf], theta, [np.inf]])
        upper = 1 / (1 + np.exp(-np.clip(edge[grade + 1] - s, -500, 500)))  # P(y <= grade)
        lower = 1 / (1 + np.exp(-np.clip(edge[grade] - s, -500, 500)))
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper), lower * (1 - lower)
        g = (du - dl) / p / grades  # -dlogp/ds times -1
        gt = np.zeros(top + 2)
        np.add.at(gt, grade + 1, -du / p / grades)
        np.add.at(gt, grade, dl / p / grades)
        gt = gt[1:-1]
        grad = np.concatenate([np.bincount(feature, g[doc] * value, 1 << BITS) + decay * w,
                               [gt.sum()], [gt[k:].sum() * gaps[k - 1] for k in range(1, top)]])
        grad[:len(w)][freq == 0] = 0
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
        w -= move[:len(w)] * 0.2
        raw -= move[len(w):] * 0.1
    theta = raw[0] + np.concatenate([[0], np.cumsum(np.exp(raw[1:]))])
    return OrdinalModel(w * 20.0, theta)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of three grades from two marks: 0 low quality, 1 good but toxic,
    2 good.  Rows without a quality are unrated."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality is not null").select("doc_id", grade.alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """``ratings``: doc_id and an integer ``grade`` from 0, null where unrated."""
    sample = (ratings.where("grade is not null and doc_id is not null").select("doc_id", "grade")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(batch):
                doc, feature, value = features(data, offsets)
                cut = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(cut, pa.array(feature, pa.int32())),
                     pa.ListArray.from_arrays(cut, pa.array(value, pa.float32()))], ["grade", "feature", "value"])

    # The sample is bounded by sample_rows, so it may be broadcast.
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .join(F.broadcast(sample), "doc_id").select(F.col("grade").cast("int").alias("grade"), "text")
            .mapInArrow(extract, "grade int, feature array<int>, value array<float>").toArrow())
    empty = OrdinalModel(np.zeros(1 << BITS), np.zeros(0))
    if not rows.num_rows:
        return empty
    grade = rows["grade"].to_numpy().astype(np.int64)
    if len(np.unique(grade)) < 2:
        return empty
    lists = rows["feature"].combine_chunks()
    doc = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
    return fit_ordinal(doc, lists.flatten().to_numpy().astype(np.int64),
                       rows["value"].combine_chunks().flatten().to_numpy().astype(float), grade)


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The documents with ``expected_grade`` and ``tails`` (P(grade > k))."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 MB, whatever the input
    own = ["expected_grade", "tails"]
    docs = docs.drop(*own)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part, data, offsets in slices(batch):
                tails = model.tails(model.scores(data, offsets))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(tails.sum(axis=1)), pa.array(list(tails), pa.list_(pa.float64()))],
                    names=[*part.schema.names, *own])

    out = docs.withColumn("text", F.col("text").cast("string"))
    return out.mapInArrow(apply, T.StructType([*out.schema.fields, T.StructField(own[0], T.DoubleType()),
                                               T.StructField(own[1], T.ArrayType(T.DoubleType()))]))


def tail(scored: DataFrame, at_least: int):
    """P(grade >= at_least) of a scored row; 1 where nothing was fitted."""
    return F.when(F.size("tails") == 0, 1.0).otherwise(F.get("tails", F.lit(at_least - 1)))


def select(docs: DataFrame, ratings: DataFrame, at_least: int = 1, min_tail: float = 0.5,
           sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents whose P(grade >= at_least) reaches ``min_tail``, with all
    their columns, whatever their names."""
    model = fit(docs, ratings, sample_rows)

    def kept(own: DataFrame) -> DataFrame:
        scored = score(own, model)
        return scored.where(tail(scored, at_least) >= min_tail).select(*own.columns)

    return with_own_names(docs, ("expected_grade", "tails"), kept)
