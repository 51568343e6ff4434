"""Language-model scores by a probabilistic suffix tree over words.

Training counts every word of every training document (words between blanks,
A-Z lower-cased, then one end per document).  Contexts are the suffixes of one
to ``DEPTH`` words that occur ``MIN_COUNT`` times or more, each with the counts
of all its next symbols.  A context stays in the tree if its next-symbol
distribution diverges from that of its suffix by ``MIN_DIVERGENCE`` nats or more
(or a longer one needs it).

    P(x | s)    = max(n(s x) - 1/2, 0) / n(s) + rest(s) * P(x | suffix of s)
    P(x | root) = (n(x) + 0.1) / (N + 0.1 * (V + 1))

Each token is scored in the longest suffix state that the tree has.

The documents are written once as chunks: the different words of about
``CHUNK_TOKENS`` tokens with their counts, and the tokens as places in them.  A
context, its suffixes and all that they are followed by share the word before
the next one.  So by the hash of this word the tokens are taken in ``SLICES``
turns, and in a turn dealt to buckets of about ``BUCKET`` training tokens; a
bucket counts its contexts, grows their part of the tree and scores the tokens
there, and only sums by document stay.  Thus neither the n-grams nor the tree
are ever on the disk as a whole.

A context seen ``HOT`` times or more is too large for a bucket.  Its tokens are
dealt by the next longer context (those of three words by document), and each of
its buckets gets the counts of all its next words, counted before.  Whether a
longer context needs it is known when all its buckets are done; what a token
gains by it is kept apart until then.

``Model.states`` and ``Model.pairs`` are the tree as tables, and ``Model.tree``
its hot part: contexts of a share of ``MIN_CONTEXT`` of all tokens and their next
symbols of a share of ``MIN_NEXT``.  They are made when they are asked for.

Null text is empty: one end.  A row is scored by its place, so repeated or
null doc_ids do no harm.  An empty table gives no rows.  Only doc_id, held_out
and text are read, so other columns never clash.  With nothing to train on,
every token has probability 1.  Words and contexts are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize, text_or_empty
from parcelflow.llm.textbatch import BLANK_WORDS, Words, mix, slices

DEPTH = 3
MIN_COUNT = 3
MIN_CONTEXT = 2e-4
MIN_NEXT = 5e-3
MIN_DIVERGENCE = 0.02
HELD_TOKENS = 2_000_000
CHUNK_TOKENS = 1 << 19
GATHER = 1 << 18  # values of a column that a task holds before it writes them
SLICES = 6
BUCKET = HOT = 1 << 18
LEAST_BUCKETS = 8
DOC_BITS = 30  # of a document or a word in a chunk; a text has fewer words, as it has less than 2 GB
END = int(mix(np.array([77], np.uint64)).view(np.int64)[0])


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the slice's tokens with an end after each document, and the
    index of each document's first token (and of what follows the last)."""
    w = Words(data, offsets, BLANK_WORDS)
    first = w.first + np.arange(len(w.first))
    out = np.full(first[-1], END, np.int64)
    is_word = np.ones(len(out), bool)
    is_word[first[1:] - 1] = False
    out[is_word] = w.hash.view(np.int64)
    return out, first


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.view(np.uint64) * np.uint64(3)).view(np.int64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class Tree:
    """The hot part.  Sorted contexts with their rest shares, sorted (context,
    next) pairs with their own shares and what they add to log10 rest, and the
    counts of the frequent words."""
    context: np.ndarray
    rest: np.ndarray
    pair: np.ndarray
    share: np.ndarray
    gain: np.ndarray
    word: np.ndarray
    count: np.ndarray
    total: int
    distinct: int


@dataclass
class Hot:
    """Contexts too large for a bucket: sorted, with the first of their own
    buckets, the number of these, and the buckets that get their counts (also
    those of longer hot contexts)."""
    context: np.ndarray
    first: np.ndarray
    parts: np.ndarray
    targets: list[np.ndarray]


@dataclass
class Model:
    """docs: the documents it was fitted to, and chunks: the same in chunks;
    counts: word, n; hot_pairs: what follows the hot contexts."""
    docs: DataFrame
    counts: DataFrame
    word: np.ndarray
    count: np.ndarray
    total: int
    distinct: int
    chunks: DataFrame
    buckets: int
    hot: Hot
    hot_pairs: DataFrame | None

    @property
    def z(self) -> float:
        return self.total + 0.1 * (self.distinct + 1)

    @cached_property
    def states(self) -> DataFrame:
        """context, n_context, rest."""
        return materialize(self._table("states", "context long, n_context long, rest double", ["context"]), "states")

    @cached_property
    def pairs(self) -> DataFrame:
        """context, next, n, n_context, share, gain."""
        return materialize(self._table("pairs", "context long, next long, n long, n_context long, share double, "
                                                "gain double", ["context", "next"]), "pairs")

    def _table(self, what: str, schema: str, key: list[str]) -> DataFrame:
        rows = [_dealt(self, [(self.chunks, True, False)], turn).groupBy("bucket").applyInArrow(_grow(self, what), schema)
                for turn in range(SLICES)]
        return reduce(DataFrame.union, rows).dropDuplicates(key)  # each bucket of a hot context gives it

    @cached_property
    def tree(self) -> Tree:
        hot = F.col("n_context") >= MIN_CONTEXT * self.total
        large = self.states.where(hot).toArrow()  # DEPTH / MIN_CONTEXT at most
        known = self.pairs.where(hot & (F.col("n") >= MIN_NEXT * F.col("n_context"))).toArrow()  # 1 / MIN_NEXT times that
        context, rest = large["context"].to_numpy(), large["rest"].to_numpy()
        pair = _joined(known["context"].to_numpy(), known["next"].to_numpy())
        i, j = np.argsort(context), np.argsort(pair)
        return Tree(context[i], rest[i], pair[j], known["share"].to_numpy()[j], known["gain"].to_numpy()[j],
                    self.word, self.count, self.total, self.distinct)


def _drop(df: DataFrame) -> None:
    """Remove a table of ``materialize`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_CHUNK = ("chunk long, doc_id array<long>, held_out array<boolean>, trained binary, size long, first binary, "
          "word binary, at binary")
_CHUNK_NAMES = [c.split()[0] for c in _CHUNK.split(", ")]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of documents: their first tokens, the different words (frequent
    ones first) and each token's place in these."""
    held: list[tuple[pa.RecordBatch, np.ndarray, np.ndarray]] = []
    part, number = TaskContext.get().partitionId(), 0

    def out():
        token = np.concatenate([t for _, t, _ in held])
        first = np.append(0, np.cumsum(np.concatenate([np.diff(f) for _, _, f in held])))
        of, begin, n = _groups(token)
        order = np.argsort(-n)
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        trained = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p, _, _ in held]).astype(bool)
        at = pa.compress(np.ascontiguousarray(rank[of].view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)
        ids, marks = ([x for p, _, _ in held for x in p.column(i).to_pylist()] for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [pa.array([part << 16 | number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
             pa.array([marks], pa.list_(pa.bool_())), pa.array([trained.tobytes()], pa.binary()),
             pa.array([len(token)], pa.int64()),
             *(pa.array([x], pa.binary()) for x in (first.tobytes(), token[begin[order]].tobytes(), at))],
            _CHUNK_NAMES)

    for batch in batches:
        for piece, data, offsets in slices(batch):
            held.append((piece, *_tokens(data, offsets)))
            if sum(len(t) for _, t, _ in held) >= CHUNK_TOKENS:
                yield out()
                held, number = [], number + 1
    if held:
        yield out()


def _cut_texts(texts: DataFrame) -> DataFrame:
    return materialize(texts.mapInArrow(_cut, _CHUNK), "cut")


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each key the number of its group, and for each group one place and its size."""
    order = np.argsort(keys)
    ranked = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    of = np.empty(len(keys), np.int64)
    of[order] = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    return of, order[begin], np.diff(np.append(begin, len(keys)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often the training documents of chunks have each word."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        word, n = (np.concatenate(v) for v in zip(*held))
        of, place, _ = _groups(word)
        return pa.RecordBatch.from_arrays([pa.array(word[place]), pa.array(np.bincount(of, n).astype(np.int64))],
                                          ["word", "n"])

    for row in _chunk_rows(batches):
        word, first = (np.frombuffer(row[c], np.int64) for c in ("word", "first"))
        trained = np.repeat(np.frombuffer(row["trained"], bool), np.diff(first))
        n = np.bincount(_places(row)[trained], minlength=len(word))
        held.append((word[n > 0], n[n > 0]))
        if sum(len(w) for w, _ in held) >= HELD_TOKENS // 2:
            yield out()
            held = []
    if sum(len(w) for w, _ in held):
        yield out()


def _filled(cut: DataFrame, counts: DataFrame, word: np.ndarray, count: np.ndarray, distinct: int) -> DataFrame:
    """The chunks with the training count of each word: the frequent ones' are
    broadcast, the others looked up by hash.  ``cut`` is removed."""
    often = cut.sparkSession.sparkContext.broadcast((word, count))
    parts = max(LEAST_BUCKETS, distinct // GATHER)
    names = ["part", "word", "id", "n"]

    def dealt(word: np.ndarray, id_: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        here = np.flatnonzero(_find(often.value[0], word) < 0)
        return [(word[here].view(np.uint64) % np.uint64(parts)).astype(np.int64), word[here], id_[here], n[here]]

    def wanted(batches):
        for row in _chunk_rows(batches):
            own = np.frombuffer(row["word"], np.int64)
            yield dealt(own, row["chunk"] << DOC_BITS | np.arange(len(own)), np.zeros(len(own), np.int64))

    def known(batches):
        for batch in batches:
            own = batch.column(0).to_numpy()
            yield dealt(own, np.full(len(own), -1), batch.column(1).to_numpy())

    def look(table: pa.Table) -> pa.Table:
        own, id_, n = _values(table, names[1:])
        have = np.flatnonzero(id_ < 0)
        have = have[np.argsort(own[have])]
        want = np.flatnonzero(id_ >= 0)
        found = _find(own[have], own[want])
        n = np.where(found >= 0, n[have[found]] if len(have) else 0, 0)
        return pa.Table.from_batches([_blobs(id_[want] >> DOC_BITS, [id_[want] & (1 << DOC_BITS) - 1, n],
                                             ["chunk", "place", "n"])])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = []
            for i in range(batch.num_rows):
                own = np.frombuffer(batch.column("word")[i].as_buffer(), np.int64)
                found = _find(often.value[0], own)
                n = np.zeros(len(own), np.int64)
                n[found >= 0] = often.value[1][found[found >= 0]]
                for place, value in zip(*(batch.column(c)[i].as_py() or [] for c in ("place", "n"))):
                    n[np.frombuffer(place, np.int64)] = np.frombuffer(value, np.int64)
                counted.append(n.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(counted, pa.binary())], _CHUNK_NAMES + ["n"])

    schema = "part long, word binary, id binary, n binary"
    rows = cut.select("chunk", "word").mapInArrow(lambda batches: _gathered(wanted(batches), names), schema)
    rows = rows.union(counts.mapInArrow(lambda batches: _gathered(known(batches), names), schema))
    found = materialize(rows.groupBy("part").applyInArrow(look, "chunk long, place binary, n binary"), "known")
    by_chunk = found.groupBy("chunk").agg(F.collect_list("place").alias("place"), F.collect_list("n").alias("n"))
    chunks = materialize(cut.join(by_chunk, "chunk", "left").mapInArrow(fill, _CHUNK + ", n binary"), "chunks")
    _drop(cut)
    _drop(found)
    return chunks


_TOKENS = ["chunk", "trained", "size", "first", "word", "at", "n"]


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: batch.column(c)[i].as_py() for c in batch.schema.names}


def _places(row: dict) -> np.ndarray:
    """The place of each token in the chunk's words."""
    raw = np.frombuffer(pa.decompress(row["at"], 4 * row["size"], "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view(np.uint32).ravel()


def _occurrences(row: dict, taken: Callable[[np.ndarray], np.ndarray]):
    """The chunk's tokens that have a word before them, and one that is taken: their
    contexts of one to three words (0 where there are fewer before them), they
    themselves, their counts, their documents and the words before them."""
    at = _places(row)
    word, n, first = (np.frombuffer(row[c], np.int64) for c in ("word", "n", "first"))
    here = np.flatnonzero(taken(word)[at[:-1]]) + 1
    begins = np.zeros(len(at) + 1, bool)
    begins[first] = True
    here = here[~begins[here]]
    doc = np.searchsorted(first, here, "right") - 1
    position = here - first[doc]
    before = [word[at[np.maximum(here - k, 0)]] for k in (1, 2, 3)]
    c1 = before[0]
    c2 = np.where(position >= 2, _joined(before[1], c1), 0)
    c3 = np.where(position >= 3, _joined(before[2], c2), 0)
    return (c1, c2, c3), word[at[here]], n[at[here]], doc, before


def _turn(word: np.ndarray) -> np.ndarray:
    return word.view(np.uint64) % np.uint64(SLICES)


def _bucket(hot: Hot, buckets: int, c: tuple[np.ndarray, ...], spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each token, and the size of its shortest context that isn't hot."""
    out = (c[0].view(np.uint64) // np.uint64(SLICES) % np.uint64(buckets)).astype(np.int64)
    own = np.ones(len(out), np.int8)
    for size, below in enumerate((c[1], c[2], spread), 1):
        if not len(hot.context):
            break
        found = _find(hot.context, c[size - 1])
        here = np.flatnonzero((found >= 0) & (own == size))
        found = found[here]
        out[here] = hot.first[found] + (below[here].view(np.uint64) % hot.parts[found].astype(np.uint64)).astype(np.int64)
        own[here] = size + 1
    return out, own


#: mark: the count of x, above a bit that tells if the token is counted and three
#: that hold the size of context from which on; doc: if the token is only
#: counted, how often, negative.
_COLUMNS = ["c1", "c2", "c3", "x", "mark", "doc"]
_DEALT = "bucket long, " + ", ".join(f"{c} binary" for c in _COLUMNS)


def _blobs(group: np.ndarray, columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """A row per group with its part of each column (of 8 bytes a value)."""
    order = np.argsort(group, kind="stable")
    group = group[order]
    cut = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(group))
    bounds = pa.py_buffer((8 * cut).astype(np.int32).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(group[cut[:-1]]), *(pa.Array.from_buffers(
        pa.binary(), len(cut) - 1, [None, bounds, pa.py_buffer(np.ascontiguousarray(v[order]))]) for v in columns)], names)


def _gathered(rows: Iterator[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Blobs of the rows' columns by the first of them, about CHUNK_TOKENS values at a time."""
    held, size = [], 0

    def out():
        group, *columns = (np.concatenate(v) for v in zip(*held))
        return _blobs(group, columns, names)

    for columns in rows:
        if len(columns[0]):
            held.append(columns)
            size += len(columns[0])
        if size >= GATHER:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _values(table: pa.Table | pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    """The columns that ``_blobs`` was given, joined."""
    out = []
    for c in names:
        column = table[c].combine_chunks() if isinstance(table, pa.Table) else table[c]
        if len(column):
            bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset:][[0, len(column)]]
            out.append(np.frombuffer(column.buffers()[2], np.uint8)[slice(*bounds)].view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out


def _dealt(model: Model, tables: list[tuple[DataFrame, bool, bool]], turn: int) -> DataFrame:
    """The tokens of a turn, by bucket; with each table whether its training
    documents are counted, and whether it is scored.  With them go the counts
    of hot contexts."""
    hot, buckets = model.hot, model.buckets
    names = ["bucket", *_COLUMNS]

    def deal(counted: bool, scored: bool):
        def tokens(batches):
            for row in _chunk_rows(batches):
                c, x, n_x, doc, _ = _occurrences(row, lambda word: _turn(word) == turn)
                bucket, own = _bucket(hot, buckets, c, doc)
                weight = np.frombuffer(row["trained"], bool)[doc] & counted
                columns = [bucket, *c, x, n_x << 4 | weight.astype(np.int64) << 3 | own, row["chunk"] << DOC_BITS | doc]
                if not scored:  # what is counted before is not counted again
                    here = np.flatnonzero(weight & (np.choose(own - 1, (*c, np.zeros_like(x))) != 0))
                    columns = [v[here] for v in columns]
                    columns[-1] = np.full(len(here), -1)
                yield columns

        return lambda batches: _gathered(tokens(batches), names)

    def spread(batches):
        for batch in batches:
            level, w1, w2, w3, x, n_x, n = _values(batch, _PAIRS)
            c2 = np.where(level >= 2, _joined(w2, w1), 0)
            c3 = np.where(level >= 3, _joined(w3, c2), 0)
            found = _find(hot.context, np.choose(level - 1, (w1, c2, c3)))
            times = np.array([len(t) for t in hot.targets])[found]
            times[_turn(w1) != turn] = 0
            end = np.cumsum(times)
            for i in range(0, end[-1] if len(end) else 0, GATHER):
                part = np.arange(i, min(i + GATHER, end[-1]))
                at = np.searchsorted(end, part, "right")
                start = np.cumsum([0, *map(len, hot.targets)])
                bucket = np.concatenate(hot.targets)[start[found[at]] + part - (end - times)[at]]
                yield [bucket, *(v[at] for v in (w1, c2, c3, x, n_x << 4 | 8 | level, -n))]

    parts = [chunks.select(_TOKENS).mapInArrow(deal(counted, scored), _DEALT) for chunks, counted, scored in tables]
    if model.hot_pairs is not None:
        parts.append(model.hot_pairs.mapInArrow(lambda batches: _gathered(spread(batches), names), _DEALT))
    return reduce(DataFrame.union, parts)


@dataclass
class _Level:
    """The contexts of one size in a bucket, their pairs, and the tokens that have them."""
    row: np.ndarray
    of: np.ndarray
    context: np.ndarray
    total: np.ndarray
    rest: np.ndarray
    kept: np.ndarray
    pair_row: np.ndarray
    pair_of: np.ndarray
    n: np.ndarray
    share: np.ndarray
    p: np.ndarray
    lower: np.ndarray
    row_p: np.ndarray


def _levels(c: tuple[np.ndarray, ...], x: np.ndarray, own: np.ndarray, weight: np.ndarray, root: np.ndarray) -> list[_Level]:
    """Probabilities from short contexts to long ones, then the divergence
    tests from long to short.  A token's weight counts from the size ``own`` on."""
    levels, row, lower = [], np.arange(len(x)), root.copy()
    for size in range(1, DEPTH + 1):
        row = row[c[size - 1][row] != 0]
        of, place, _ = _groups(c[size - 1][row])
        n = np.where(own[row] <= size, weight[row], 0)
        total = np.bincount(of, n, len(place))  # whole numbers far below 2 ** 53: exact
        seen = total >= MIN_COUNT
        context, total = c[size - 1][row[place[seen]]], total[seen]
        here = seen[of]
        row, of, n = row[here], (np.cumsum(seen) - 1)[of[here]], n[here]
        pair, place, _ = _groups(_joined(c[size - 1][row], x[row]))
        n = np.bincount(pair, n, len(place))
        pair_of, below = of[place], lower[row[place]]
        share, some = n / total[pair_of], n > 0
        rest = np.bincount(pair_of[some], minlength=len(total)) / (2 * total)
        own_share = np.where(some, (n - 0.5) / total[pair_of], 0)
        p = own_share + rest[pair_of] * below
        divergence = np.bincount(pair_of[some], share[some] * np.log(share[some] / below[some]), len(total))
        lower[row] = p[pair]
        levels.append(_Level(row, of, context, total, rest, divergence >= MIN_DIVERGENCE, row[place], pair_of, n,
                             own_share, p, below, p[pair]))
    for short, long in zip(levels[-2::-1], levels[:0:-1]):
        # a kept context needs its suffix
        place = np.full(len(x), -1)
        place[short.row] = short.of
        needed = place[long.row[long.kept[long.of]]]
        short.kept[needed] = True
    return levels


def _grow(model: Model, what: str):
    """What a bucket gives: the states or pairs of its part of the tree, or the
    sums of its tokens' scores."""
    z, hot = model.z, model.hot.context

    def run(table: pa.Table) -> pa.Table:
        c1, c2, c3, x, mark, doc = _values(table, _COLUMNS)
        root = ((mark >> 4) + 0.1) / z
        levels = _levels((c1, c2, c3), x, mark & 7, np.where(doc < 0, -doc, mark >> 3 & 1), root)
        if what == "states":
            return pa.table({"context": np.concatenate([v.context[v.kept] for v in levels]),
                             "n_context": np.concatenate([v.total[v.kept] for v in levels]).astype(np.int64),
                             "rest": np.concatenate([v.rest[v.kept] for v in levels])})
        if what == "pairs":
            columns = []
            for v in levels:
                i = np.flatnonzero(v.kept[v.pair_of] & (v.n > 0))
                of = v.pair_of[i]
                columns.append((v.context[of], x[v.pair_row[i]], v.n[i].astype(np.int64), v.total[of].astype(np.int64),
                                v.share[i], np.log10(v.p[i] / (v.rest[of] * v.lower[i]))))
            return pa.table(dict(zip(["context", "next", "n", "n_context", "share", "gain"], map(np.concatenate, zip(*columns)))))
        scored, best, before = doc >= 0, root.copy(), root.copy()
        marks, apart = [np.zeros(0, np.int64)], []
        for v in levels:
            kept = v.kept[v.of]
            if len(hot):  # other buckets have more of a hot context
                warm = _find(hot, v.context) >= 0
                marks.append(v.context[warm & v.kept])
                i = np.flatnonzero((warm & ~v.kept)[v.of] & scored[v.row])
                apart.append((v.context[v.of[i]], v.row[i], np.log10(v.row_p[i] / before[v.row[i]])))
                before[v.row] = v.row_p
            best[v.row[kept]] = v.row_p[kept]
        at = np.flatnonzero(scored)
        parts = [_by_chunk(np.zeros(len(at), np.int64), doc[at], np.log10(best[at] / root[at]))]
        parts += [_by_chunk(context, doc[i], gain) for context, i, gain in apart if len(i)]
        mark = np.unique(np.concatenate(marks))
        none = pa.nulls(len(mark), pa.binary())
        parts.append(pa.RecordBatch.from_arrays([pa.array(mark), pa.array(np.full(len(mark), -1)), none, none], _GAINS))
        return pa.Table.from_batches(parts)

    return run


_GAINS = ["context", "chunk", "doc", "gain"]


def _by_chunk(context: np.ndarray, doc: np.ndarray, gain: np.ndarray) -> pa.RecordBatch:
    """Sums by context and document, a row per context and chunk."""
    order = np.argsort(doc) if not context.any() else np.lexsort((doc, context))
    context, doc = context[order], doc[order]
    begin = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (context[1:] != context[:-1])) if len(doc) else [])
    gain = np.add.reduceat(gain[order], begin) if len(begin) else np.zeros(0)
    context, doc = context[begin], doc[begin]
    chunk = doc >> DOC_BITS
    row = np.cumsum(np.append(True, (chunk[1:] != chunk[:-1]) | (context[1:] != context[:-1]))) if len(doc) else doc
    blobs = _blobs(row, [doc & (1 << DOC_BITS) - 1, gain], ["row", "doc", "gain"]) if len(doc) else None
    place = np.flatnonzero(np.diff(row, prepend=0))
    columns = blobs.columns[1:] if blobs is not None else [pa.array([], pa.binary())] * 2
    return pa.RecordBatch.from_arrays([pa.array(context[place]), pa.array(chunk[place]), *columns], _GAINS)


def _sum(table: pa.Table) -> pa.Table:
    """The gains of a chunk's documents."""
    doc, gain = _values(table, ["doc", "gain"])
    total = np.bincount(doc, gain.view(np.float64))
    return pa.table({"chunk": table["chunk"].slice(0, 1), "gain": pa.array([total.tobytes()], pa.binary())})


_PAIRS = ["level", "w1", "w2", "w3", "x", "n_x", "n"]


def _follow(chunks: DataFrame, hot: np.ndarray, last: np.ndarray, size: int, parts: int) -> DataFrame:
    """Counts of all that follows the hot contexts of a size, which end with the
    last words, by hash in so many blobs."""
    names = ["part", *_PAIRS]

    def counted(columns: list[np.ndarray]) -> list[np.ndarray]:
        """Equal contexts and followers counted together, and their part in front."""
        level, w1, w2, w3, x, n_x, n = columns
        key = _joined(_joined(_joined(w3, w2), w1), x)
        of, place, _ = _groups(key)
        n = np.bincount(of, n, len(place)).astype(np.int64)
        part = (key[place].view(np.uint64) % np.uint64(parts)).astype(np.int64)
        return [part, *(v[place] for v in (level, w1, w2, w3, x, n_x)), n]

    def pairs(batches):
        for row in _chunk_rows(batches):
            c, x, n_x, doc, before = _occurrences(row, lambda word: _find(last, word) >= 0)
            at = np.flatnonzero((_find(hot, c[size - 1]) >= 0) & np.frombuffer(row["trained"], bool)[doc])
            words = [before[k][at] if k < size else np.zeros(len(at), np.int64) for k in range(DEPTH)]
            yield counted([np.full(len(at), size), *words, x[at], n_x[at], np.ones(len(at), np.int64)])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_blobs(*(lambda part, *v: (part, v))(*counted(_values(table, _PAIRS))), names)])

    schema = "part long, " + ", ".join(f"{c} binary" for c in _PAIRS)
    rows = chunks.select(_TOKENS).mapInArrow(lambda batches: _gathered(pairs(batches), names), schema)
    return materialize(rows.groupBy("part").applyInArrow(add, schema).select(_PAIRS), "hot")


def _often(pairs: DataFrame, least: int) -> pa.Table:
    """w1, w2, w3, x and n of the pairs seen so often that don't end a document."""
    names = ["w1", "w2", "w3", "x", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = _values(batch, names)
            here = np.flatnonzero((columns[-1] >= least) & (columns[-2] != END))
            yield pa.RecordBatch.from_arrays([pa.array(v[here]) for v in columns], names)

    return pairs.mapInArrow(run, ", ".join(f"{c} long" for c in names)).toArrow()


def _hot(chunks: DataFrame, counts: DataFrame, buckets: int) -> tuple[Hot, DataFrame | None]:
    """The contexts seen ``HOT`` times or more (``DEPTH`` / ``HOT`` of all tokens at
    most), and the counts of what follows them.  A context is seen as often as its
    last word follows the others."""
    found = counts.where((F.col("n") >= HOT) & (F.col("word") != END)).toArrow()
    context, n = found["word"].to_numpy(), found["n"].to_numpy()
    tables, parts, suffix = [], {}, {}
    shorter, last = np.zeros(0, np.int64), context
    for size in range(1, DEPTH + 1):
        if not len(context):
            break
        parts |= dict(zip(context.tolist(), (-(-n // BUCKET)).tolist()))
        suffix |= dict(zip(context.tolist(), shorter.tolist()))
        tables.append(_follow(chunks, np.sort(context), np.unique(last), size, int(-(-n.sum() // BUCKET))))
        found = _often(tables[-1], HOT)
        # w[k - 1] stands k words before x, and k + 1 before what follows x
        w, n = [found[c].to_numpy() for c in ("x", "w1", "w2", "w3")], found["n"].to_numpy()
        shorter = last = w[0]
        for k in range(1, size):
            shorter = _joined(w[k], shorter)
        context = _joined(w[size], shorter)
    keys = np.array(sorted(parts), np.int64)
    size = np.array([parts[k] for k in keys.tolist()], np.int64)
    first = buckets + np.cumsum(size) - size
    targets: dict[int, list[np.ndarray]] = {k: [] for k in keys.tolist()}
    for k, f, m in zip(keys.tolist(), first.tolist(), size.tolist()):
        to: int | None = k
        while to is not None:
            targets[to].append(np.arange(f, f + m))
            to = suffix.get(to)
    return (Hot(keys, first, size, [np.concatenate(targets[k]) for k in keys.tolist()]),
            reduce(DataFrame.union, tables) if tables else None)


def fit(docs: DataFrame, where: str | None = None) -> Model:
    """Counts of all words of the documents (of those that meet the condition,
    if there is one), and what the tree grows from.  Documents that are scored
    by a model of some of them are kept once."""
    def own(name: str, kind: str):
        return (F.col(name) if name in docs.columns else F.lit(None)).cast(kind).alias(name)

    trained = F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)
    cut = _cut_texts(docs.select(own("doc_id", "long"), own("held_out", "boolean"), trained.alias("trained"),
                                 text_or_empty().alias("text")))
    counts = materialize(cut.select("trained", "size", "first", "word", "at").mapInArrow(_count_words, "word long, n long")
                         .groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = counts.where(F.col("n") >= max(MIN_CONTEXT * MIN_NEXT * total, 1)).toArrow()  # 1 / (the product) at most
    word, count = often["word"].to_numpy(), often["n"].to_numpy()
    order = np.argsort(word)
    word, count = word[order], count[order]
    chunks = _filled(cut, counts, word, count, distinct)
    buckets = max(LEAST_BUCKETS, -(-total // (SLICES * BUCKET)))
    hot, hot_pairs = _hot(chunks, counts, buckets)
    return Model(docs, counts, word, count, total, distinct, chunks, buckets, hot, hot_pairs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out (from the input), n_tokens, n_known, train_tokens,
    base_score and score (both log10)."""
    if docs is model.docs:
        chunks, tables = model.chunks, [(model.chunks, True, True)]
    else:
        cut = _cut_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out"),
                                     F.lit(False).alias("trained"), text_or_empty().alias("text")))
        chunks = _filled(cut, model.counts, model.word, model.count, model.distinct)
        tables = [(model.chunks, True, False), (chunks, False, True)]
    sums = []
    for turn in range(SLICES):
        gains = (_dealt(model, tables, turn).groupBy("bucket")
                 .applyInArrow(_grow(model, "gains"), "context long, chunk long, doc binary, gain binary"))
        wanted = F.col("context") == 0
        if len(model.hot.context):
            gains = materialize(gains, "gains")
            kept = [r.context for r in gains.where("chunk < 0").select("context").distinct().collect()]
            wanted = wanted | F.col("context").isin(kept)  # hot contexts only
        sums.append(materialize(gains.where(wanted & (F.col("chunk") >= 0)).groupBy("chunk")
                                .applyInArrow(_sum, "chunk long, gain binary"), "sums"))
        if len(model.hot.context):
            _drop(gains)
    z, total = model.z, model.total

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunk_rows(batches):
            at = _places(row)
            n, first = (np.frombuffer(row[c], np.int64) for c in ("n", "first"))
            known = np.add.reduceat((n > 0).astype(np.int64)[at], first[:-1])
            base = np.add.reduceat(np.log10((n + 0.1) / z)[at], first[:-1])
            own = base.copy()
            for raw in row["gains"] or []:
                gain = np.frombuffer(raw)
                own[:len(gain)] += gain
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_id"], pa.int64()), pa.array(row["held_out"], pa.bool_()), pa.array(np.diff(first)),
                 pa.array(known), pa.array(np.full(len(base), total, np.int64)), pa.array(base), pa.array(own)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    gains = reduce(DataFrame.union, sums).groupBy("chunk").agg(F.collect_list("gain").alias("gains"))
    return (chunks.select("chunk", "doc_id", "held_out", "size", "first", "at", "n").join(gains, "chunk", "left")
            .mapInArrow(rows, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                              "base_score double, score double"))
