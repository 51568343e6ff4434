"""Token counts by pre-tokens: pieces are counted once per distinct pre-token
and joined to each document's pre-token frequencies; no ids are made.

A pre-token is a run of blanks with the characters behind it, up to the next
blank or line break, or a line break alone.  No piece of the vocabulary crosses
such a cut (``PieceCounter`` checks it), so merges never do either, and the
counts add up exactly.  Pre-tokens are compared as whole strings, never by
hash.

One pass counts every pre-token of the corpus, the library then splits each
distinct one once, and a second pass makes (document, pre-token, frequency).
Pre-tokens with a share of ``HOT_SHARE`` of all and at most ``HOT_BYTES`` bytes
are looked up in a broadcast table (at most 1 / HOT_SHARE rows by the choice of
the share); all others are joined by a shuffle on the pre-token.

Null and empty texts have 0 tokens.  Rows with equal or null doc_id are counted
apart, one row each; repeated rows repeat.  An empty table gives no rows.  Only
doc_id and text are read, so other columns never clash.  A text without blanks
or line breaks is one pre-token and is split by the library whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize

#: Share of all pre-tokens from which one is broadcast, and its length at most.
HOT_SHARE = 1e-6
HOT_BYTES = 32
#: Characters of distinct pre-tokens that one task holds before it passes them on.
HELD_CHARS = 8_000_000

_UNITS = re.compile("\n| +[^ \n]*|[^ \n]+")
_BLANK = "▁"  # the library's mark for a blank


def units(text: str) -> Counter:
    """Pre-tokens of a text, with the blank that the library puts in front."""
    return Counter(map(itemgetter(0), _UNITS.finditer(" " + text.replace(_BLANK, " ")))) if text else Counter()


class PieceCounter:
    """Pieces per pre-token, as the library counts them inside a text."""

    def __init__(self, model: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            if len(piece) > 1 and ("\n" in piece or re.search(f"[^{_BLANK}]{_BLANK}", piece)):
                raise ValueError(f"the piece {piece!r} crosses pre-tokens")
        probe = " A　ﬀ  b "
        if self.library.normalize(probe) != _BLANK + probe.replace(" ", _BLANK):
            raise ValueError("the model's normaliser changes texts")
        self.alone = len(self.library.encode("\n"))

    def count(self, pre_tokens: list[str]) -> list[int]:
        # behind a line break no blank is put in front, and nothing merges with it
        return [len(ids) - self.alone for ids in self.library.encode(["\n" + u for u in pre_tokens], num_threads=1)]


_COUNTERS: dict[str, PieceCounter] = {}


def counter(model: str) -> PieceCounter:
    """One counter per model and Python worker."""
    if model not in _COUNTERS:
        _COUNTERS[model] = PieceCounter(model)
    return _COUNTERS[model]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def frequencies(docs: DataFrame) -> DataFrame:
    """Every distinct pre-token of all texts and how often it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        chars = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                              ["unit", "n"])
        for batch in batches:
            for text in batch.column(1):
                if text := text.as_py():
                    new = units(text)
                    chars += sum(len(u) + 40 for u in new if u not in seen)
                    seen.update(new)
                    if chars > HELD_CHARS:
                        yield out()
                        seen, chars = Counter(), 0
        if seen:
            yield out()

    return _texts(docs).mapInArrow(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def with_pieces(distinct: DataFrame, model: str) -> DataFrame:
    """Pre-tokens with the number of pieces each is split into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model).count
        for batch in batches:
            pieces = pa.array(count(batch.column(0).to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pieces], ["unit", "n", "pieces"])

    return distinct.select("unit", "n").mapInArrow(run, "unit string, n long, pieces long")


def _pairs(docs: DataFrame, hot: dict[str, int]) -> DataFrame:
    """(row, unit, freq) of the pre-tokens not in ``hot``; and per document one
    row with its id, its bytes and, as ``freq``, the pieces of its hot ones.
    That row's unit is two line breaks and a number, which no pre-token is."""
    schema = pa.schema([("unit", pa.string()), ("row", pa.int64()), ("freq", pa.int64()),
                        ("doc_id", pa.int64()), ("n_bytes", pa.int64())])

    def rows_of(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                hot_pieces = 0
                for unit, freq in units(text).items():
                    if (pieces := hot.get(unit)) is not None:
                        hot_pieces += freq * pieces
                    else:
                        yield unit, row, freq, None, None
                yield f"\n\n{row}", row, hot_pieces, doc_id.as_py(), len(text.encode())
                row += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(batches)
        while part := list(islice(rows, 50_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), schema)], schema=schema)

    return _texts(docs).mapInArrow(run, "unit string, row long, freq long, doc_id long, n_bytes long")


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than
    ``limit`` tokens)."""
    table = materialize(with_pieces(frequencies(docs), model), "pre-tokens")
    total = table.agg(F.sum("n")).first()[0] or 0
    is_hot = (F.col("n") >= max(2, total * HOT_SHARE)) & (F.octet_length("unit") <= HOT_BYTES)
    hot = {r["unit"]: r["pieces"] for r in table.where(is_hot).select("unit", "pieces").collect()}
    pieces = F.coalesce(F.col("freq") * F.col("pieces"), F.when(F.col("n_bytes").isNotNull(), F.col("freq")))
    return (_pairs(docs, hot).join(table.where(~is_hot).select("unit", "pieces"), "unit", "left")
            .groupBy("row")
            .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(pieces).alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
