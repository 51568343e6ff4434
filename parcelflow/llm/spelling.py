"""Spelling variants of a vocabulary: bidirectional FM-index search schemes.

Two words are near if one inserted, deleted or replaced code point turns one
into the other.  One error leaves either half of the searched word whole, so a
word has two searches: its first half is matched exactly and then extended to
the right over the second half with one error; and its second half is matched
exactly and extended to the left over the first half with one error.  Both run
on one bidirectional index over the vocabulary, the words between delimiters:
a state is a pair of suffix-rank intervals, of the text and of the reversed
text, that every step on either side narrows together.  The second search
drops a word that begins with the first half, as the first search finds it, so
every near pair is found once from each of its ends.

The vocabulary is dealt by the half that must match: a word is searched for
in the group of its (side, half), and stored in the groups of the halves that
searched words of its length and one more or less would bring.  A task packs
whole groups into index blocks of at most ``BLOCK_CHARS``.  A group above that
(many words with one half) is cut into blocks of its own by a hash of the word,
and its searches go to every one of them.  Words that take part in no search
result come back with no near words.

``roots`` follows forms by pointer doubling; a form is at least ``RATIO`` times
as frequent as its word, so chains are short and have no cycles.

Null texts have no words; a null doc_id counts as the empty text in the damage
of the query.  Repeated rows count again.  Ties between forms go to the word
that is least in code-point order.  An empty table gives no rows.  Extra
columns of the documents are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.common import materialize, partitions

#: Characters (with delimiters) of one index block; about 60 bytes each are held.
BLOCK_CHARS = 2_000_000
#: How much more frequent than its word a form must be.
RATIO = 5
#: Distinct words that one task holds before it passes their counts on.
HELD_WORDS = 300_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_STEP = 32
#: Words of the vocabulary that one task searches for, on average.
TASK_WORDS = 10_000
#: Words searched for at once.
SEARCHES = 20_000


def damaged(doc_id: int | None, run: str, every: int) -> str:
    """The run, or where the checksum of ``doc_id:run`` is a multiple of
    ``every`` the run without one of its code points."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def vocabulary(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199) -> DataFrame:
    """Words of at least ``least_length`` code points that occur at least
    ``least_count`` times in all texts, with their counts n."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())],
                                              ["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                low = (text.as_py() or "").encode().translate(_LOWER).decode()
                for found, n in Counter(m[0] for m in _RUN.finditer(low)).items():
                    if len(found) >= least_length:
                        word = damaged(doc_id, found, every)
                        if len(word) >= least_length:
                            seen[word] += n
                if len(seen) > HELD_WORDS:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (own.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


class BiIndex:
    """A bidirectional FM-index over distinct words without the code point 0,
    for many searches at once.

    The text is the words with a 0 in front of each and one at the end, read as
    a ring.  A state is three arrays: ``lo``, the first rank among the text's
    suffixes; ``rev``, the first rank among those of the reversed text; ``size``,
    the length of both intervals.
    """

    def __init__(self, words: list[str]):
        self.words = words
        raw = np.frombuffer(("\0" + "\0".join(words) + "\0").encode("utf-32-le"), np.uint32)
        self.alphabet, code = np.unique(raw, return_inverse=True)
        self.sigma, self.n = len(self.alphabet), len(code)
        self.order = self._suffixes(code)
        self.fore = self._rows(code, self.order)
        self.back = self._rows(code[::-1], self._suffixes(code[::-1]))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=self.sigma))])
        self.word_at = np.flatnonzero(code == 0)  # the delimiter in front of each word

    @staticmethod
    def _suffixes(code: np.ndarray) -> np.ndarray:
        """Order of the ring's suffixes by prefix doubling.  Two delimiters
        meet in one place only, so all suffixes differ."""
        n = len(code)
        rank, step = code.astype(np.int64), 1
        while True:
            key = rank * (n + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            if rank[order[-1]] == n - 1:
                return order
            step *= 2

    def _rows(self, code: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The Burrows-Wheeler row, padded, and for every 32nd place of it and
        every symbol the number of smaller symbols before that place."""
        blocks = self.n // _STEP + 1
        bwt = np.full(blocks * _STEP, self.sigma, np.uint8 if self.sigma < 256 else np.int32)
        bwt[:self.n] = code[order - 1]
        per = np.zeros((blocks + 1, self.sigma + 2), np.int32)
        np.add.at(per, (np.repeat(np.arange(1, blocks + 1), _STEP), bwt.astype(np.int64) + 1), 1)
        np.cumsum(per, 0, out=per)
        np.cumsum(per, 1, out=per)
        return bwt.reshape(blocks, _STEP), per

    @staticmethod
    def _smaller(rows, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` entries of the row are below ``symbol``."""
        bwt, below = rows
        block, inside = at // _STEP, at % _STEP
        block_row = np.minimum(block, len(bwt) - 1)
        hit = (bwt[block_row] < symbol[:, None]) & (np.arange(_STEP) < inside[:, None])
        return below[block, symbol] + hit.sum(1, dtype=np.int64)

    def extend(self, state, symbol: np.ndarray, left: bool):
        """The states after one more symbol on the left, or on the right."""
        lo, rev, size = state
        rows, own, other = (self.fore, lo, rev) if left else (self.back, rev, lo)
        less_lo, less_hi = self._smaller(rows, symbol, own), self._smaller(rows, symbol, own + size)
        same_lo, same_hi = self._smaller(rows, symbol + 1, own), self._smaller(rows, symbol + 1, own + size)
        new_own = self.first[symbol] + same_lo - less_lo
        new_other = other + less_hi - less_lo
        new_size = (same_hi - less_hi) - (same_lo - less_lo)
        return (new_own, new_other, new_size) if left else (new_other, new_own, new_size)

    def symbols(self, state, left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state number, symbol) of every symbol next to each state's matches,
        but for the delimiter."""
        lo, rev, size = state
        bwt = (self.fore if left else self.back)[0].reshape(-1)
        own = lo if left else rev
        few = size <= self.sigma
        who = np.repeat(np.flatnonzero(few), size[few])
        start = np.cumsum(size[few]) - size[few]
        place = own[who] + np.arange(len(who)) - np.repeat(start, size[few])
        found = np.unique(who * (self.sigma + 1) + bwt[place])
        many = np.flatnonzero(~few)
        found = np.concatenate([found, (many[:, None] * (self.sigma + 1) + np.arange(1, self.sigma)).reshape(-1)])
        who, symbol = found // (self.sigma + 1), found % (self.sigma + 1)
        return who[symbol > 0], symbol[symbol > 0]

    def encode(self, words: list[str]) -> np.ndarray:
        """Symbols of the words, one row each; ``sigma`` where a code point is
        not in the index, -1 behind the end."""
        raw = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        code = np.minimum(np.searchsorted(self.alphabet, raw), self.sigma - 1)
        code = np.where(self.alphabet[code] == raw, code, self.sigma)
        length = np.fromiter(map(len, words), np.int64, len(words))
        out = np.full((len(words), length.max(initial=0)), -1, np.int64)
        out[np.arange(out.shape[1]) < length[:, None]] = code
        return out

    def search(self, words: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
        """(number of the searched word, number of the indexed word) of the
        pairs one error apart, each once: with the first half whole; or, to the
        ``left``, with the second half whole and an error in the first."""
        parts = [self._search(words[i:i + SEARCHES], left) for i in range(0, len(words), SEARCHES)]
        return (np.concatenate([np.zeros(0, np.int64)] + [w + i * SEARCHES for i, (w, _) in enumerate(parts)]),
                np.concatenate([np.zeros(0, np.int64)] + [f for _, f in parts]))

    def _search(self, words: list[str], left: bool) -> tuple[np.ndarray, np.ndarray]:
        code = self.encode(words)
        length = (code >= 0).sum(1)
        half = length // 2
        if left:  # mirrored: read the word from its end
            code = np.take_along_axis(code, (length[:, None] - 1 - np.arange(code.shape[1])) % code.shape[1], 1)
        whole = length - half if left else half  # symbols of the half matched exactly
        who = np.arange(len(words))
        state = (np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), self.n))
        # the exact half: from its inner end outwards, then the delimiter; so
        # the search turns round and both intervals are needed
        for k in range(int(whole.max(initial=0)), -1, -1):
            active = np.flatnonzero(whole[who] >= k)
            part = tuple(s[active] for s in state)
            symbol = code[who[active], k - 1] if k else np.zeros(len(active), np.int64)
            known = (symbol < self.sigma)
            new = self.extend(part, np.where(known, symbol, 0), not left)
            new = (new[0], new[1], np.where(known, new[2], 0))
            for s, v in zip(state, new):
                s[active] = v
            alive = state[2] > 0
            who, state = who[alive], tuple(s[alive] for s in state)
        at = whole[who].copy()
        hit_who, hit_rank = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        clean = (who, at, state)  # no error so far
        one = (np.zeros(0, np.int64), np.zeros(0, np.int64), tuple(np.zeros(0, np.int64) for _ in range(3)))
        while len(clean[0]) or len(one[0]):
            who1, at1, st1 = one
            done = at1 == length[who1]
            end = self.extend(tuple(s[done] for s in st1), np.zeros(int(done.sum()), np.int64), left)
            hit = end[2] > 0
            hit_who.append(who1[done][hit])
            hit_rank.append(end[0][hit])
            step1 = self._match(who1[~done], at1[~done], tuple(s[~done] for s in st1), code, left)
            who0, at0, st0 = clean
            inner = at0 < length[who0]
            # an extra code point of the indexed word, anywhere; or another one
            # in place of the next
            state_no, symbol = self.symbols(st0, left)
            new = self.extend(tuple(s[state_no] for s in st0), symbol, left)
            own = np.where(inner[state_no], code[who0[state_no], np.minimum(at0[state_no], code.shape[1] - 1)], -1)
            swap = inner[state_no] & (symbol != own)
            made = [step1,
                    (who0[state_no], at0[state_no], new),
                    (who0[state_no][swap], at0[state_no][swap] + 1, tuple(s[swap] for s in new)),
                    (who0[inner], at0[inner] + 1, tuple(s[inner] for s in st0))]  # one left out
            one = self._unique(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]),
                               tuple(np.concatenate([m[2][i] for m in made]) for i in range(3)))
            clean = self._match(who0[inner], at0[inner], tuple(s[inner] for s in st0), code, left)
        who, rank = np.concatenate(hit_who), np.concatenate(hit_rank)
        # the suffix of that rank begins at the delimiter in front of the word
        found = np.searchsorted(self.word_at, self.order[rank])
        pair = np.unique(who * len(self.words) + found)
        who, found = pair // len(self.words), pair % len(self.words)
        if left and len(who):
            own = np.array(words, object)[who]
            keep = np.fromiter((not self.words[f].startswith(w[:len(w) // 2]) for w, f in zip(own, found)), bool, len(who))
            who, found = who[keep], found[keep]
        return who, found

    def _match(self, who, at, state, code, left):
        """The states after the searched word's own next symbol."""
        symbol = code[who, at] if len(who) else np.zeros(0, np.int64)
        known = symbol < self.sigma
        who, at, symbol = who[known], at[known], symbol[known]
        new = self.extend(tuple(s[known] for s in state), symbol, left)
        alive = new[2] > 0
        return who[alive], at[alive] + 1, tuple(s[alive] for s in new)

    @staticmethod
    def _unique(who, at, state):
        """Different edits may lead to one state: keep it once."""
        alive = state[2] > 0
        who, at, state = who[alive], at[alive], tuple(s[alive] for s in state)
        order = np.lexsort((*state, at, who))
        rows = np.stack([who, at, *state])[:, order]
        first = np.ones(len(who), bool)
        first[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        keep = order[first]
        return who[keep], at[keep], tuple(s[keep] for s in state)


def _keys(first: F.Column, second: F.Column) -> list[F.Column]:
    """The groups of a word for halves of these lengths."""
    return [F.concat(F.lit("<"), F.substring("word", F.lit(1), first)),
            F.concat(F.lit(">"), F.expr("word").substr(F.length("word") - second + 1, second))]


def dealt(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (key, part, asks, word, n): the words that each group stores
    (``asks`` 0) and those that search it (1).  ``part`` cuts a group of more
    than ``block_chars`` (-1: whole); its searches go to every part."""
    size = F.length("word")
    stored = F.array_distinct(F.array(*[k for d in (-1, 0, 1) for k in _keys(
        F.floor((size + d) / 2).cast("int"), F.ceil((size + d) / 2).cast("int"))]))
    store = words.select(F.explode(stored).alias("key"), "word", "n")
    asks = words.select(F.explode(F.array(*_keys(F.floor(size / 2).cast("int"), F.ceil(size / 2).cast("int")))).alias("key"),
                        "word", "n")
    large = (store.groupBy("key").agg(F.ceil(F.sum(size + 1) / block_chars).cast("int").alias("parts"))
             .where("parts > 1"))
    own = F.coalesce(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), F.lit(-1))
    every = F.coalesce(F.sequence(F.lit(0), F.col("parts") - 1), F.array(F.lit(-1)))
    return (store.join(large, "key", "left").select("key", own.alias("part"), F.lit(0).alias("asks"), "word", "n")
            .union(asks.join(large, "key", "left").select("key", F.explode(every).alias("part"), F.lit(1), "word", "n")))


def _search_blocks(block_chars: int):
    """Batches sorted by (key, part, asks) -> per searched word and block the
    number of near words and the best of them."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])

    def results(store: dict[str, int], asks: tuple[list[str], list[str]]):
        index = BiIndex(list(store))
        count = np.fromiter(store.values(), np.int64, len(store))
        by_name = sorted(range(len(store)), key=index.words.__getitem__)
        rank = np.empty(len(store), np.int64)
        rank[by_name] = np.arange(len(store))
        for left, words in enumerate(asks):
            who, found = index.search(words, bool(left))
            order = np.lexsort((rank[found], -count[found], who))
            who, found = who[order], found[order]
            own, at, n = np.unique(who, return_index=True, return_counts=True)
            best = found[at]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[i] for i in own], pa.string()), pa.array(n, pa.int64()),
                 pa.array(count[best], pa.int64()), pa.array([index.words[i] for i in best], pa.string())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store: dict[str, int] = {}
        asks: tuple[list[str], list[str]] = ([], [])
        chars = waiting = 0
        group = None
        for batch in batches:
            for key, part, is_ask, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, part) != group:
                    # a part of a cut group has its block alone: words that come with
                    # other groups would be found once more
                    if chars >= block_chars or waiting >= SEARCHES * 20 or part >= 0 or (group and group[1] >= 0):
                        if waiting and store:
                            yield from results(store, asks)
                        store, asks, chars, waiting = {}, ([], []), 0, 0
                    group = key, part
                if is_ask:
                    asks[key[0] == ">"].append(word)
                    waiting += 1
                    if waiting >= SEARCHES * 20 and part >= 0:  # a large group's searches, in turns
                        yield from results(store, asks)
                        asks, waiting = ([], []), 0
                elif word not in store:
                    store[word] = n
                    chars += len(word) + 1
        if waiting and store:
            yield from results(store, asks)

    return run


def near_words(words: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Distinct words with counts (word, n) -> (word, n, n_near, form, form_n):
    how many words are near, and the most frequent near one."""
    rows = dealt(words.select("word", "n"), block_chars)
    # a search costs far more than its few bytes: the number of tasks is set here
    tasks = max(partitions(words.sparkSession), words.count() // TASK_WORDS)
    found = (rows.repartition(tasks, "key", "part").sortWithinPartitions("key", "part", "asks")
             .select("key", "part", "asks", "word", "n")
             .mapInArrow(_search_blocks(block_chars), "word string, n_near long, form_n long, form string")
             .groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                  F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("best")))
    is_form = -F.col("best.m") >= RATIO * F.col("n")
    return words.select("word", "n").join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) without nulls -> (word, root): the end of each word's chain
    of forms, by pointer doubling."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = materialize(at.join(nxt, "root", "left")
                         .select("word", F.coalesce("further", "root").alias("root"),
                                 F.col("further").isNotNull().alias("moved")), "roots")
        moved = not at.where("moved").isEmpty()
        at = at.select("word", "root")
        if not moved:
            return at


def variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, every: int = 199,
             block_chars: int = BLOCK_CHARS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    words = materialize(vocabulary(docs, least_length, least_count, every), "vocabulary")
    near = materialize(near_words(words, block_chars), "near-words")
    end = roots(near.where("form is not null"))
    return near.join(end, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
