"""Operators 11 to 13 against brute-force versions, on the small tables and on
awkward rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import conversations, queries, spelling, token_counts
from parcelflow.llm.common import read_table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


# --- conversations ---------------------------------------------------------

def damaged(rows):
    out = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub("[.!?]", "", x)
        if kind == 4:
            r = "user"
        out += [(c, t, r, x)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Dijkstra over (cost, audit): the first whole repair taken from the heap
    is the cheapest, and the least among those."""
    follow = {"s": {"": "s"}, "u": {"": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, place, out = heapq.heappop(heap)
        if i == len(rows) and place in ("", "a"):
            return cost, audit, out
        if (i, place) in seen:
            continue
        seen.add((i, place))
        names = [(n, follow[n[0]].get(place)) for n in ("user", "assistant") if follow[n[0]].get(place)]
        for name, q in names:
            heapq.heappush(heap, (cost + 2, audit + "I", i, q, out + (name + ":",)))
        if i == len(rows):
            continue
        role, text, gone, cut = rows[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, place, out))
        if not gone:
            if q := follow.get(role[:1], {}).get(place):
                heapq.heappush(heap, (cost + cut, audit + "K", i + 1, q, out + (f"{role}:{text}",)))
            for name, q in names:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, q, out + (f"{name}:{text}",)))


def repaired(rows):
    found = {r[0]: [] for r in rows}
    for r in damaged(rows):
        found[r[0]].append(r)
    out = {}
    for conv, own in found.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(),
                                hashlib.sha256(f"{len(r[2])}\0{r[2]}\0{r[3]}".encode()).hexdigest()))
        turns = [r[1] for r in own if r[1] is not None]
        seen, n, todo = set(), [0, 0, 0, 0], []
        for _, _, role, text in own:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else 3
            seen.add((role, text))
            n[fault] += 1
            todo.append((role, text, fault < 2, int(fault == 2)))
        cost, audit, lines = cheapest(todo)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n[:3],
                     sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def as_dict(df):
    rows = df.collect()
    out = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
           for r in rows}
    assert len(out) == len(rows)
    return out


def test_block_tables_against_shortest_paths():
    table, rnd = conversations.tables(), random.Random(5)
    names = ["system", "user", "assistant", "tool"]
    for _ in range(1500):
        symbols = bytes(rnd.randrange(9) for _ in range(rnd.randrange(14)))
        rows = [(names[s % 4] if s < 8 else "user", "x", s == 8, int(4 <= s < 8)) for s in symbols]
        front, paid = table.through(symbols)
        audit, _, last = table.trace(symbols, table.end, conversations.START)
        cost = paid[table.end] + table.vectors[front[table.end]][conversations.START]
        assert cheapest(rows)[:2] == (cost, audit + "I" * len(conversations._CLOSING[last]))


def test_all_blocks_equal_row_by_row():
    for block in (1, 2, 3):
        table = conversations.Tables(block)
        assert table.vectors == conversations.tables().vectors
        for symbols in ([8, 0, 5], [1, 2, 3, 4, 7], [6]):
            assert [list(x) for x in table.through(bytes(symbols))] == [
                list(x) for x in conversations.tables().through(bytes(symbols))]


@pytest.fixture(scope="module")
def turns():
    rnd = random.Random(7)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", "tool", "", "user"]),
             rnd.choice(["Hi.", "Hi", "ok?", "Well then!  ", " \t", "no end \x0b", "a\nb.\n", "é。", None, "x."]))
            for c in range(60) for t in range(rnd.randrange(1, 12))]
    rows += [(70, None, "user", "no turn."), (70, None, "assistant", "none."), (70, 4, None, "no role."), (70, 2, "user", None),
             (None, 1, "user", "no id."), (None, None, None, None), (71, 10**12, "user", "far."), (71, -5, "assistant", "x."),
             (72, 3, "user", "word " * 200_000), (72, 4, "assistant", "same."), (72, 4, "assistant", "same.")]
    # one conversation that holds far more than a third of all rows
    rows += [(99, t, ("user", "assistant")[t % 2], f"turn {t}" + "." * (t % 3)) for t in range(3000) if t % 17]
    return rows


def test_repair(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(7)
    df = df.withColumns({"pos": F.lit(1), "seg": F.lit("s"), "symbol": F.lit(0), "conv": F.lit("x"), "kind": F.lit(None)})
    want = repaired(turns)
    for rows in (conversations.SEGMENT_ROWS, 3):
        assert as_dict(conversations.report(conversations.repair(conversations.damage(df), rows))) == want
    assert conversations.report(conversations.repair(conversations.damage(df.where("false")))).count() == 0


def test_repaired_rows_are_in_order(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = conversations.repair(conversations.damage(df), 50)
    for r in found.repaired.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pos", "sub", "role"))).alias("x")).collect():
        assert re.fullmatch("s?(ua)+", "".join(x.role[0] for x in r.x))


def test_conversation_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert as_dict(queries.op11_conversation_repair(spark, SF)) == repaired(rows)


# --- spelling --------------------------------------------------------------

def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(rows, least_count=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run if h % 199 else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= least_count}
    by_rest = {}
    for w in n:
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1:], set()).add(w)
    form, near = {}, {}
    for w in n:
        close = set().union(*(by_rest.get(w[:i] + w[i + 1:], set()) for i in range(len(w))), by_rest.get(w, set()))
        close |= {w[:i] + w[i + 1:] for i in range(len(w))} & n.keys()
        close = {x for x in close if one_apart(w, x)}
        near[w] = len(close)
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], near[w], n[form[w]] if form[w] else None)
    return out


def as_forms(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    out = {r.word: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdeé"])
def test_index_against_brute_force(letters):
    rnd = random.Random(letters)
    for _ in range(15):
        words = list({"".join(rnd.choices(letters, k=rnd.randint(6, 9))) for _ in range(rnd.randint(1, 120))})
        asked = words + ["".join(rnd.choices(letters + "z", k=rnd.randint(6, 9))) for _ in range(40)]
        index = spelling.BiIndex(words)
        got = [(int(a), words[b]) for left in (False, True) for a, b in zip(*index.search(asked, left))]
        assert sorted(got) == sorted((i, w) for i, a in enumerate(asked) for w in words if one_apart(a, w))


def test_near_words_in_cut_groups(spark):
    """Groups far above the size of a block, so that they are cut."""
    rnd = random.Random(2)
    words = {"prefix" + "".join(rnd.choices("abc", k=rnd.randint(2, 6))): rnd.choice([5, 9, 60, 400]) for _ in range(400)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [{r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(df, chars).collect()}
           for chars in (spelling.BLOCK_CHARS, 300)]
    for word, n in words.items():
        close = [x for x in words if one_apart(word, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        best = best if best and words[best] >= 5 * n else None
        assert got[0][word] == got[1][word] == (len(close), best, best and words[best])


def test_roots_of_long_chains(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(70)] + [("x", "w010"), ("y", "z")]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "z" if w == "y" else "w070" for w, _ in chain}
    assert spelling.roots(spark.createDataFrame([], "word string, form string")).count() == 0


AWKWARD = [(None, "Nature nature NATURE natura Nature nature"), (1, None), (2, ""), (3, "!!! 123 "), (4, "naturé " * 6),
           (4, "naturé " * 6), (5, "natures " * 40 + "×÷ÀÖØÞßàöøÿ " * 7), (6, "a" * 300_000), (7, ("b" * 5000 + " ") * 5),
           (8, ("b" * 4999 + " ") * 40), (9, "nature " * 7 + "nœture natuře " * 9), (-1, "naturw " * 5)]


def test_spelling(spark):
    own = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()] + AWKWARD
    df = spark.createDataFrame(own, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(1), "key": F.lit(0)})
    assert as_forms(spelling.variants(df)) == variants(own)
    assert as_forms(spelling.variants(df, block_chars=2000)) == variants(own)
    assert spelling.variants(df.where("false")).count() == 0


def test_spelling_query(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    assert as_forms(queries.op12_spelling(spark, SF)) == variants(rows)


# --- token counts ----------------------------------------------------------

def test_pre_tokens_against_the_library():
    count, rnd = token_counts.PieceCounter(MODEL), random.Random(1)
    pieces = list("aabbcdeehilnorst     \n\n\r\t\u2581\u2581.,;:()<>s/\U0001f642é中文字\0\u3000ﬀ") + [
        "<s>", "</s>", "<unk>", "<0x0A>", "the ", " of", "();\r\n"]
    for _ in range(4000):
        text = "".join(rnd.choices(pieces, k=rnd.randrange(40)))
        own = token_counts.units(text)
        assert sum(n * k for n, k in zip(own.values(), count.count(list(own)))) == len(count.library.encode(text))


@pytest.mark.parametrize("share", [1e-6, 0.01, 2.0])
def test_token_counts(spark, share, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT_SHARE", share)  # all hot, a few hot, none
    own = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()] + [
        (None, "no id"), (None, "no id"), (1, None), (2, ""), (3, " "), (4, "  \n \u2581x  "), (5, "word " * 60_000),
        (6, "a" * 200_000), (7, "x y " * 2047 + "z"), (7, "x y " * 2048)]
    df = spark.createDataFrame(own, "doc_id long, text string").withColumns({
        "unit": F.lit("u"), "row": F.lit(1), "freq": F.lit(0), "n_bytes": F.lit("b"), "pieces": F.lit(2), "n": F.lit(1)})
    library = token_counts.PieceCounter(MODEL).library
    want = Counter()
    for doc_id, text in own:
        n = len(library.encode(text or ""))
        want[doc_id, len((text or "").encode()), n, n > 4096] += 1
    assert Counter(map(tuple, token_counts.count_tokens(df, MODEL).collect())) == want
    assert token_counts.count_tokens(df.where("false"), MODEL).count() == 0


def test_token_query(spark):
    library = token_counts.PieceCounter(MODEL).library
    rows = read_table(spark, SF, "documents").select("doc_id", "text").collect()
    assert {r.doc_id: r.n_tokens for r in queries.op13_token_counts(spark, SF).collect()} == {
        r.doc_id: len(library.encode(r.text or "")) for r in rows}
