"""The fitted models and op4's terms against slow versions of their formulas."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelflow.llm import pii, quality, toxicity
from parcelflow.llm.textbatch import ALNUM_WORDS, Words

TEXTS = ["Good words, good words here.", "", "a", "the the THE end!!", "12 34 x9 é☃ Ünïcode", " \n\t ", "one", "x" * 300,
         "Repeat repeat repeat; never-ending (stories) & more..."]


def batch(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def word_hash(word):
    return int(Words(*batch([word]), ALNUM_WORDS).hash[0])


# --- op3: ordinal regression --------------------------------------------------

def slow_score(model, text):
    """Sum of the weights of words, shapes and repeats over their number."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()
    words = re.findall(rb"[0-9a-z\x80-\xff]+", low)
    shapes = re.findall(rb"[^\x20\x09-\x0D]+", text.encode())
    top = 64 - quality.BITS
    total = 0.0
    for i, w in enumerate(words):
        total += model.weights[word_hash(w.decode("utf-8", "surrogateescape")) >> top]
        total += model.weights[1] if i and words[i - 1] == w else 0.0
    for s in shapes:
        first, before, last = (int(quality._CLASS[s[i]]) for i in (0, max(len(s) - 2, 0), len(s) - 1))
        code = np.array([((first * 260 + before) * 260 + last) * 32 + min(len(s), 20)], np.uint64)
        total += model.weights[int(quality.mix(code)[0]) >> top]
    return total / max(len(words) + len(shapes), 1)


def test_tails_against_the_formula(spark):
    rng = np.random.default_rng(1)
    model = quality.OrdinalModel(rng.normal(0, 3, 1 << quality.BITS), np.array([-0.4, 0.3, 1.1]))
    rows = list(enumerate(TEXTS)) + [(99, None)]
    got = quality.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    for r in got:
        s = slow_score(model, r.text or "")
        want = [1 / (1 + math.exp(t - s)) for t in model.thresholds]
        assert r.tails == pytest.approx(want) and r.expected_grade == pytest.approx(sum(want))


def likelihood(weights, thresholds, doc, feature, value, grade):
    s = np.bincount(doc, weights[feature] * value, len(grade))
    edge = np.concatenate([[-np.inf], thresholds, [np.inf]])
    p = 1 / (1 + np.exp(-(edge[grade + 1] - s))) - 1 / (1 + np.exp(-(edge[grade] - s)))
    return float(np.log(np.maximum(p, 1e-300)).mean())


def test_fit_climbs_the_ordinal_likelihood():
    rnd = random.Random(3)
    kinds = [["bad", "junk", "spam"], ["fair", "plain", "word"], ["fine", "prose", "good"]]
    grade = np.array([i % 3 for i in range(240)])
    texts = [" ".join(rnd.choices(kinds[g] * 3 + ["the", "of", "and"], k=30)) for g in grade]
    doc, feature, value = quality.features(*batch(texts))
    model = quality.fit_ordinal(doc, feature, value, grade)
    assert (np.diff(model.thresholds) > 0).all()
    fitted = likelihood(model.weights, model.thresholds, doc, feature, value, grade)
    share = np.log(2 * 1.0)
    constant = likelihood(np.zeros(1 << quality.BITS), np.array([-share, share]), doc, feature, value, grade)
    assert fitted > constant / 3  # log likelihoods are below 0
    # No step along or against the weights makes it much likelier.
    for step in (0.9, 1.1):
        assert likelihood(model.weights * step, model.thresholds * step, doc, feature, value, grade) < fitted + 0.05


# --- op8: convolutional network -------------------------------------------------

def slow_logit(net, words):
    """Filters over every window of one to three words, pads behind the text."""
    pad = np.zeros(toxicity.DIM)
    x = [sum((net.table[i] for i in w), start=pad) for w in words] + [pad] * 3
    pooled = []
    for k, f in zip(toxicity.WIDTHS, net.filters):
        for c in range(toxicity.FILTERS):
            best = max(sum(float(x[p + j] @ f[j * toxicity.DIM:(j + 1) * toxicity.DIM, c]) for j in range(k))
                       for p in range(len(words) + 1))
            pooled.append(max(best + float(net.bias[(k - 1) * toxicity.FILTERS + c]), 0.0))
    return float(np.dot(pooled, net.out)) + net.out_bias


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(2)
    made = toxicity.Network(rng.normal(0, 0.5, (toxicity.PAD + 1, toxicity.DIM)),
                            [rng.normal(0, 0.5, (k * toxicity.DIM, toxicity.FILTERS)) for k in toxicity.WIDTHS],
                            rng.normal(0, 0.2, len(toxicity.WIDTHS) * toxicity.FILTERS),
                            rng.normal(0, 0.5, len(toxicity.WIDTHS) * toxicity.FILTERS), 0.1)
    made.table[toxicity.PAD] = 0
    return made


def test_forward_pass(net):
    rows, first, _ = toxicity.encode(*batch(TEXTS))
    for i, z in enumerate(net.logits(rows, first)):
        assert z == pytest.approx(slow_logit(net, rows[first[i]:first[i + 1]]), abs=1e-4)


def test_gradients_by_differences(net):
    """A first step of Adagrad moves every weight against its gradient."""
    import copy
    rows, first, _ = toxicity.encode(*batch(TEXTS))
    label = np.array([i % 2 for i in range(len(TEXTS))])

    def loss(n):
        z = np.array([slow_logit(n, rows[first[i]:first[i + 1]]) for i in range(len(label))])
        return float(np.mean(np.log1p(np.exp(-np.where(label == 1, z, -z)))))

    moved = copy.deepcopy(net)
    toxicity._step(moved, rows, first, label, {}, 0.01)
    met = int(rows[0, 0])
    checked = 0
    for name, at in [("out", 0), ("out", 9), ("bias", 3), ("bias", 20), ("filters", (0, 2, 1)), ("filters", (1, 9, 4)),
                     ("filters", (2, 17, 6)), ("table", (met, 0)), ("table", (met, 5))]:
        def place(n):
            own = getattr(n, name)
            return (own[at[0]], at[1:]) if name == "filters" else (own, at)
        up, down = copy.deepcopy(net), copy.deepcopy(net)
        place(up)[0][place(up)[1]] += 1e-3
        place(down)[0][place(down)[1]] -= 1e-3
        slope = (loss(up) - loss(down)) / 2e-3
        change = place(moved)[0][place(moved)[1]] - place(net)[0][place(net)[1]]
        if abs(slope) > 1e-4:
            assert np.sign(change) == -np.sign(slope), name
            checked += 1
    assert checked >= 5


def test_thresholds_are_the_best_cuts():
    rng = np.random.default_rng(4)
    for n in (2, 5, 40):
        for prior in (0.1, 0.5):
            label = rng.integers(0, 2, n)
            label[:2] = 0, 1
            logit = rng.normal(0, 1, n) + label

            def loss(cut):
                above = logit > cut
                return prior * (~above)[label == 1].mean() + (1 - prior) * above[label == 0].mean()
            cut = toxicity._threshold(logit, label, prior)
            assert loss(cut) == pytest.approx(min(loss(c) for c in [*logit, logit.min() - 1]))


# --- op4: terms ------------------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def slow_terms(rows, min_support, generalise):
    """(text -> spans of terms) by the module's formula; emails are the only entities."""
    docs = [t or "" for _, t in rows]
    words = [{w.lower() for w in re.findall(r"[^\W\d_]{3,}", re.sub(EMAIL, " ", t))} for t in docs]
    entities = [set(re.findall(EMAIL, t)) for t in docs]
    n_t, n_e, both = Counter(), Counter(), Counter()
    for w, e in zip(words, entities):
        n_t.update(w)
        n_e.update(e)
        both.update((x, y) for x in w for y in e)
    out = {}
    for t, e in zip(docs, entities):
        share = {}
        for (term, entity), n in both.items():
            information = math.log(len(docs) / n_e[entity])
            if entity in e and n >= min_support and n_e[entity] >= min_support and information > 0:
                own = math.log(len(docs) * n / (n_t[term] * n_e[entity])) / information
                if own >= generalise:
                    share[term] = max(share.get(term, 0), own)
        base = [m.span() for m in re.finditer(EMAIL, t)]
        out[t] = [(m.start(), m.end(), share[m[0].lower()]) for m in re.finditer(r"[^\W\d_]+", t)
                  if m[0].lower() in share and not any(s < m.end() and m.start() < e for s, e in base)]
    return out


@pytest.mark.parametrize("min_support,generalise", [(3, 0.8), (2, 0.5)])
def test_terms_against_brute_force(spark, min_support, generalise):
    rnd = random.Random(8)
    names = {f"p{i}@mail.org": [f"Nick{chr(97 + i)}", f"project{chr(97 + i)}"] for i in range(6)}
    common = "alpha beta gamma delta epsilon".split()
    rows = []
    for i in range(90):
        own = rnd.choice(list(names)) if i % 2 else None
        words = rnd.choices(common, k=8)
        if own:
            words += [own, *names[own], names[own][0].upper()][:rnd.randint(1, 4)] + rnd.choices(common, k=2)
        if i % 9 == 0:
            words.append(rnd.choice(list(names.values()))[0])  # also without the address
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, rows[1][1]), (202, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = slow_terms(rows, min_support, generalise)
    texts = {i: t or "" for i, t in rows}
    found = pii.find(df, min_support, generalise).select("doc_id", F.col("terms")).collect()
    assert sum(len(r.terms) for r in found) > 20
    for r in found:
        got = sorted((t.s, t.e, t.share) for t in r.terms)
        assert got == [(s, e, pytest.approx(x)) for s, e, x in sorted(want[texts[r.doc_id]])]
