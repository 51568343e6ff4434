"""Columns named like the operators' own, and very long texts."""

import random

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import decontaminate, minhash_dedup, pii, quality

NAMES = ["_key", "_M", "_d", "_k", "tails", "Expected_Grade", "_hits", "_items", "_n_words", "row", "base", "terms", "key",
         "shares", "words", "_x", "a b", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choices(["alpha", "beta", "gamma", "delta", "good", "bad"], k=40))
             + (f" mail joe{i % 4}@site.com secretname{i % 4} now" if i % 3 == 0 else "")) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in NAMES if n != "n_chars"} | {
        "n_chars": F.length("text")})


def kept(docs, out):
    """The result has the input's columns, and rows that keep all but text."""
    assert out.columns == docs.columns
    held = [c for c in docs.columns if c not in ("text", "n_chars")]
    before = {r[0]: tuple(r) for r in docs.select(*[f"`{c}`" for c in held]).collect()}
    rows = out.collect()
    for r in rows:
        assert tuple(r[c] for c in held) == before[r.doc_id]
        assert r.n_chars == len(r.text)
    return {r.doc_id: r.text for r in rows}


def test_sanitise_keeps_clashing_columns(docs):
    texts = kept(docs, pii.sanitise(docs))
    assert len(texts) == 60 and not any("@" in t for t in texts.values())


def test_select_keeps_clashing_columns(spark, docs):
    grades = docs.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade"))
    kept(docs, quality.select(docs, grades))


def test_clean_keeps_clashing_columns(spark, docs):
    text = docs.where("doc_id = 7").first().text
    items = spark.createDataFrame([("i", " ".join(text.split()[5:17]))], "item_id string, text string")
    texts = kept(docs, decontaminate.clean(docs, items))
    assert len(texts[7].split()) < 40


def test_deduplicate_keeps_clashing_columns(docs):
    kept(docs, minhash_dedup.deduplicate(docs))
