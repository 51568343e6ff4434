"""Suffix dedup where blocks of anchors hold no repeat, and few documents."""

import random
import re
import string
import time

import pytest

from parcelflow.llm import suffix_dedup
from parcelflow.llm.common import materialize
from tests.llm.test_operators import suffix_brute


def check(spark, rows, length=200):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix_dedup.report(suffix_dedup.deduplicate(df, length)).collect()
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == set(suffix_brute(rows, length))


def own(seed, n):
    return "".join(random.Random(seed).choices(string.ascii_lowercase + "   ", k=n))


def test_a_shared_phrase_but_no_repeat(spark):
    phrase = own("phrase", 62)
    check(spark, [(i, own(i, 400) + phrase + own(-i - 1, 400)) for i in range(30)])


@pytest.mark.parametrize("rows", [
    [(1, own(1, 900))],
    [(i, own(i, 500)) for i in range(5)],
    [(1, "x"), (2, None), (3, ""), (4, "short")],
    [(1, own(1, 200)), (2, own(1, 200))],
    [(1, "ab" * 400)],
])
def test_few_documents(spark, rows):
    check(spark, rows)


def test_no_marks():
    parts = [own(i, 300).encode() for i in range(3)]
    assert suffix_dedup.repeated(parts, [1, 1, 1], 200) == [[], [], []]
    assert suffix_dedup.repeated(parts, [1, 2, 1], 200) == [[], [0, 300], []]


def test_whole_texts_are_dealt_out_once_a_step(spark, monkeypatch):
    """The step that cuts segments shuffles the texts once, and repeated rows and
    null ids keep their places in it."""
    plans, plain = {}, suffix_dedup.materialize

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return plain(df, name)

    monkeypatch.setattr(suffix_dedup, "materialize", noted)
    same = own("same", 300)
    rows = [(1, own(1, 250) + same), (1, own(1, 250) + same), (None, same + own(2, 250)), (0, same + own(2, 250)), (3, None)]
    check(spark, rows)
    texts = [x for x in re.findall(r"\) Exchange\nInput \[\d+\]: (\[.*\])", plans["segments"]) if re.search(r"text#|first#", x)]
    assert len(texts) == 1, texts


def test_a_written_step_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = manager.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = files()
    rows = materialize(spark.range(1000).repartition(3, "id"), "rows")
    for _ in range(50):  # they are removed in the background
        if not (left := files() - before):
            break
        time.sleep(0.2)
    assert not left and rows.count() == 1000
