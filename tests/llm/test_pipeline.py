"""The pipeline's stages in turn, each on what the one before kept."""

import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from parcelflow.llm import decontaminate, minhash_dedup, pii

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names if n[2].isdigit()] == list(range(1, 14))
    assert "pipeline" in entry.queries() and "corpus_pipeline" in sys.modules


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "MinHash near-dedup", "benchmark decontamination", "PII", "packing"]
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        if name == "packing":
            assert docs.agg(F.sum("length")).first()[0] == docs.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
            assert {r.doc_id for r in docs.select("doc_id").distinct().collect()} == kept
            break
        assert docs.columns == columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= kept
        kept = now
        if name == "quality classifier":
            bad = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 0")
            good = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").count()
            assert docs.join(bad, "doc_id").count() == 0
            assert docs.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").count() == good
        elif name == "MinHash near-dedup":
            assert minhash_dedup.near_duplicates(docs, corpus_pipeline.NEAR).where("not kept").count() == 0
            groups = minhash_dedup.near_duplicates(before, corpus_pipeline.NEAR)
            assert groups.where("kept").count() == docs.count()
        elif name == "benchmark decontamination":
            bench = spark.read.parquet(f"{SF}/benchmark.parquet")
            assert decontaminate.report(decontaminate.find(docs, bench)).where("contaminated").count() == 0
            assert docs.count() >= 0.95 * before.count()
        else:
            assert docs.count() == before.count()
            assert pii.base_spans(docs).where("size(base) > 0").count() == 0


@pytest.mark.parametrize("empty", [True])
def test_stages_on_no_documents(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
