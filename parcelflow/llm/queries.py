"""The registered queries: each applies its operator, with production
parameters, to a whole table and derives the digest columns."""

from __future__ import annotations

import importlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import (conversations, decontaminate, embedding_dedup, lm_score, minhash_dedup, packing, pii,
                            quality, spelling, suffix_dedup, token_codec, token_counts, toxicity)
from parcelflow.llm.common import read_table
from parcelflow.llm.oracle import ORACLE_SQL

corpus_pipeline = importlib.import_module("corpus_pipeline")  # at the top of the repository


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"), 200))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, quality.graded(read_table(spark, sf_dir, "labels")))
    scored = quality.score(docs, model)
    tail = quality.tail(scored, 1)
    return scored.select("doc_id", "expected_grade", tail.alias("tail_probability"), (tail >= 0.5).alias("kept"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(read_table(spark, sf_dir, "documents")))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find(docs, read_table(spark, sf_dir, "benchmark")))


def op6_token_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_codec.write(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
    return token_codec.report(token_codec.read(spark, path))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), 0.98)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, labels.where(~held_out).select("doc_id", F.col("toxic").alias("label")))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out)
    return lm_score.score(docs, lm_score.fit(docs, "not held_out"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"),
                                         minhash_dedup.Plan(words=5, percent=85))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.repair(conversations.damage(read_table(spark, sf_dir, "conversations"))))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_packing, op3_quality, op4_pii, op5_decontamination,
                            op6_token_codec, op7_embedding_dedup, op8_toxicity, op9_lm_score, op10_minhash_dedup,
                            op11_conversation_repair, op12_spelling, op13_token_counts)}
QUERIES["pipeline"] = corpus_pipeline.run

ORACLE = dict(ORACLE_SQL) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
