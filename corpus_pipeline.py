"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All but the last
return the columns of documents, whatever else they are named.

Null text counts as empty in every stage: it scores as a text without
features, links with nothing, holds no benchmark words and no personal data,
and packs to its end id.  Rows with a null doc_id stay in stages 1 to 4 as rows
of their own.  Repeated rows (one doc_id) are one node in near-dedup and all
stay; elsewhere each counts for itself.  Ties are set in the operators.  An
empty table passes through all stages and gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelflow.llm import decontaminate, minhash_dedup, packing, pii, quality
from parcelflow.llm.common import materialize, read_table

#: Near duplicates of the pipeline: five words, similarity of 0.8 or more.
NEAR = minhash_dedup.Plan(words=5, percent=80)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade above 0 is a half or more (at a
    half: kept; with nothing to fit on: all)."""
    return quality.select(docs, quality.graded(read_table(spark, sf_dir, "labels")), at_least=1, min_tail=0.5)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least doc_id, of each group; a document
    without words or doc_id is its own group."""
    return minhash_dedup.deduplicate(docs, NEAR)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark spans; those with more than half of their
    words hit are removed (at a half: kept).  Null items have no windows."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data and what reveals it replaced; texts without
    any come back as they were, null included."""
    return pii.sanitise(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens; null and empty
    texts have one piece, their end id."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontaminate_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]

#: The fitted classifier and the token ids are beyond SQL; the stages are
#: tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
