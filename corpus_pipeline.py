"""Training-corpus pipeline over ``documents``: drop low-quality documents,
drop documents in no recognised language, keep one document of each group of
near copies, drop contaminated documents, encode what is left.

Each stage works on all documents its predecessor kept and returns them with
their columns unchanged; the last one returns doc_id, counts, digests and ids.
Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm import byte_bpe, decontamination, jaccard_join, language_id, quality_trees, queries
from postlens.llm.common import stored, table

NEAR_COPIES = jaccard_join.Rule(shingle=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least 0.3."""
    return quality_trees.keep(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language learned from ``lang``."""
    return language_id.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links of 80 % Jaccard similarity
    over five-word shingles."""
    return jaccard_join.keep_one(docs, NEAR_COPIES)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth are in benchmark windows."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document that is left."""
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(queries.RANKS_PATH), public_tokenizers.PATTERN)
    return byte_bpe.encode_documents(docs, bpe, with_ids=True)


STAGES = [("quality", quality), ("language", language), ("near_copies", near_copies), ("decontaminate", decontaminate), ("encode", encode)]

#: The classifiers and the encoder can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
