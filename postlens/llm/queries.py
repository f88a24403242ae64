"""Registered queries of the training-data operators (production parameters,
whole tables) and, where SQL expresses them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from postlens.llm import attention_lm, byte_bpe, chat_format, decontamination, divergence, jaccard_join, language_id, license_scan, merkle, minhash, oracles, quality_trees, substring_dedup, toxicity
from postlens.llm.common import table
from postlens.llm.licence_texts import PHRASES, SPDX, TEMPLATES

QueryFn = Callable[[SparkSession, str], DataFrame]

#: A conversation whose texts hold what templates use as marks.
EXTRA_CONVERSATION = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]
CHAT_TOKENIZER_PATH = public_tokenizers.path("byte_bpe_50k.json")
SUBWORD_PATH = public_tokenizers.path("piece_bpe_32k.model")
RANKS_PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(RANKS_PATH), public_tokenizers.PATTERN)
    return byte_bpe.encode_documents(table(spark, sf_dir, "documents", "doc_id", "text"), bpe)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return license_scan.digest(license_scan.scan_documents(docs, license_scan.Scanner(PHRASES, TEMPLATES, identifiers=SPDX)))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(SUBWORD_PATH, "rb") as f:
        subwords = attention_lm.Subwords(f.read())
    return attention_lm.score_documents(table(spark, sf_dir, "documents", "doc_id", "text"), subwords)


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.scan(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compare(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return language_id.identify(docs, language_id.learn(docs))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    with open(CHAT_TOKENIZER_PATH) as f:
        formatter = chat_format.Formatter(f.read())
    return chat_format.conversations_digest(given.withColumn("turn", given["turn"].cast("long")).unionByName(extra), formatter).drop("n_tokens", "loss_tokens")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text")))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text"))


def queries() -> dict[str, QueryFn]:
    return {
        "op1_byte_bpe": op1_byte_bpe,
        "op2_license_scan": op2_license_scan,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_attention_lm": op4_attention_lm,
        "op5_quality_trees": op5_quality_trees,
        "op6_decontamination": op6_decontamination,
        "op7_minhash": op7_minhash,
        "op8_toxicity": op8_toxicity,
        "op9_language_id": op9_language_id,
        "op10_chat_format": op10_chat_format,
        "op11_substring_dedup": op11_substring_dedup,
        "op12_source_divergence": op12_source_divergence,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_jaccard_join": oracles.JACCARD_JOIN,
        "op6_decontamination": oracles.DECONTAMINATION,
        "op10_chat_format": oracles.CHAT_FORMAT,
        "op11_substring_dedup": oracles.SUBSTRING_DEDUP,
        "op12_source_divergence": oracles.DIVERGENCE,
        "op13_merkle_manifest": oracles.MERKLE,
    }
