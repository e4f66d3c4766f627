"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    alignment, bagminhash, decontamination, divergence, hmm, html_text, licenses, packing, quality, rule_votes, sharding,
    toxicity, vectors)
from tidemark.llm.common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op2_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(spark, table(spark, sf_dir, "documents"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(spark, table(spark, sf_dir, "documents")).drop("row_no")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, table(spark, sf_dir, "pages"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find(spark, table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.overlaps(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_votes.judge(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", *rule_votes.BASE, "base_failed", "kept")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(spark, table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(spark, table(spark, sf_dir, "documents"),
                           tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (
    op1_packing, op2_hidden_markov, op3_embeddings, op4_minhash, op5_toxicity, op6_html_extraction, op7_licenses, op8_quality, op9_sharding,
    op10_decontamination, op11_rule_votes, op12_divergence, op13_alignment)}

#: Of the others, the draws use xxhash64 and the checks crc32, which the SQL engine of the tests
#: lacks, or they are models, alignments or searches. All are tested by brute force.
ORACLES: dict[str, str] = {"op11_rule_votes": rule_votes.oracle(), "op12_divergence": divergence.ORACLE}
