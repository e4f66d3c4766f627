"""The training-data pipeline: each stage reads what the one before it kept.

Defined cases: null, empty and very long texts pass through every stage whole (a null text
is scored as an empty one and packed as its end alone); of repeated rows and ties one stays,
as ``deduplicate`` states; columns beyond those of ``documents`` are kept by all stages but
the last; an empty table gives no rows. Without labels no document is rejected for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bagminhash, decontamination, packing, quality, toxicity
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import tokenizer_path


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_civil(spark, docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return bagminhash.deduplicate(spark, docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of training sequences."""
    return packing.pack(spark, docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality", good),
    ("toxicity", civil),
    ("near_duplicates", distinct),
    ("decontamination", unseen),
    ("packing", pack),
]

#: Models, signatures and alignments are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs
