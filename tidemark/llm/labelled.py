"""Labelled training rows of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_crc

#: At most about so many labelled rows fit a classifier; every document is scored.
SAMPLE_ROWS = 30_000
FOLDS = 5


def is_held_out(doc_id: Column) -> Column:
    return id_crc(doc_id) % FOLDS == 0


def training_labels(labels: DataFrame, label: str, most: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, label): one row for each labelled id outside the held-out fold.

    Ids labelled twice take the label of the majority, 1 at a tie. A share of the ids,
    chosen by their hash, is taken when there are more than ``most``.
    """
    voted = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .filter(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg(label).alias("share"))
        .select("doc_id", (F.col("share") >= 0.5).cast("int").alias("label"))
    )
    share = min(1.0, most / max(1, voted.count()))
    return voted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the sampled ids; the sample is bounded and broadcast."""
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
