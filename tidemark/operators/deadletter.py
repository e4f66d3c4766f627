"""Dead-letter envelope and triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.events import EVENT_FIELDS


def envelope(rejected: DataFrame) -> DataFrame:
    """Message form of a reject: the order as key, all its columns as JSON."""
    fields = [c for c in rejected.columns if c not in ("key", "value")]
    return rejected.select(
        F.coalesce(F.col("order_id"), F.lit("")).alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
        "reject_reason", "arrived_at",
    )


def from_messages(messages: DataFrame) -> DataFrame:
    """Dead letters as they come back from their topic; reason and time are in the value."""
    text = F.col("value").cast("string")
    return messages.select(
        "key", "value", F.get_json_object(text, "$.reject_reason").alias("reject_reason"),
        F.try_to_timestamp(F.get_json_object(text, "$.arrived_at")).alias("arrived_at"),
    )


def read_back(letters: DataFrame) -> DataFrame:
    """Fields of dead letters, read from their JSON value."""
    schema = ", ".join(
        [f"{f} {'bigint' if f in ('lsn', 'offset') else 'string'}" for f in EVENT_FIELDS]
        + ["json_str string", "rule string", "`partition` int", "offset bigint"]
    )
    return letters.select(
        F.col("key").cast("string").alias("key"), "reject_reason", "arrived_at",
        F.from_json(F.col("value").cast("string"), schema).alias("letter"),
    ).select("key", "reject_reason", "arrived_at", "letter.*")


def triage(letters: DataFrame, width: str = "1 hour") -> DataFrame:
    """Dead letters by reason over time."""
    return (
        letters.groupBy("reject_reason", F.window("arrived_at", width).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("reject_reason", F.col("w.start").alias("window_start"), "n")
    )
