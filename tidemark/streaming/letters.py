"""Triage of the dead-letter topic as a stream.

Letters are sent at least once, so one may come again. Within the watermark a letter
counts once, known by the position of the message it is about; the state holds the
positions of that time only. Counts are added up batch by batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.operators import deadletter
from tidemark.operators.events import POSITION

COUNTS = "reject_reason string, window_start timestamp, n bigint, batch_id bigint"


def unique_letters(messages: DataFrame, repeats_within: str = "1 hour") -> DataFrame:
    """Letters of the topic, each once; ``repeats_within`` is how much later one may come
    again, by the time at which it was sent."""
    text = F.col("value").cast("string")
    position = F.from_json(text, "`partition` int, offset bigint")
    letters = messages.select(
        "key", "value", F.get_json_object(text, "$.reject_reason").alias("reject_reason"),
        F.try_to_timestamp(F.get_json_object(text, "$.arrived_at")).alias("arrived_at"),
        *[position[c].alias(c) for c in POSITION], F.col("timestamp").alias("sent_at"))
    return letters.withWatermark("sent_at", repeats_within).dropDuplicatesWithinWatermark(list(POSITION))


def write_triage(letters: DataFrame, path: str, checkpoint: str, width: str = "1 hour") -> DataStreamWriter:
    """Counts of every batch; a batch that is repeated replaces what it wrote."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        deadletter.triage(batch, width).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return letters.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def read_triage(spark: SparkSession, path: str) -> DataFrame:
    """Dead letters by reason over time, up to the last batch."""
    counts = spark.read.schema(COUNTS).parquet(path)
    return counts.groupBy("reject_reason", "window_start").agg(F.sum("n").alias("n"))
