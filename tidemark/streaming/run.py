"""The order stream and its progress reports."""

from __future__ import annotations

import json
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark import contract as C
from tidemark.plans.batch import OrderPipeline
from tidemark.sources import files

log = logging.getLogger("tidemark")

OFFSETS = (
    "reported_at string, batch_id bigint, topic string, partition int, end_offset bigint, "
    "committed_offset bigint"
)


def start(
    messages: DataFrame, pipeline: OrderPipeline, checkpoint: str, available_now: bool = False,
) -> StreamingQuery:
    """Apply every micro-batch to the pipeline.

    Failures stop the query, so the batch is repeated; batches that made it
    into the table are recognised by the id the checkpoint keeps. A new
    checkpoint is a new run and replays through the version guard.
    """
    spark = pipeline.spark

    def handle(batch: DataFrame, batch_id: int) -> None:
        pipeline.apply(batch, batch_id, files.read_json(spark, f"{checkpoint}/metadata")["id"])

    writer = (
        messages.writeStream.foreachBatch(handle).outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def progress_offsets(progress: dict) -> list[tuple]:
    """One row per topic partition of a progress report: newest offset and offset read.

    The stream keeps its own offsets, so lag is taken from what it reports and
    not from a consumer group, to which it never commits.
    """
    rows = []
    for source in progress.get("sources", []):
        read, newest = _offsets(source.get("endOffset")), _offsets(source.get("latestOffset"))
        for topic, partitions in newest.items():
            for partition, end in partitions.items():
                done = read.get(topic, {}).get(partition)
                rows.append((
                    progress.get("timestamp"), progress["batchId"], topic, int(partition), end, done))
    return rows


def _offsets(value) -> dict:
    value = json.loads(value) if isinstance(value, str) else value
    if not isinstance(value, dict):
        return {}
    return {t: p for t, p in value.items() if isinstance(p, dict)}


def newest_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Offsets of the last report of every topic partition."""
    last = F.max_by(F.struct("end_offset", "committed_offset"), F.struct("reported_at", "batch_id"))
    return (
        spark.read.schema(OFFSETS).parquet(path)
        .groupBy("topic", "partition").agg(last.alias("last"))
        .select("topic", "partition", "last.*")
    )


class LagReporter(StreamingQueryListener):
    """Appends the offsets of every n-th non-empty batch to a table.

    Warns when more messages wait than the stream could take in many batches.
    """

    def __init__(self, spark: SparkSession, path: str, cfg: C.PipelineConfig = C.PipelineConfig()):
        self.spark, self.path, self.every = spark, path, cfg.lag_report_every
        self.limit = cfg.max_offsets_per_trigger * cfg.lag_warn_factor
        self.seen = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def record(self, progress: dict) -> None:
        if not progress.get("numInputRows"):
            return
        self.seen += 1
        if self.seen % self.every:
            return
        rows = progress_offsets(progress)
        waiting = sum(end - (done or 0) for *_, end, done in rows)
        if waiting > self.limit:
            log.warning("%d messages behind, limit %d", waiting, self.limit)
        if rows:
            self.spark.createDataFrame(rows, OFFSETS).coalesce(1).write.mode("append").parquet(self.path)
