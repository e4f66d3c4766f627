"""Newest version per order, held in the streaming state store."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import contract as C
from tidemark.operators import deadletter, enrich, events, versions
from tidemark.session import ROCKSDB
from tidemark.sources import files

FIELDS = ("op", "customer_id", "amount", "product_category", "event_time", "lsn", "ingested_at",
          "arrived_at", *events.POSITION)

#: Beside the rows of a merged folder: when it was made and of which ones.
MERGED = "_merged.json"

Dimension = Callable[[], tuple[DataFrame, int | None]]


def version_stream(messages: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """The newest version of every order that a micro-batch touches.

    The state store is split by order and each task reads only its own keys, so the cost
    of a batch follows the batch and not the served table. An older version meets the
    stored one and loses, an equal one that arrived later too; a deleted order keeps its
    version. Events of one order are combined before the shuffle.
    """
    fresh = events.fresh(events.judge(events.parse(messages), cfg), cfg=cfg)
    first = [-F.unix_micros("arrived_at"), *[-F.col(c) for c in events.POSITION]]
    newest = F.max_by(F.struct(*FIELDS), F.struct("lsn", *first)).alias("newest")
    return fresh.groupBy("order_id").agg(newest).select("order_id", "newest.*")


def write_changes(
    changes: DataFrame, path: str, checkpoint: str, dimension: Dimension | None = None,
    cfg: C.PipelineConfig = C.PipelineConfig(),
) -> DataStreamWriter:
    """Store the touched orders of every batch, enriched if there is a dimension.

    Every attempt of a batch writes a folder of its own, so nothing that was written is
    replaced; a change that is found twice counts once. A join without a broadcast reads
    its orders several times, so the batch is written first: its state is run through once.
    """
    spark = changes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def handle(batch: DataFrame, batch_id: int) -> None:
        target = f"{batch_id}-{uuid.uuid4().hex}"
        if dimension is None:
            batch.write.parquet(f"{path}/{target}")
            return
        frame, size = dimension()
        staged = None
        if size is None or size > cfg.broadcast_limit_bytes:
            staged = f"{path}-staged/{target}"
            batch.write.parquet(staged)
            batch = spark.read.schema(batch.schema).parquet(staged)
        enrich.join_dimension(batch, frame, size, cfg.broadcast_limit_bytes).write.parquet(f"{path}/{target}")
        if staged is not None:
            files.remove(spark, staged)

    return (
        changes.writeStream.foreachBatch(handle).outputMode("update")
        .option("checkpointLocation", checkpoint)
    )


def write_rejects(
    messages: DataFrame, path: str, checkpoint: str, cfg: C.PipelineConfig = C.PipelineConfig(),
) -> DataStreamWriter:
    """Dead letters and counters of every batch, beside the stream of versions."""
    spark = messages.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        run = files.read_json(spark, f"{checkpoint}/metadata")["id"]
        place = f"run_id={run}/batch_id={batch_id}"
        judged = events.judge(events.parse(batch), cfg).persist()
        try:
            deadletter.envelope(events.rejected(judged)).write.mode("overwrite").parquet(
                f"{path}/dead_letters/{place}")
            judged.groupBy("stage").agg(F.count(F.lit(1)).alias("n")).coalesce(1).write.mode(
                "overwrite").parquet(f"{path}/counters/{place}")
        finally:
            judged.unpersist()

    return messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)


def newest_changes(spark: SparkSession, *paths: str) -> DataFrame:
    """One row for each order: the newest of all stored changes, whichever batch wrote it."""
    changes = spark.read.parquet(*paths)
    window = Window.partitionBy("order_id").orderBy(*versions.newest_first())
    return (
        changes.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1).drop("_rank")
    )


def live_orders(spark: SparkSession, path: str) -> DataFrame:
    """Orders that are not deleted, of all batches that were written to their end."""
    return newest_changes(spark, *files.complete(spark, path)).filter(F.col("op") != C.DELETE)


def merge_changes(spark: SparkSession, path: str, retain_s: int = C.PipelineConfig.retain_s) -> None:
    """Join the folders of all batches in one with the newest change of each order.

    What was merged stays for ``retain_s``, for those who still read it: a change that is
    found twice counts once, so the rows are whole at any time. A later merge removes it.
    A batch that is repeated afterwards adds its changes again, which changes nothing.
    """
    now = datetime.now(timezone.utc)
    found = files.complete(spark, path)
    lists = {f: files.read_json(spark, f"{f}/{MERGED}") for f in found}
    merged = {f for held in lists.values() if held for f in held["folders"]}
    before = [f for f in found if f not in merged]
    if len(before) > 1:
        target = f"{path}/merged-{uuid.uuid4().hex}"
        newest_changes(spark, *before).write.parquet(target)
        files.create_json(spark, f"{target}/{MERGED}", {"at": now.isoformat(), "folders": before})
    for held in filter(None, lists.values()):
        if datetime.fromisoformat(held["at"]) <= now - timedelta(seconds=retain_s):
            for folder in held["folders"]:
                files.remove(spark, folder)
