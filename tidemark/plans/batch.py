"""Applying one batch of order messages, as a plan and as a job."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.safe import instant
from tidemark.operators import counters, deadletter, enrich, events, versions
from tidemark.sources import files, topics
from tidemark.sources.order_state import OrderState

log = logging.getLogger("tidemark")

Dimension = Callable[[], tuple[DataFrame, int | None]]
Hold = Callable[[str, DataFrame], DataFrame]

# Folders of the shared parts of a batch, where those are written and not cached.
LETTERS = ("key string, value binary, reject_reason string, arrived_at timestamp, run_id string, "
           "batch_id bigint")
STAGED_BY = {"judged": "stage", "guarded": "outcome"}


@dataclass
class AppliedBatch:
    """The labelled parts of one batch; nothing has been run yet."""

    judged: DataFrame
    guarded: DataFrame

    def outcomes(self) -> DataFrame:
        return versions.outcomes(self.judged, self.guarded)

    def counters(self) -> DataFrame:
        return counters.batch_counters(self.judged, self.guarded)

    def effective(self) -> DataFrame:
        return versions.effective(self.guarded)

    def letters(self, rejected_at: datetime | None = None) -> DataFrame:
        return deadletter.envelope(events.rejected(self.judged, rejected_at))

    def changes(self, dimension: DataFrame, size: int | None, cfg: C.PipelineConfig) -> DataFrame:
        """Rows for the state table: enriched upserts and tombstones."""
        return enrich.state_rows(enrich.join_dimension(
            self.effective(), dimension, size, cfg.broadcast_limit_bytes), cfg)


def apply_batch(
    messages: DataFrame, attach: Callable[[DataFrame], DataFrame] | None = None,
    cfg: C.PipelineConfig = C.PipelineConfig(), clock: datetime | None = None,
    hold: Hold = lambda name, frame: frame,
) -> AppliedBatch:
    """Parse, judge, collapse and guard a batch.

    ``attach`` puts the stored versions beside the winners; without it the
    batch is applied to an empty table. ``hold`` may keep shared parts.
    """
    return guard_batch(judge_batch(messages, cfg, hold), attach, cfg, clock, hold)


def judge_batch(
    messages: DataFrame, cfg: C.PipelineConfig, hold: Hold = lambda name, frame: frame,
) -> DataFrame:
    return hold("judged", events.raw_of_rejects(events.judge(events.parse(messages), cfg)))


def guard_batch(
    judged: DataFrame, attach: Callable[[DataFrame], DataFrame] | None, cfg: C.PipelineConfig,
    clock: datetime | None = None, hold: Hold = lambda name, frame: frame,
) -> AppliedBatch:
    """Collapse judged events and guard the winners; repeated when another writer was faster."""
    latest = versions.latest_per_order(events.fresh(judged, clock, cfg))
    if attach is None:
        attached = latest.withColumns({
            "stored_lsn": F.lit(None).cast("bigint"), "stored_op": F.lit(None).cast("string")})
    else:
        attached = attach(latest)
    return AppliedBatch(judged, hold("guarded", versions.guard(attached)))


@dataclass
class OrderPipeline:
    """The job that stream, replay and backfill share.

    Order of effects: dead letters, metrics, changed rows, manifest. What a batch left
    behind before its manifest was created counts once when the batch is repeated.
    ``publish_letters`` may send the dead letters on, at least once.
    """

    spark: SparkSession
    root: str
    dimension: Dimension
    cfg: C.PipelineConfig = C.PipelineConfig()
    publish_letters: Callable[[DataFrame], None] | None = None

    @property
    def state(self) -> OrderState:
        return OrderState(self.spark, f"{self.root}/orders", self.cfg)

    def apply(self, messages: DataFrame, batch_id: int, run_id: str) -> bool:
        """Apply one batch once; False if it is part of the table already.

        The events are judged once. When another writer changes the table meanwhile, the
        winners are guarded again by what it has become.
        """
        state = self.state
        manifest = state.create()
        if batch_id <= manifest["runs"].get(run_id, -1):
            return False
        now = datetime.now(timezone.utc)
        cfg = self.cfg if self.cfg.late_on_arrival else replace(self.cfg, clock=now)
        staged = f"{self.root}/staged/{uuid.uuid4().hex}"
        held: list[DataFrame] = []

        def hold(name: str, frame: DataFrame) -> DataFrame:
            if cfg.cache_batch:
                held.append(frame.persist())
                return frame
            return self._stage(frame, f"{staged}/{len(held)}-{name}", STAGED_BY[name])

        try:
            judged = judge_batch(messages, cfg, hold)
            told = False
            while True:
                batch = guard_batch(
                    judged, lambda latest: state.attach(latest, manifest), cfg, now, hold)
                # One row; it also tells which of the writes would be empty.
                counted = batch.counters().first().asDict()
                if counted["processed"] == 0:
                    return True
                if not told and counted["invalid"] + counted["late"] > 0:
                    self._write_letters(batch.letters(now), run_id, batch_id)
                told = True
                self._write_counters(counted, run_id, batch_id, now)
                dimension, size = self.dimension()
                added = state.commit(
                    batch.changes(dimension, size, self.cfg), manifest, run_id, batch_id)
                if added is not None:
                    break
                log.warning("batch %d of %s meets another writer and is guarded again", batch_id, run_id)
                if not cfg.cache_batch:
                    held.append(batch.guarded)
                manifest = state.manifest()
                if batch_id <= manifest["runs"].get(run_id, -1):
                    return False
            log.log(logging.INFO if counted["reconciles"] else logging.ERROR,
                    "batch %d of %s: %s", batch_id, run_id, counted)
            if not self.cfg.compact_after and len(added["deltas"]) >= self.cfg.warn_after:
                log.warning("%d batches wait to be compacted; every guard reads them", len(added["deltas"]))
            if self.cfg.compact_after and len(added["deltas"]) >= self.cfg.compact_after:
                state.compact(now)
            return True
        finally:
            if cfg.cache_batch:
                for frame in held:
                    frame.unpersist()
            else:
                files.remove(self.spark, staged)

    def letters(self) -> DataFrame:
        """All dead letters, with the run and batch that rejected them."""
        return self.spark.read.schema(LETTERS).parquet(f"{self.root}/dead_letters")

    def metrics(self) -> DataFrame:
        """Counters per batch."""
        return self.spark.read.schema(C.COUNTERS).parquet(f"{self.root}/batch_metrics")

    def _report(self, rows: DataFrame, name: str) -> None:
        """Write a batch's part of a report: a partition of its own, so that a batch that is
        repeated replaces what it wrote before, and nothing else is touched."""
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "batch_id").parquet(f"{self.root}/{name}")
        )

    def _stage(self, frame: DataFrame, path: str, column: str) -> DataFrame:
        """Write a part once; its later uses read only their rows and columns."""
        frame.write.mode("overwrite").partitionBy(column).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _write_letters(self, letters: DataFrame, run_id: str, batch_id: int) -> None:
        self._report(letters.withColumns({
            "run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")}), "dead_letters")
        if self.publish_letters is not None:
            mine = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
            self.publish_letters(self.letters().filter(mine))

    def _write_counters(
        self, counted: dict, run_id: str, batch_id: int, now: datetime,
    ) -> None:
        row = {**counted, "run_id": run_id, "batch_id": batch_id}
        frame = self.spark.range(1, numPartitions=1).select(*[
            (instant(now) if f.name == "recorded_at" else F.lit(row[f.name]).cast(f.dataType))
            .alias(f.name) for f in C.COUNTERS
        ])
        self._report(frame, "batch_metrics")


def backfill(
    pipeline: OrderPipeline, messages: DataFrame, label: str, begin: datetime, end: datetime,
) -> bool:
    """Apply the messages that arrived in a range through the same steps as the stream.

    A label and range are applied once; False if they were before.
    """
    run = f"backfill-{label}-{begin:%Y%m%dT%H%M%S.%f}-{end:%Y%m%dT%H%M%S.%f}"
    return pipeline.apply(topics.arrived_between(messages, begin, end), 0, run)
