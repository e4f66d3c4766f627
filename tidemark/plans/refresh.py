"""Refreshing the customer dimension: copy, check, publish."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from tidemark import contract as C
from tidemark.contract import QualityRules
from tidemark.functions.safe import instant
from tidemark.operators import quality
from tidemark.sources.snapshots import SnapshotStore


class RefreshStopped(RuntimeError):
    """The source could not be copied or did not pass; readers keep what they have."""


def extract(source: DataFrame, store: SnapshotStore) -> str:
    """Copy the source as it is, columns and values untouched, away from readers."""
    try:
        return store.write_candidate(source)
    except PySparkException as error:
        raise RefreshStopped(f"the source could not be copied: {error}") from error


def validate(
    candidate: str, baseline: DataFrame | None, store: SnapshotStore, rules: QualityRules,
    clock: datetime,
) -> DataFrame:
    """Report of the gate on the copied source; what does not pass is set aside."""
    frame = store.spark.read.parquet(candidate)
    report = quality.quality_report(frame, rules, clock=clock, source=baseline)
    # At most one row per check, so the report fits anywhere.
    rows = report.collect()
    report = store.spark.createDataFrame(rows, report.schema)
    broken = sorted(r.check_name for r in rows if not r.passed and r.severity == quality.ERROR)
    if broken:
        store.quarantine(candidate, report)
        raise RefreshStopped("not published, for it breaks " + ", ".join(broken))
    return report


def publish(
    candidate: str, store: SnapshotStore, clock: datetime, schema=C.CUSTOMER, keep_history: bool = False,
) -> dict:
    """Give the checked copy its types and make it what readers see.

    A value that its type cannot hold stops the run: it would be lost as a NULL. With
    ``keep_history`` the history advances by it: changed and vanished customers are
    closed at ``clock``.
    """
    copied = store.spark.read.parquet(candidate)
    lost = {c: n for c, n in quality.lost_values(copied, schema).first().asDict().items() if n}
    if lost:
        raise RefreshStopped("not published, for values do not fit their type: " + ", ".join(
            f"{n} of {c}" for c, n in sorted(lost.items())))
    typed = store.write_candidate(quality.conform(copied, schema))
    if not keep_history:
        return store.publish(typed)
    return store.publish(typed, store.advance_history(typed, instant(clock)))


def refresh_dimension(
    source: DataFrame, baseline: DataFrame | None, store: SnapshotStore,
    rules: QualityRules, clock: datetime, keep_history: bool = False,
    cfg: C.PipelineConfig = C.PipelineConfig(),
) -> DataFrame:
    """All stages in order; returns the report of the published snapshot."""
    candidate = extract(source, store)
    report = validate(candidate, baseline, store, rules, clock)
    publish(candidate, store, clock, C.with_id_type(C.CUSTOMER, cfg), keep_history)
    return report
