"""Versioned snapshots of a dimension, listed by numbered manifests."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import enrichment_columns
from tidemark.operators.history import advance_current
from tidemark.sources import files
from tidemark.sources.manifests import Manifests, split_by_age
from tidemark.sources.measure import memory_bytes


@dataclass
class SnapshotStore:
    """Candidates, published versions and quarantined snapshots of a dimension.

    Every version is an immutable folder; publishing creates the next manifest, so a
    reader gets the whole old or the whole new version. Replaced ones stay for
    ``retain_s``.
    """

    spark: SparkSession
    root: str
    retain_s: int = 7 * 24 * 3600

    @property
    def published(self) -> Manifests:
        return Manifests(self.spark, f"{self.root}/published")

    def write_candidate(self, frame: DataFrame) -> str:
        path = f"{self.root}/candidates/{uuid.uuid4().hex}"
        frame.write.parquet(path)
        return path

    def current(self) -> dict | None:
        return self.published.latest()

    def publish(self, candidate: str, history: dict | None = None) -> dict:
        """Make a validated candidate the current version, without copying it.

        ``history`` names the folders of the history that goes with it, if one is kept: see
        ``advance_history``. Folders that it names no more are retired.
        """
        size = memory_bytes(self.spark.read.parquet(candidate))
        while True:
            before = self.current() or {"number": 0, "path": None, "retired": []}
            if before["path"] == candidate:
                return before
            at = datetime.now(timezone.utc).isoformat()
            gone = [p for p in (before["path"], *_folders(before.get("history")))
                    if p and p not in _folders(history)]
            old, kept = split_by_age(before["retired"], self.retain_s)
            added = self.published.add({
                "number": before["number"] + 1, "path": candidate, "bytes": size, "history": history,
                "retired": [*kept, *({"path": p, "at": at} for p in gone)]})
            if added is not None:
                for one in old:
                    files.remove(self.spark, one["path"])
                self.published.expire(self.retain_s)
                return added

    def quarantine(self, candidate: str, report: DataFrame) -> str:
        """Keep a rejected candidate, with its report beside it, for triage."""
        run = candidate.rstrip("/").rsplit("/", 1)[-1]
        target = f"{self.root}/rejected/run_id={run}"
        report.write.parquet(f"{target}/report")
        files.create_json(self.spark, f"{target}/rejected.json", {"candidate": candidate})
        return target

    def _entry(self) -> dict:
        entry = self.current()
        if entry is None:
            raise FileNotFoundError(f"nothing has been published below {self.root}")
        return entry

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self._entry()["path"])

    def history(self) -> DataFrame | None:
        """The history that goes with the current version, None if none is kept."""
        folders = _folders((self.current() or {}).get("history"))
        return self.spark.read.parquet(*folders) if folders else None

    def advance_history(self, snapshot: str, at: Column) -> dict:
        """Folders of the history after one more snapshot.

        Closed ranges are only ever added to: what the snapshot closes gets a folder of
        its own. The current ranges are written anew. Nothing else is read or written,
        however long the history is.
        """
        held = (self.current() or {}).get("history")
        current = self.spark.read.parquet(held["current"]) if held else None
        path = f"{self.root}/candidates/{uuid.uuid4().hex}"
        moved = advance_current(current, self.spark.read.parquet(snapshot), at)
        moved.withColumn("part", F.when(F.col("is_current"), "current").otherwise("closed")).write.partitionBy(
            "part").parquet(path)
        parts = files.names(self.spark, path)
        closed = [f"{path}/part=closed"] if "part=closed" in parts else []
        if "part=current" not in parts:  # an empty snapshot leaves nothing current
            moved.limit(0).write.parquet(f"{path}/part=current")
        return {"closed": [*(held["closed"] if held else []), *closed], "current": f"{path}/part=current"}


def _folders(history: dict | None) -> list[str]:
    return [*history["closed"], history["current"]] if history else []


@dataclass
class PublishedDimension:
    """Looks up the enrichment columns of whatever version is current.

    Versions never change, so a frame is kept for as long as its number is the newest.
    """

    store: SnapshotStore
    known: dict[int, tuple[DataFrame, int]] = field(default_factory=dict)

    def __call__(self) -> tuple[DataFrame, int]:
        """The columns and the bound of the memory they take."""
        entry = self.store._entry()
        if entry["number"] not in self.known:
            frame = enrichment_columns(self.store.spark.read.parquet(entry["path"]))
            self.known = {entry["number"]: (frame, entry["bytes"])}
        return self.known[entry["number"]]
