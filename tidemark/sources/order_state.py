"""The served order table: one bucketed base plus the batches since then."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract as C
from tidemark.functions.safe import instant
from tidemark.operators.enrich import served
from tidemark.operators.versions import replace_rows
from tidemark.sources import files
from tidemark.sources.manifests import Manifests, split_by_age
from tidemark.sources.measure import memory_bytes


@dataclass
class OrderState:
    """One row per order; any number of writers, of which one wins each version.

    A commit writes the changed rows of a batch to a folder of its own and then creates
    the next numbered manifest, which lists the live folders. If another writer was
    faster, nothing of the commit is visible and the batch has to be guarded again.

    Layout rule: ``compact_after`` batches are folded into the base, a table bucketed by
    order, in one pass over it. Replaced folders live on for ``retain_s``.
    """

    spark: SparkSession
    root: str
    cfg: C.PipelineConfig = C.PipelineConfig()

    @property
    def manifests(self) -> Manifests:
        return Manifests(self.spark, self.root)

    @property
    def schema(self) -> T.StructType:
        """Columns of the table as it was created, or as it will be."""
        kind = (self.manifests.latest() or {}).get("customer_id_type", self.cfg.customer_id_type)
        return C.with_id_type(C.ORDER_STATE, replace(self.cfg, customer_id_type=kind))

    def create(self) -> dict:
        """The current manifest, after making the table if it does not exist."""
        while (found := self.manifests.latest()) is None:
            self.manifests.add({
                "number": 0, "base": None, "deltas": [], "retired": [], "runs": {},
                "customer_id_type": self.cfg.customer_id_type})
        if found["customer_id_type"] != self.cfg.customer_id_type:
            raise ValueError(f"customer ids of this table are {found['customer_id_type']}")
        return found

    def manifest(self) -> dict:
        found = self.manifests.latest()
        if found is None:
            raise FileNotFoundError(f"no order table at {self.root}")
        return found

    # ---- reading --------------------------------------------------------
    def base(self, entry: dict) -> DataFrame:
        name = _table_name(entry["path"])
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_ddl(self.schema)}) USING parquet "
            f"CLUSTERED BY (order_id) SORTED BY (order_id) INTO {entry['buckets']} BUCKETS "
            f"LOCATION '{entry['path']}'"
        )
        return self.spark.table(name)

    def recent(self, manifest: dict) -> DataFrame:
        """Newest row of every order changed since the base was written."""
        delta = T.StructType([*self.schema.fields, T.StructField("commit", T.LongType())])
        rows = self.spark.read.schema(delta).parquet(*manifest["deltas"])
        newest = Window.partitionBy("order_id").orderBy(F.col("commit").desc())
        return (
            rows.withColumn("_rank", F.row_number().over(newest))
            .filter(F.col("_rank") == 1).drop("_rank", "commit")
        )

    def parts(self, manifest: dict) -> list[DataFrame]:
        """The base and the recent rows; each holds an order once."""
        found = [self.base(manifest["base"])] if manifest["base"] else []
        return found + ([self.recent(manifest)] if manifest["deltas"] else [])

    def rows(self) -> DataFrame:
        """The whole table, tombstones included."""
        parts = self.parts(self.manifest())
        return replace_rows(parts) if parts else self.spark.createDataFrame([], self.schema)

    def served(self) -> DataFrame:
        return served(self.rows())

    def attach(self, latest: DataFrame, manifest: dict) -> DataFrame:
        """Winners beside their stored version.

        Only the rows of the batch's orders leave the base. The scan of a batch of up to
        ``prune_keys`` orders opens the files of their buckets alone, so what is read
        follows the batch and not the table. A larger one meets the base in a semi-join
        that neither sorts nor shuffles it: keys within the limit are broadcast, others
        are hashed bucket by bucket.
        """
        found = []
        if manifest["base"]:
            found.append(self._stored(
                self.base(manifest["base"]).select("order_id", "lsn", "op"), latest.select("order_id")))
        if manifest["deltas"]:
            found.append(self.recent(manifest).select("order_id", "lsn", "op"))
        attached, names = latest, []
        for number, part in enumerate(found):
            names.insert(0, f"_version_{number}")
            attached = attached.join(
                part.select("order_id", F.struct("lsn", "op").alias(names[0])), "order_id", "left")
        if not names:
            return attached.withColumns({
                "stored_lsn": F.lit(None).cast("bigint"), "stored_op": F.lit(None).cast("string")})
        stored = F.coalesce(*names)
        if not self.cfg.tombstones:
            # Hard deletes forget the version along with the row.
            stored = F.when(stored["op"] != C.DELETE, stored)
        return attached.withColumns(
            {"stored_lsn": stored["lsn"], "stored_op": stored["op"]}).drop(*names)

    def _stored(self, base: DataFrame, keys: DataFrame) -> DataFrame:
        most = self.cfg.prune_keys
        named = [r.order_id for r in keys.limit(most + 1).collect()] if most else []
        if named and len(named) <= most:
            return base.filter(F.col("order_id").isin(named))
        small = memory_bytes(keys) <= self.cfg.broadcast_limit_bytes
        return base.join(F.broadcast(keys) if small else keys.hint("shuffle_hash"), "order_id", "left_semi")

    # ---- writing --------------------------------------------------------
    def commit(self, changes: DataFrame, manifest: dict, run_id: str, batch_id: int) -> dict | None:
        """Add the rows that a batch changes in the version ``manifest``.

        Gives the new version, or None if that is not the current one any more; the
        batch must then be guarded by what has become of the table.
        """
        number = manifest["number"] + 1
        path = f"{self.root}/delta/{number:012d}-{uuid.uuid4().hex}"
        changes.select(
            *self.schema.fieldNames(), F.lit(number).cast("bigint").alias("commit")).write.parquet(path)
        added = self.manifests.add({
            **manifest, "number": number, "deltas": [*manifest["deltas"], path],
            "runs": {**manifest["runs"], run_id: batch_id}})
        if added is None:
            files.remove(self.spark, path)
        return added

    def compact(self, now: datetime | None = None, buckets: int | None = None) -> bool:
        """Fold the batches into the base, or deal the base out over other ``buckets``.

        Tombstones whose retention has passed at ``now`` are dropped. False if another
        writer was faster; the table is then as it was.
        """
        manifest = self.create()
        held = manifest["base"]["buckets"] if manifest["base"] else self.cfg.state_buckets
        buckets = buckets or held
        if not manifest["deltas"] and (not manifest["base"] or buckets == held):
            return True
        if not buckets:
            raise ValueError("state_buckets must be set before the table is compacted: enough for about 1 GB a bucket")
        parts = self.parts(manifest)
        merged = self._without_expired(replace_rows(parts), now).repartition(buckets, "order_id")
        path = f"{self.root}/base/{manifest['number'] + 1:012d}-{uuid.uuid4().hex}"
        (
            merged.write.format("parquet").option("path", path)
            .bucketBy(buckets, "order_id").sortBy("order_id").saveAsTable(_table_name(path))
        )
        at = datetime.now(timezone.utc).isoformat()
        gone = [*([manifest["base"]["path"]] if manifest["base"] else []), *manifest["deltas"]]
        old, kept = split_by_age(manifest["retired"], self.cfg.retain_s)
        added = self.manifests.add({
            **manifest, "number": manifest["number"] + 1, "base": {"path": path, "buckets": buckets},
            "deltas": [], "retired": [*kept, *({"path": p, "at": at} for p in gone)]})
        if added is None:
            self._remove(path)
            return False
        for one in old:
            self._remove(one["path"])
        self.manifests.expire(self.cfg.retain_s)
        return True

    def _remove(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
        files.remove(self.spark, path)

    def _without_expired(self, rows: DataFrame, now: datetime | None) -> DataFrame:
        deleted = F.col("op") == C.DELETE
        if not self.cfg.tombstones:
            return rows.filter(~deleted)
        if now is None or self.cfg.tombstone_ttl_s is None:
            return rows
        oldest = instant(now - timedelta(seconds=self.cfg.tombstone_ttl_s))
        return rows.filter(~deleted | (F.col("ingested_at") >= oldest))


def _table_name(path: str) -> str:
    return "tidemark_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
