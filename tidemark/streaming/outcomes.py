"""The fate of every message, decided against versions in the state store.

One query reads the topic once and labels each message invalid, late, superseded, stale,
upsert or delete. Its file sink commits a batch as a whole and once, so readers of the
labelled messages see finished batches only, and a repeated batch replaces itself.
Counters, dead letters, changed orders and revenue are read from that one table.

This is the library's one path through Python: a label for every event needs state of
its own, which no built-in aggregate keeps. Messages come to it in ``GROUPS`` groups of
orders, since each key of the processor costs a batch of its own on the way back, and as
text, so that whole columns are passed at once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from tidemark import contract as C
from tidemark.operators import deadletter, enrich, events
from tidemark.operators.events import POSITION
from tidemark.session import ROCKSDB

#: What an order keeps: its version, and what a later one has to take back (times in microseconds).
KEPT = "lsn bigint, op string, amount double, event_time bigint, segment string, city string"
TAKEN_BACK = ("amount", "event_time", "segment", "city")
#: Groups of orders, each with a map of its orders as state; the number is part of the state.
GROUPS = 128
NOTHING = (None,) * len(TAKEN_BACK)


#: What is added to a message: its outcome, and what an applied change takes back.
ADDED = "outcome string, stored_op string, old_amount double, old_event_time string, old_segment string, old_city string"


class Versions(StatefulProcessor):
    """Labels the events of a group of orders.

    Of the events of an order in a batch the newest meets the stored version; the others
    leave as soon as a newer one is seen, so no more than one event of an order is held.
    A deleted order whose tombstone is to expire is kept apart from the live ones.
    """

    def __init__(self, fields: list[str], tombstones: bool, tombstone_ttl_s: int | None):
        self.fields = fields
        self.names = [*fields, *(f.split()[0] for f in ADDED.split(", "))]
        self.tombstones = tombstones
        self.ttl_ms = None if tombstone_ttl_s is None else tombstone_ttl_s * 1000

    def init(self, handle) -> None:
        self.live, self.gone = handle.getMapState("live", "order_id string", KEPT), None
        if self.tombstones and self.ttl_ms is not None:
            self.gone = handle.getMapState("gone", "order_id string", "lsn bigint", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows, timer_values) -> Iterator:
        import pandas as pd

        at = {name: k for k, name in enumerate((*self.fields, "sum"))}
        stage, order_id, arrival = at["stage"], at["order_id"], [at[c] for c in ("arrived_at", *POSITION)]
        best: dict[str, tuple] = {}
        for frame in rows:
            out = []
            for row in frame[[*self.fields, "sum"]].itertuples(index=False, name=None):
                if row[stage] != C.FRESH:
                    out.append(labelled(row, row[stage]))
                    continue
                # Of equal versions the first to arrive stays.
                rank = (-int(row[at["lsn"]]), *(_number(row[k]) for k in arrival))
                before = best.get(row[order_id])
                if before is None or rank < before[0]:
                    best[row[order_id]] = (rank, row)
                    row = None if before is None else before[1]
                if row is not None:
                    out.append(labelled(row, C.SUPERSEDED))
            if out:
                yield pd.DataFrame(out, columns=self.names, dtype=object)
        if best:
            out = [self.decide(row, at) for _, row in best.values()]
            yield pd.DataFrame(out, columns=self.names, dtype=object)

    def stored(self, order: tuple) -> tuple | None:
        found = self.live.getValue(order)
        if found is None and self.gone is not None:
            gone = self.gone.getValue(order)
            found = None if gone is None else (gone[0], C.DELETE, *NOTHING)
        return found

    def decide(self, row: tuple, at: dict[str, int]) -> tuple:
        order, lsn, op = (row[at["order_id"]],), int(row[at["lsn"]]), row[at["op"]]
        stored = self.stored(order)
        stored_lsn, stored_op, *old = stored or (None, None, *NOTHING)
        if stored is not None and lsn <= stored_lsn:
            return labelled(row, C.STALE, stored_op)
        living = stored is not None and stored_op != C.DELETE
        if op == C.DELETE:
            if self.tombstones and self.gone is None:
                self.live.updateValue(order, (lsn, op, *NOTHING))
            else:
                if living:
                    self.live.removeKey(order)
                if self.tombstones:
                    self.gone.updateValue(order, (lsn,))
            return labelled(row, C.REMOVE, stored_op, old)
        if self.gone is not None and stored is not None and not living:
            self.gone.removeKey(order)
        amount, moment = row[at["sum"]], row[at["event_time"]]
        self.live.updateValue(order, (
            lsn, op, None if amount is None else float(amount), None if moment is None else int(moment),
            row[at["segment"]], row[at["city"]]))
        return labelled(row, C.UPSERT, stored_op, old)

    def close(self) -> None:
        pass


def _number(text: str | None) -> int:
    """A number sent as text; one that is missing comes first."""
    return -1 << 63 if text is None else int(text)


def labelled(row: tuple, outcome: str, stored_op: str | None = None, old: tuple = NOTHING) -> tuple:
    """A row of the result, without the last field of the input."""
    amount, moment, *place = old
    return (*row[:-1], outcome, stored_op, amount, None if moment is None else str(moment), *place)


def _as_text(field: T.StructField) -> Column:
    """A value as text from which the same value can be read."""
    exact = F.unix_micros(field.name) if isinstance(field.dataType, T.TimestampType) else F.col(field.name)
    return exact.cast("string").alias(field.name)


def _from_text(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(text.cast("bigint")).alias(field.name)
    return text.cast(field.dataType).alias(field.name)


def label_stream(messages: DataFrame, dimension: DataFrame, dimension_bytes: int | None,
                 cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Every message of the stream with its outcome.

    Attributes are joined first, as the state keeps those an order was last counted
    under. The dimension is that of the query's start: ``jobs`` starts the query anew
    from its checkpoint when another one is published. Messages without a customer have
    keys of their own there, which match nothing and are evenly spread.
    """
    judged = events.raw_of_rejects(events.judge(events.parse(messages), cfg))
    small = dimension_bytes is not None and dimension_bytes <= cfg.broadcast_limit_bytes
    right = enrich.enrichment_columns(dimension).withColumn("customer_id", F.col("customer_id").cast("string"))
    right = right.withColumnRenamed("customer_id", "_id")
    fresh = F.col("stage") == C.FRESH
    known = F.when(fresh, F.expr(f"try_cast(customer_id AS {cfg.customer_id_type})")).cast("string")
    key = F.coalesce(known, F.concat_ws("-", F.lit("#"), *POSITION))
    joined = judged.withColumn("_key", key).join(
        F.broadcast(right) if small else right, F.col("_key") == F.col("_id"), "left").drop("_key", "_id")
    fields = list(joined.schema)
    group = F.when(fresh, F.xxhash64("order_id")).otherwise(F.xxhash64(*POSITION))
    routed = joined.select(
        F.pmod(group, F.lit(GROUPS)).cast("int").alias("route"), *[_as_text(f) for f in fields],
        F.when(fresh, F.expr("try_cast(amount AS DOUBLE)")).cast("string").alias("sum"))
    names = [f.name for f in fields]
    found = routed.groupBy("route").transformWithStateInPandas(
        Versions(names, cfg.tombstones, cfg.tombstone_ttl_s),
        ", ".join([*(f"`{n}` string" for n in names), ADDED]), outputMode="Append", timeMode="ProcessingTime" if expires(cfg) else "None")
    return found.select(
        *[_from_text(f) for f in fields],
        F.current_timestamp().alias("applied_at"),  # the same for a whole batch
        "outcome", "stored_op", "old_amount", _from_text(T.StructField("old_event_time", T.TimestampType())),
        "old_segment", "old_city")


def expires(cfg: C.PipelineConfig) -> bool:
    """Whether tombstones expire. Such a stream looks for expired ones without end."""
    return cfg.tombstones and cfg.tombstone_ttl_s is not None


def catch_up(writer: DataStreamWriter, endless: bool = False) -> None:
    """Run a stream until it has read what is there; an endless one ends with a batch that
    finds nothing new. Its first batch may repeat one of before, so that one tells nothing."""
    if not endless:
        writer.trigger(availableNow=True).start().awaitTermination()
        return
    query, first = writer.start(), None
    while not query.awaitTermination(0.2):
        for progress in query.recentProgress:
            first = progress["batchId"] if first is None else first
            if progress["batchId"] > first and not progress["numInputRows"]:
                query.stop()
                return


def write_labelled(labelled_messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Messages and outcomes as files, each batch whole and once."""
    labelled_messages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        labelled_messages.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )


def counters(labelled_messages: DataFrame) -> DataFrame:
    """One counters row for each batch, known by the time at which it was applied."""
    def count(condition) -> object:
        return F.count_if(condition)

    outcome, op = F.col("outcome"), F.col("op")
    applied = outcome.isin(C.UPSERT, C.REMOVE)
    names = {"superseded": C.SUPERSEDED, "stale": C.STALE, "upserts": C.UPSERT, "deletes": C.REMOVE}
    total = sum(F.col(c) for c in ("invalid", "late", *names))
    return (
        labelled_messages.groupBy("applied_at").agg(
            F.count(F.lit(1)).alias("processed"),
            *[count(outcome == c).alias(c) for c in (C.INVALID, C.LATE)],
            count(F.col("stage") == C.FRESH).alias("accepted"),
            *[count(outcome == label).alias(c) for c, label in names.items()],
            count((outcome == C.REMOVE) & (F.col("stored_op") != C.DELETE)).alias("deletes_effective"),
            count(applied & (op == "I")).alias("inserts"),
            count(applied & (op == "U")).alias("updates"),
            count(applied & ~op.isin(*C.OPS)).alias("unknown_ops"))
        .withColumn("reconciles", total == F.col("processed"))
    )


def letters(labelled_messages: DataFrame) -> DataFrame:
    """Dead letters of the rejected messages."""
    return deadletter.envelope(events.rejected(labelled_messages))


def changes(labelled_messages: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Upserts and deletes with served types and attributes."""
    applied = labelled_messages.filter(F.col("outcome").isin(C.UPSERT, C.REMOVE))
    typed = applied.withColumns({
        "customer_id": F.expr(f"try_cast(customer_id AS {cfg.customer_id_type})"),
        "amount": F.expr("try_cast(amount AS DOUBLE)"),
    }).withColumnRenamed("applied_at", "ingested_at")
    return enrich.state_rows(typed, cfg)


def served(labelled_messages: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Live orders: the newest change of each, which is the last that was not stale."""
    newest = Window.partitionBy("order_id").orderBy(F.col("lsn").desc())
    rows = changes(labelled_messages, cfg).withColumn("_rank", F.row_number().over(newest))
    return enrich.served(rows.filter(F.col("_rank") == 1).drop("_rank"))


def labelled_stream(spark: SparkSession, path: str) -> DataFrame:
    """The messages of committed batches as a stream of their own."""
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """The messages of all committed batches."""
    return spark.read.parquet(path)
