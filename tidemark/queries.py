"""Registered queries: each runs on the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark import fixtures as X
from tidemark.operators import (
    counters, deadletter, enrich, events, history, marts, quality, versions,
)
from tidemark.plans.batch import AppliedBatch, Hold, OrderPipeline, apply_batch, backfill
from tidemark.plans.refresh import refresh_dimension
from tidemark.session import shared_folder
from tidemark.sources import topics
from tidemark.sources.measure import memory_bytes
from tidemark.sources.snapshots import PublishedDimension, SnapshotStore
from tidemark.streaming import letters, outcomes, revenue
from tidemark.streaming.run import start
from tidemark.streaming.newest import live_orders, merge_changes, version_stream, write_changes

Query = Callable[[SparkSession, str], DataFrame]
CFG = C.PipelineConfig()
TRAILING_NOW = datetime(2024, 1, 16)
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# ---- shared parts ---------------------------------------------------------
def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.judge(events.parse(X.order_messages(spark, sf_dir)), CFG)


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.fresh(_judged(spark, sf_dir))


def _written(spark: SparkSession, purpose: str) -> Hold:
    """Write a part that is used more than once, so that the feed is parsed once."""
    root = shared_folder(spark, purpose)

    def hold(name: str, frame: DataFrame) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    return hold


def _whole_feed(spark: SparkSession, sf_dir: str, **settings) -> AppliedBatch:
    return apply_batch(X.order_messages(spark, sf_dir), cfg=CFG, **settings)


def _enriched(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    dimension = enrich.enrichment_columns(X.customers(spark, sf_dir))
    return enrich.join_dimension(
        orders, dimension, memory_bytes(dimension), CFG.broadcast_limit_bytes)


def _first_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State after batch A: its winners, with deletes as tombstones."""
    return apply_batch(X.first_part(X.order_messages(spark, sf_dir)), cfg=CFG).effective()


def _second_batch(spark: SparkSession, sf_dir: str, **settings) -> AppliedBatch:
    """Batch B guarded by the state that batch A left."""
    stored = versions.stored_versions(_first_winners(spark, sf_dir))
    return apply_batch(
        X.second_part(X.order_messages(spark, sf_dir)),
        lambda latest: versions.attach_stored(latest, stored), CFG, **settings)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Served table after the whole feed."""
    return enrich.served(enrich.state_rows(
        _enriched(spark, sf_dir, _whole_feed(spark, sf_dir).effective())))


def _letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletter.envelope(events.rejected(_judged(spark, sf_dir)))


def _naive(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _public(facts: DataFrame) -> DataFrame:
    """Served columns without the processing time."""
    return _naive(facts.drop("ingested_at"), "event_time")


def _keys(frame: DataFrame, *more) -> DataFrame:
    return frame.select("order_id", "lsn", "op", *more)


# ---- parsing, validity, lateness ------------------------------------------
@query
def parse_payload(spark, sf_dir):
    parsed = events.parse(X.order_messages(spark, sf_dir))
    return _naive(parsed.select(
        "offset", "op", "order_id", "customer_id",
        F.col("amount").try_cast("double").alias("amount"),
        "product_category", "event_time", "lsn",
    ), "event_time")


@query
def split_valid(spark, sf_dir):
    return _judged(spark, sf_dir).filter(F.col("stage") != C.INVALID).select("offset", "lsn")


@query
def split_invalid(spark, sf_dir):
    return (
        _judged(spark, sf_dir).filter(F.col("stage") == C.INVALID)
        .select("offset", "lsn", "rule")
    )


@query
def invalid_by_rule(spark, sf_dir):
    return events.invalid_by_rule(_judged(spark, sf_dir))


@query
def accepted_events(spark, sf_dir):
    return _naive(events.typed(_judged(spark, sf_dir)).select(
        "lsn", "op", "order_id", "customer_id", "amount", "product_category", "event_time",
    ), "event_time")


@query
def late_events(spark, sf_dir):
    return (
        events.typed(_judged(spark, sf_dir)).filter(F.col("stage") == C.LATE)
        .select("lsn", "order_id", "op", "age_s")
    )


@query
def fresh_events(spark, sf_dir):
    return (
        events.typed(_judged(spark, sf_dir)).filter(F.col("stage") == C.FRESH)
        .select("lsn", "order_id", "op", "age_s")
    )


# ---- versions --------------------------------------------------------------
@query
def latest_per_order(spark, sf_dir):
    return _keys(versions.latest_per_order(_fresh(spark, sf_dir)), "amount")


@query
def superseded_events(spark, sf_dir):
    labelled = versions.label(_judged(spark, sf_dir))
    return _keys(labelled.filter(F.col("outcome") == C.SUPERSEDED))


@query
def stored_lsn_lookup(spark, sf_dir):
    stored = versions.stored_versions(_first_winners(spark, sf_dir))
    batch = events.fresh(events.judge(events.parse(
        X.second_part(X.order_messages(spark, sf_dir))), CFG))
    return versions.lookup_versions(stored, versions.latest_per_order(batch))


@query
def drop_stale(spark, sf_dir):
    return _keys(_second_batch(spark, sf_dir).effective(), "amount", "outcome")


@query
def event_outcomes(spark, sf_dir):
    stored = _written(spark, "outcomes")("state", versions.stored_versions(_first_winners(spark, sf_dir)))
    second = events.judge(events.parse(X.second_part(X.order_messages(spark, sf_dir))), CFG)
    return versions.label(second, stored).select("offset", "outcome")


@query
def feed_outcomes(spark, sf_dir):
    return versions.label(_judged(spark, sf_dir)).select("offset", "outcome")


@query
def op_mix(spark, sf_dir):
    return counters.op_mix(_whole_feed(spark, sf_dir).effective())


@query
def batch_counters(spark, sf_dir):
    """Counters of batch A and of batch B after it."""
    judged = _written(spark, "counters")("judged", _judged(spark, sf_dir)).withColumn(
        "batch_id", _batch_of_partition())
    winners = counters.sequence_outcomes(events.fresh(judged).withColumn("batch_id", _batch_of_partition()))
    return counters.batch_counters(judged, winners, "batch_id")


def _batch_of_partition():
    return F.when(F.col("partition") == 1, 1).otherwise(0)


@query
def cdc_deletes(spark, sf_dir):
    winners = _whole_feed(spark, sf_dir).effective()
    return winners.filter(F.col("op") == C.DELETE).select("order_id", "lsn")


# ---- served table ----------------------------------------------------------
@query
def order_facts(spark, sf_dir):
    return _public(_facts(spark, sf_dir))


@query
def enrich_orders(spark, sf_dir):
    """A dimension with gaps: unmatched orders stay, without attributes."""
    dimension = enrich.enrichment_columns(X.solvent_customers(spark, sf_dir))
    orders = _whole_feed(spark, sf_dir).effective().filter(F.col("op") != C.DELETE)
    joined = enrich.join_dimension(
        orders, dimension, memory_bytes(dimension), CFG.broadcast_limit_bytes)
    return joined.select("order_id", "customer_id", "name", "city", "segment")


@query
def enrich_orders_shuffled(spark, sf_dir):
    """The same join for a dimension too large to broadcast."""
    dimension = enrich.enrichment_columns(X.solvent_customers(spark, sf_dir))
    batch = _whole_feed(spark, sf_dir, hold=_written(spark, "enrich"))
    orders = batch.effective().filter(F.col("op") != C.DELETE)
    joined = enrich.join_dimension(orders, dimension, None, CFG.broadcast_limit_bytes)
    return joined.select("order_id", "customer_id", "name", "city", "segment")


@query
def dim_enrich_columns(spark, sf_dir):
    return enrich.enrichment_columns(X.customers(spark, sf_dir))


@query
def sink_peek(spark, sf_dir):
    return _public(marts.peek(_facts(spark, sf_dir)))


@query
def sink_audit(spark, sf_dir):
    return counters.sink_audit(_facts(spark, sf_dir))


@query
def sink_op_mix(spark, sf_dir):
    return counters.op_mix(_facts(spark, sf_dir))


# ---- dead letters ----------------------------------------------------------
@query
def dlq_payloads(spark, sf_dir):
    return deadletter.read_back(_letters(spark, sf_dir)).select(
        "key", "reject_reason", "order_id", "op", "customer_id", "lsn", "offset",
        (F.length("json_str") > 0).alias("has_payload"),
    )


@query
def dlq_triage(spark, sf_dir):
    return _naive(deadletter.triage(_letters(spark, sf_dir)), "window_start")


# ---- jobs on a stored table ------------------------------------------------
def _published_dimension(spark, sf_dir, root) -> PublishedDimension:
    store = SnapshotStore(spark, f"{root}/customers")
    store.publish(store.write_candidate(
        enrich.enrichment_columns(X.customers(spark, sf_dir))))
    return PublishedDimension(store)


def _pipeline(spark, sf_dir, purpose, cfg=CFG) -> OrderPipeline:
    root = shared_folder(spark, purpose)
    return OrderPipeline(spark, root, _published_dimension(spark, sf_dir, root), cfg)


def _apply_out_of_order(pipeline, messages) -> None:
    pipeline.apply(X.first_part(messages), 0, "delivery")
    pipeline.apply(X.second_part(messages), 1, "delivery")


@query
def out_of_order_apply(spark, sf_dir):
    pipeline = _pipeline(spark, sf_dir, "disorder")
    _apply_out_of_order(pipeline, X.order_messages(spark, sf_dir))
    return _public(pipeline.state.served())


@query
def hard_delete_apply(spark, sf_dir):
    """Without tombstones an older change revives a deleted order."""
    cfg = C.PipelineConfig(tombstones=False)
    pipeline = _pipeline(spark, sf_dir, "hard-delete", cfg)
    _apply_out_of_order(pipeline, X.order_messages(spark, sf_dir))
    return _keys(pipeline.state.served())


@query
def replay_idempotence(spark, sf_dir):
    """Counters of A, B, and of the whole feed again under a new run."""
    pipeline = _pipeline(spark, sf_dir, "replay", C.PipelineConfig(state_buckets=8))
    messages = X.order_messages(spark, sf_dir)
    _apply_out_of_order(pipeline, messages)
    pipeline.state.compact()
    pipeline.apply(messages, 0, "replay")
    return pipeline.metrics().drop("recorded_at")


@query
def backfill_range(spark, sf_dir):
    pipeline = _pipeline(spark, sf_dir, "backfill", C.PipelineConfig(cache_batch=False))
    backfill(pipeline, X.order_messages(spark, sf_dir), "january",
             datetime(2024, 1, 10), datetime(2024, 1, 20))
    return _public(pipeline.state.served())


# ---- streams ---------------------------------------------------------------
@query
def stream_order_facts(spark, sf_dir):
    """Batch A, a restart from the checkpoint, then batch B."""
    pipeline = _pipeline(spark, sf_dir, "stream")
    messages, inbox = X.order_messages(spark, sf_dir), f"{pipeline.root}/inbox"
    for part in (X.first_part(messages), X.second_part(messages)):
        part.write.mode("append").parquet(inbox)
        stream = start(
            topics.file_stream(spark, inbox), pipeline, f"{pipeline.root}/checkpoint",
            available_now=True)
        stream.awaitTermination()
    return _public(pipeline.state.served())


@query
def stream_lsn_state(spark, sf_dir):
    """Live, enriched orders after a stream that keeps its versions in the state store."""
    root = shared_folder(spark, "versions")
    dimension = _published_dimension(spark, sf_dir, root)
    messages = X.order_messages(spark, sf_dir)
    for part in (X.first_part(messages), X.second_part(messages)):
        part.write.mode("append").parquet(f"{root}/inbox")
        changes = version_stream(topics.file_stream(spark, f"{root}/inbox"), CFG)
        stream = (
            write_changes(changes, f"{root}/changes", f"{root}/checkpoint", dimension)
            .trigger(availableNow=True).start()
        )
        stream.awaitTermination()
    merge_changes(spark, f"{root}/changes")
    return _keys(live_orders(spark, f"{root}/changes"), "amount", "name", "city", "segment")


def _labelled_in_two_batches(spark, sf_dir, root, after=lambda: None) -> DataFrame:
    """Batch A, a restart from the checkpoint, then batch B, each followed by ``after``."""
    dimension, size = _published_dimension(spark, sf_dir, root)()
    messages = X.order_messages(spark, sf_dir)
    for part in (X.first_part(messages), X.second_part(messages)):
        part.write.mode("append").parquet(f"{root}/inbox")
        stream = outcomes.label_stream(topics.file_stream(spark, f"{root}/inbox"), dimension, size, CFG)
        outcomes.write_labelled(stream, f"{root}/labelled", f"{root}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
        after()
    return outcomes.read_labelled(spark, f"{root}/labelled")


@query
def stream_outcomes(spark, sf_dir):
    """The fate of every message of a stream that keeps its versions in the state store."""
    labelled = _labelled_in_two_batches(spark, sf_dir, shared_folder(spark, "labelled"))
    return labelled.select("offset", "outcome")


@query
def stream_counters(spark, sf_dir):
    """Counters of that stream, by batch."""
    counted = outcomes.counters(
        _labelled_in_two_batches(spark, sf_dir, shared_folder(spark, "labelled")))
    # One row for each batch.
    number = F.row_number().over(Window.orderBy("applied_at")) - 1
    return counted.withColumn("batch_id", number).drop("applied_at")


@query
def stream_revenue(spark, sf_dir):
    """Revenue as a running result, after late corrections and deletes."""
    root = shared_folder(spark, "revenue")

    def add_up() -> None:
        labelled = outcomes.labelled_stream(spark, f"{root}/labelled")
        totals = revenue.epoch_totals(revenue.deltas(labelled))
        revenue.write_totals(totals, f"{root}/totals", f"{root}/checkpoint-totals").trigger(
            availableNow=True).start().awaitTermination()

    _labelled_in_two_batches(spark, sf_dir, root, add_up)
    found = revenue.revenue(revenue.read_totals(spark, f"{root}/totals"))
    return _naive(found.withColumn("revenue", F.round("revenue", 2)), "window_start")


@query
def stream_triage(spark, sf_dir):
    """Letters of batch A; then those of batch B with the letters of A sent again."""
    root, sent = shared_folder(spark, "triage"), _letters(spark, sf_dir)
    position = F.from_json(F.col("value").cast("string"), "`partition` int, offset bigint")
    rows = sent.select(
        F.col("key").cast("binary").alias("key"), "value", F.lit(C.DEAD_LETTER_TOPIC).alias("topic"),
        position["partition"].alias("partition"), position["offset"].alias("offset"))
    deliveries = ((X.first_part(rows), "2024-02-01 00:00"), (rows, "2024-02-01 00:05"))
    for part, at in deliveries:
        part.withColumn("timestamp", F.lit(at).cast("timestamp")).write.mode("append").parquet(f"{root}/inbox")
        unique = letters.unique_letters(topics.file_stream(spark, f"{root}/inbox"))
        letters.write_triage(unique, f"{root}/counts", f"{root}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    return _naive(letters.read_triage(spark, f"{root}/counts"), "window_start")


# ---- dimension refresh -----------------------------------------------------
@query
def dim_extract(spark, sf_dir):
    frame = quality.conform(X.source_customers(spark, sf_dir), C.CUSTOMER)
    return _naive(frame, "signup_date", "updated_at")


@query
def dim_snapshot(spark, sf_dir):
    """Two versions published one after the other; readers see the second."""
    store = SnapshotStore(spark, shared_folder(spark, "snapshot"))
    first = quality.conform(X.source_customers(spark, sf_dir), C.CUSTOMER)
    store.publish(store.write_candidate(first))
    store.publish(store.write_candidate(
        X.second_version(store.read(), F.col("updated_at") + F.expr("INTERVAL 1 DAY"))))
    return _naive(store.read(), "signup_date", "updated_at")


@query
def dim_refresh(spark, sf_dir):
    """Extract, validate and publish; the snapshot that readers then see."""
    store = SnapshotStore(spark, shared_folder(spark, "refresh"))
    source = X.dated_customers(spark, sf_dir)
    refresh_dimension(source, quality.baseline(source), store, X.RULES, X.QUALITY_CLOCK, keep_history=True)
    return store.read().select(*C.DIMENSION_COLUMNS)


@query
def source_baseline(spark, sf_dir):
    return _naive(quality.baseline(X.source_customers(spark, sf_dir)), "max_updated_at")


def _report(spark, sf_dir, frame) -> DataFrame:
    source = quality.baseline(X.source_customers(spark, sf_dir))
    return quality.quality_report(frame, X.RULES, clock=X.QUALITY_CLOCK, source=source)


@query
def dq_report(spark, sf_dir):
    frame = quality.conform(X.source_customers(spark, sf_dir), C.CUSTOMER)
    return _report(spark, sf_dir, frame).drop("detail")


@query
def dq_report_corrupt(spark, sf_dir):
    return _report(spark, sf_dir, X.corrupt_customers(spark, sf_dir)).drop("detail")


@query
def dq_summary(spark, sf_dir):
    return quality.summary(_report(spark, sf_dir, X.corrupt_customers(spark, sf_dir)))


@query
def dq_null_rates(spark, sf_dir):
    return quality.null_rates(X.corrupt_customers(spark, sf_dir), X.RULES)


@query
def dq_unexpected_segments(spark, sf_dir):
    return quality.unexpected_values(X.corrupt_customers(spark, sf_dir), X.RULES)


# ---- lag, trends, reports --------------------------------------------------
@query
def lag_by_partition(spark, sf_dir):
    return counters.partition_lag(X.topic_offsets(spark, sf_dir))


@query
def lag_total(spark, sf_dir):
    return counters.total_lag(counters.partition_lag(X.topic_offsets(spark, sf_dir)), CFG)


@query
def revenue_segment_city(spark, sf_dir):
    revenue = marts.revenue_by_window(_facts(spark, sf_dir))
    return _naive(revenue.withColumn("revenue", F.round("revenue", 2)), "window_start")


@query
def revenue_trailing(spark, sf_dir):
    revenue = marts.revenue_trailing(_facts(spark, sf_dir), TRAILING_NOW, timedelta(days=1))
    return revenue.withColumn("revenue", F.round("revenue", 2))


@query
def counter_trend(spark, sf_dir):
    """The feed delivered in 24 interleaved batches."""
    judged = _written(spark, "trend")("judged", _judged(spark, sf_dir)).withColumn(
        "batch_id", F.col("offset") * 7 % 24)
    fresh = events.fresh(judged).withColumn("batch_id", F.col("offset") * 7 % 24)
    rows = counters.batch_counters(judged, counters.sequence_outcomes(fresh), "batch_id")
    trend = counters.counter_trend(rows)
    return trend.select("batch_id", *[
        F.round(c, 6).alias(c)
        for c in ("superseded_share", "stale_share", "superseded_trend", "stale_trend")])


def _history(spark, sf_dir) -> DataFrame:
    first = X.customers(spark, sf_dir).withColumn(
        "updated_at", F.lit("2024-01-01").cast("timestamp"))
    second = X.second_version(first, F.lit(X.SECOND_VERSION_AT.isoformat()).cast("timestamp"))
    return history.type2_history(first.unionByName(second))


@query
def dim_scd2(spark, sf_dir):
    return _naive(_history(spark, sf_dir), "valid_from", "valid_to")


@query
def enrich_as_of(spark, sf_dir):
    ranges = _history(spark, sf_dir)
    return _as_of_columns(history.enrich_as_of(
        _fresh(spark, sf_dir), ranges, memory_bytes(ranges), CFG.broadcast_limit_bytes))


@query
def enrich_as_of_shuffled(spark, sf_dir):
    """The same join for a history too large to broadcast."""
    fresh = _written(spark, "as-of")("fresh", _fresh(spark, sf_dir))
    return _as_of_columns(history.enrich_as_of(
        fresh, _history(spark, sf_dir), None, CFG.broadcast_limit_bytes))


def _as_of_columns(joined) -> DataFrame:
    return _naive(joined.select(
        "lsn", "order_id", "customer_id", "name", "city", "segment", "valid_from"), "valid_from")
