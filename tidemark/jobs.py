"""Command line of the jobs, for spark-submit.

    refresh   extract, validate and publish the customer dimension
    stream    apply the order topic to the served table
    backfill  apply a range of it once, through the same steps
    compact   fold the batches of the served table into its base
    audit     check that the served table holds each order once
    lag       how far the stream is behind
    revenue   revenue by window from the stream on the state store

Broker and database can be replaced by Parquet folders of the same columns.
"""

from __future__ import annotations

import argparse
import logging
import os
import sys
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators import counters, quality
from tidemark.plans.batch import OrderPipeline, backfill
from tidemark.plans.refresh import RefreshStopped, refresh_dimension
from tidemark.sources import files, topics
from tidemark.sources.database import JdbcSource
from tidemark.sources.snapshots import PublishedDimension, SnapshotStore
from tidemark.streaming import outcomes, revenue
from tidemark.streaming.newest import merge_changes
from tidemark.streaming.run import LagReporter, newest_offsets, start

log = logging.getLogger("tidemark")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)

    refresh = _command(commands, "refresh")
    source = refresh.add_mutually_exclusive_group(required=True)
    source.add_argument("--jdbc-url")
    source.add_argument("--source", help="Parquet folder instead of a database")
    refresh.add_argument("--user", help="database user, required with --jdbc-url")
    refresh.add_argument("--password-variable", default="TIDEMARK_DB_PASSWORD")
    refresh.add_argument("--keep-history", action="store_true", help="close and open validity ranges")
    refresh.add_argument("--partitions", type=int, default=16)
    refresh.add_argument("--min-rows", type=int, default=1)
    refresh.add_argument("--max-null-rate", type=float, default=0.0)
    refresh.add_argument("--max-age-hours", type=float, default=26.0)
    refresh.add_argument("--segments", nargs="+", default=list(C.ALLOWED_SEGMENTS))
    refresh.add_argument("--customer-id-type", choices=("int", "bigint"), default=C.PipelineConfig.customer_id_type)
    refresh.add_argument("--now", type=_instant, help="clock of the checks, default the present")

    stream = _command(commands, "stream", applies=True)
    stream.add_argument("--available-now", action="store_true", help="stop when caught up")
    stream.add_argument("--state-store", action="store_true",
                        help="keep versions in the state store, for small batches on a huge table")
    stream.add_argument("--dimension-poll-s", type=int, default=60,
                        help="how often a stream on the state store looks for a new dimension")

    history = _command(commands, "backfill", applies=True)
    history.add_argument("--label", required=True, help="a label is applied once")
    history.add_argument("--begin", type=_instant, required=True)
    history.add_argument("--end", type=_instant, required=True)

    compact = _command(commands, "compact")
    compact.add_argument("--buckets", type=int, help="new number, or that of the first base")
    compact.add_argument("--retain-s", type=int, default=C.PipelineConfig.retain_s)
    compact.add_argument("--tombstone-ttl-s", type=int)
    compact.add_argument("--hard-deletes", action="store_true", help="as the table is written")
    compact.add_argument("--customer-id-type", choices=("int", "bigint"), default=C.PipelineConfig.customer_id_type)

    earned = _command(commands, "revenue")
    earned.add_argument("--available-now", action="store_true", help="stop when caught up")
    earned.add_argument("--minutes", type=int, default=15, help="width of the windows")

    _command(commands, "audit")
    lag = _command(commands, "lag")
    lag.add_argument("--max-offsets", type=int, default=C.PipelineConfig.max_offsets_per_trigger)
    return parser


def _command(commands, name: str, applies: bool = False) -> argparse.ArgumentParser:
    parser = commands.add_parser(name)
    parser.add_argument("--root", required=True, help="folder that every executor can reach")
    if applies:
        source = parser.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="brokers of the order topic")
        source.add_argument("--inbox", help="Parquet folder of messages instead of a topic")
        defaults = C.PipelineConfig
        parser.add_argument("--topic", default=C.ORDERS_TOPIC)
        parser.add_argument("--dead-letter-topic", default=C.DEAD_LETTER_TOPIC)
        parser.add_argument("--group", help="consumer group shown to the brokers")
        parser.add_argument("--lateness-s", type=int, default=defaults.allowed_lateness_s)
        parser.add_argument("--late-on-processing", action="store_true")
        parser.add_argument("--max-offsets", type=int, default=defaults.max_offsets_per_trigger)
        parser.add_argument("--customer-id-type", choices=("int", "bigint"), default=defaults.customer_id_type)
        parser.add_argument("--strict-amount", action="store_true")
        parser.add_argument("--hard-deletes", action="store_true", help="keep no tombstones")
        parser.add_argument("--tombstone-ttl-s", type=int)
        parser.add_argument("--broadcast-limit-bytes", type=int, default=defaults.broadcast_limit_bytes)
        parser.add_argument("--buckets", type=int, help="of the base, needed to compact")
        parser.add_argument("--compact-after", type=int, help="batches; default: by the compact job")
        parser.add_argument("--retain-s", type=int, default=defaults.retain_s)
        parser.add_argument("--lag-every", type=int, default=defaults.lag_report_every)
    return parser


def _instant(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


def customers(spark: SparkSession, args) -> SnapshotStore:
    return SnapshotStore(spark, f"{args.root}/customers")


def pipeline(spark: SparkSession, args, **settings) -> OrderPipeline:
    """The order job as the command line describes it; fails without a dimension."""
    cfg = C.PipelineConfig(
        allowed_lateness_s=args.lateness_s, late_on_arrival=not args.late_on_processing,
        max_offsets_per_trigger=args.max_offsets, lag_report_every=args.lag_every,
        customer_id_type=args.customer_id_type, strict_amount=args.strict_amount,
        tombstones=not args.hard_deletes, tombstone_ttl_s=args.tombstone_ttl_s,
        broadcast_limit_bytes=args.broadcast_limit_bytes, state_buckets=args.buckets,
        compact_after=args.compact_after, retain_s=args.retain_s, **settings)
    dimension = PublishedDimension(customers(spark, args))
    dimension()
    send = None
    if args.servers:
        def send(letters: DataFrame) -> None:
            topics.write_kafka(letters, args.servers, args.dead_letter_topic)
    return OrderPipeline(spark, f"{args.root}/facts", dimension, cfg, send)


def run_refresh(spark: SparkSession, args) -> int:
    rules = C.QualityRules(
        min_rows=args.min_rows, max_null_rate=args.max_null_rate,
        max_age_hours=args.max_age_hours, allowed=tuple(args.segments))
    if args.source:
        rows = spark.read.parquet(args.source)
        held = quality.baseline(rows)
    else:
        source = JdbcSource(
            args.jdbc_url, args.user, os.environ.get(args.password_variable, ""),
            partitions=args.partitions)
        rows, held = source.read(spark), source.baseline(spark)
    clock = args.now or datetime.now(timezone.utc)
    try:
        report = refresh_dimension(
            rows, held, customers(spark, args), rules, clock, args.keep_history,
            C.PipelineConfig(customer_id_type=args.customer_id_type))
    except RefreshStopped as stopped:
        log.error("%s", stopped)
        return 1
    for check in report.filter(~F.col("passed")).collect():
        log.warning("%s: %s", check.check_name, check.detail)
    return 0


def run_stream(spark: SparkSession, args) -> int:
    job = pipeline(spark, args)
    if args.state_store:
        return _run_versions(spark, args, job)
    if args.servers:
        messages = topics.kafka_stream(
            spark, args.servers, topic=args.topic, group=args.group, cfg=job.cfg)
    else:
        messages = topics.file_stream(spark, args.inbox)
    reporter = LagReporter(spark, f"{args.root}/lag", job.cfg)
    spark.streams.addListener(reporter)
    try:
        start(messages, job, f"{args.root}/checkpoint", args.available_now).awaitTermination()
    finally:
        spark.streams.removeListener(reporter)
    return 0


def _run_versions(spark: SparkSession, args, job: OrderPipeline) -> int:
    """The stream on the state store: one query that labels every message.

    It is started anew from its checkpoint when another dimension is published.
    """
    root, store = f"{args.root}/versions", job.dimension.store
    reporter = LagReporter(spark, f"{args.root}/lag", job.cfg)
    spark.streams.addListener(reporter)
    try:
        while True:
            if args.servers:
                messages = topics.kafka_stream(
                    spark, args.servers, topic=args.topic, group=args.group, cfg=job.cfg)
            else:
                messages = topics.file_stream(spark, args.inbox)
            version = store.current()["number"]
            labelled = outcomes.label_stream(messages, *job.dimension(), job.cfg)
            writer = outcomes.write_labelled(labelled, f"{root}/labelled", f"{root}/checkpoint-labelled")
            if args.available_now:
                outcomes.catch_up(writer, outcomes.expires(job.cfg))
                return 0
            query = writer.start()
            while store.current()["number"] == version:
                if query.awaitTermination(args.dimension_poll_s):
                    return 0
            query.stop()
    finally:
        spark.streams.removeListener(reporter)


def run_revenue(spark: SparkSession, args) -> int:
    """Totals of the labelled messages as they come, by window of event time."""
    root = f"{args.root}/versions"
    if not files.exists(spark, f"{root}/labelled/_spark_metadata"):
        log.error("no stream on the state store has written below %s", args.root)
        return 1
    changed = revenue.deltas(outcomes.labelled_stream(spark, f"{root}/labelled"))
    writer = revenue.write_totals(
        revenue.epoch_totals(changed, timedelta(minutes=args.minutes)), f"{root}/revenue",
        f"{root}/checkpoint-revenue")
    if args.available_now:
        outcomes.catch_up(writer)
    else:
        writer.start().awaitTermination()
    return 0


def run_compact(spark: SparkSession, args) -> int:
    """Fold the batches into the base; exit code 1 if another writer was faster."""
    cfg = C.PipelineConfig(
        state_buckets=args.buckets, retain_s=args.retain_s, tombstones=not args.hard_deletes,
        tombstone_ttl_s=args.tombstone_ttl_s, customer_id_type=args.customer_id_type)
    job = OrderPipeline(spark, f"{args.root}/facts", PublishedDimension(customers(spark, args)), cfg)
    done = job.state.compact(datetime.now(timezone.utc), args.buckets)
    changes = f"{args.root}/versions/changes"
    if files.exists(spark, changes):
        merge_changes(spark, changes, args.retain_s)
    return 0 if done else 1


def run_backfill(spark: SparkSession, args) -> int:
    job = pipeline(spark, args, cache_batch=False)
    if args.servers:
        messages = topics.kafka_range(spark, args.servers, args.topic, args.begin, args.end)
    else:
        messages = spark.read.schema(C.MESSAGE).parquet(args.inbox)
    if not backfill(job, messages, args.label, args.begin, args.end):
        log.warning("%s was applied to this range before; nothing was changed", args.label)
        return 3
    return 0


def run_audit(spark: SparkSession, args) -> int:
    state = OrderPipeline(
        spark, f"{args.root}/facts", PublishedDimension(customers(spark, args))).state
    if state.manifests.latest() is None:
        log.error("there is no order table at %s", state.root)
        return 1
    facts = state.served()
    found = counters.sink_audit(facts).first()
    mix = {r.op: r.n for r in counters.op_mix(facts).collect()}
    log.info("audit %s, ops %s", found.asDict(), mix)
    return 0 if found.sound else 1


def run_lag(spark: SparkSession, args) -> int:
    cfg = C.PipelineConfig(max_offsets_per_trigger=args.max_offsets)
    if not files.names(spark, f"{args.root}/lag"):
        log.error("no stream has reported below %s", args.root)
        return 1
    lag = counters.partition_lag(newest_offsets(spark, f"{args.root}/lag"))
    behind = counters.total_lag(lag, cfg).collect()
    for topic in behind:
        log.log(logging.WARNING if topic.over_threshold else logging.INFO,
                "topic %s is %d messages behind", topic.topic, topic.total_lag)
    return int(any(topic.over_threshold for topic in behind))


JOBS = {
    "refresh": run_refresh, "stream": run_stream, "backfill": run_backfill,
    "revenue": run_revenue, "compact": run_compact, "audit": run_audit, "lag": run_lag,
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = spark or SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # naive times of the source are UTC
    return JOBS[args.command](spark, args)


if __name__ == "__main__":
    sys.exit(main())
