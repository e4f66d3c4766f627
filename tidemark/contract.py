"""Schemas, fixed values and settings shared by every job."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# ---- fixed values -------------------------------------------------------
# Producers and readers of the data depend on these; they are not tunable.
OPS = ("I", "U", "D")
DELETE = "D"
REQUIRED_EVENT_FIELDS = ("op", "order_id", "customer_id", "amount", "lsn", "product_category")
CUSTOMER_ID_PATTERN = r"^[0-9]+$"
AMOUNT_PATTERN = r"^-?[0-9]+(\.[0-9]+)?$"
CATEGORY_PATTERN = r"^[A-Za-z][A-Za-z _-]*$"
REASON_INVALID = "schema_or_parse_failure"
REASON_LATE = "late_event"
ORDERS_TOPIC = "orders_stream"
DEAD_LETTER_TOPIC = "orders_stream_dlt"
DIMENSION_KEY = "customer_id"
DIMENSION_COLUMNS = ("customer_id", "name", "city", "segment")
SERVED_COLUMNS = (
    "_id", "order_id", "op", "customer_id", "amount", "product_category",
    "event_time", "lsn", "ingested_at", "name", "city", "segment",
)
DIMENSION_REQUIRED = ("customer_id", "name", "city", "segment", "signup_date")
DIMENSION_TEXT = ("name", "city", "segment")
ALLOWED_SEGMENTS = ("Premium", "Standard")

# Spark renders JSON numbers of 1e7 and above with an exponent when they are
# read as text, so the default check also takes that spelling.
AMOUNT_PATTERN_RENDERED = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"

# ---- outcomes -----------------------------------------------------------
INVALID, LATE, FRESH = "invalid", "late", "fresh"
SUPERSEDED, STALE, UPSERT, REMOVE = "superseded", "stale", "upsert", "delete"
OUTCOMES = (INVALID, LATE, SUPERSEDED, STALE, UPSERT, REMOVE)

# ---- schemas ------------------------------------------------------------
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Everything but the version is read as text, so that a bad value can be kept
# and dead-lettered instead of turning the whole payload into NULLs.
ORDER_EVENT = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("amount", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("lsn", T.LongType()),
])

CUSTOMER = T.StructType([
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("segment", T.StringType()),
    T.StructField("signup_date", T.TimestampType()),
    T.StructField("updated_at", T.TimestampType()),
])

# One row per order; op 'D' marks a tombstone.
ORDER_STATE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("customer_id", T.IntegerType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("lsn", T.LongType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("segment", T.StringType()),
])

COUNTERS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("processed", T.LongType()),
    T.StructField("accepted", T.LongType()),
    T.StructField("invalid", T.LongType()),
    T.StructField("late", T.LongType()),
    T.StructField("superseded", T.LongType()),
    T.StructField("stale", T.LongType()),
    T.StructField("upserts", T.LongType()),
    T.StructField("deletes", T.LongType()),
    T.StructField("deletes_effective", T.LongType()),
    T.StructField("inserts", T.LongType()),
    T.StructField("updates", T.LongType()),
    T.StructField("unknown_ops", T.LongType()),
    T.StructField("reconciles", T.BooleanType()),
    T.StructField("recorded_at", T.TimestampType()),
])


def with_id_type(schema: T.StructType, cfg: PipelineConfig) -> T.StructType:
    """A schema whose customer_id has the configured type."""
    kind = {"int": T.IntegerType(), "bigint": T.LongType()}[cfg.customer_id_type]
    return T.StructType([
        T.StructField(f.name, kind) if f.name == "customer_id" else f for f in schema])


# ---- settings -----------------------------------------------------------
@dataclass(frozen=True)
class PipelineConfig:
    """Tunable settings of the order pipeline."""

    allowed_lateness_s: int = 3600
    max_offsets_per_trigger: int = 20_000
    lag_report_every: int = 5
    lag_warn_factor: int = 10
    # None measures lateness against the arrival time of each message, which is the
    # time of processing only on topics that stamp messages on append.
    clock: datetime | None = None
    # False measures it against the time at which its batch is processed.
    late_on_arrival: bool = True
    # Refuse amounts that only match once an exponent is allowed.
    strict_amount: bool = False
    # Keep deleted versions, so that an older change cannot revive an order.
    tombstones: bool = True
    # How long after its delete; must exceed how far back messages can be
    # replayed. None keeps them for good.
    tombstone_ttl_s: int | None = None
    # Buckets of the base, to be set before the first compaction: enough for about
    # 1 GB a bucket. A table is dealt out anew by ``compact(buckets=...)``.
    state_buckets: int | None = None
    # Number of batch folders at which they are folded into the base; None leaves it to
    # the compact job.
    compact_after: int | None = None
    # Number of batch folders from which on a batch warns that the table is not compacted.
    warn_after: int = 200
    # How long replaced folders stay for those who still read them.
    retain_s: int = 7 * 24 * 3600
    # Type of customer_id, "int" or "bigint"; ids beyond it are invalid.
    customer_id_type: str = "int"
    # Largest dimension, in memory, that is copied to every executor.
    broadcast_limit_bytes: int = 64 * 1024 * 1024
    # A batch of at most so many orders names them to the scan of the base, which then
    # reads only their buckets; a larger one is joined with all of them.
    prune_keys: int = 10_000
    # Keep the parsed batch between its uses; off for bulk backfills.
    cache_batch: bool = True


@dataclass(frozen=True)
class QualityRules:
    """Thresholds and column roles of the dimension quality gate."""

    min_rows: int = 1
    max_null_rate: float = 0.0
    max_age_hours: float = 26.0
    required: tuple[str, ...] = DIMENSION_REQUIRED
    text_columns: tuple[str, ...] = DIMENSION_TEXT
    key: str = "customer_id"
    domain_column: str = "segment"
    allowed: tuple[str, ...] = ALLOWED_SEGMENTS
    start_date: str = "signup_date"
    updated_at: str = "updated_at"
