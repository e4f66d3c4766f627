"""Dimension history (type 2) and enrichment as of the event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.enrich import join_dimension
from tidemark.operators.events import POSITION

ATTRIBUTES = ("name", "city", "segment")


def type2_history(versions: DataFrame, attributes: tuple[str, ...] = ATTRIBUTES) -> DataFrame:
    """Validity ranges from snapshot rows (customer_id, attributes, updated_at).

    A snapshot that changes nothing extends the current range. Of rows of one customer
    with the same ``updated_at`` the one that sorts last by its attributes counts, so no
    range is empty and every run gives the same ranges. Snapshots hold each customer
    once, so a window group has at most one row per snapshot.
    """
    by_time = Window.partitionBy("customer_id").orderBy("updated_at")
    state = F.struct(*attributes)
    versions = (
        versions.groupBy("customer_id", "updated_at").agg(F.max(state).alias("_state"))
        .select("customer_id", "updated_at", "_state.*")
    )
    changed = ~state.eqNullSafe(F.lag(state).over(by_time))
    first = F.row_number().over(by_time) == 1
    return (
        versions.select("customer_id", *attributes, "updated_at")
        .withColumn("_keep", first | changed).filter("_keep").drop("_keep")
        .withColumn("valid_to", F.lead("updated_at").over(by_time))
        .withColumnRenamed("updated_at", "valid_from")
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def advance(
    history: DataFrame | None, snapshot: DataFrame, at: Column,
    attributes: tuple[str, ...] = ATTRIBUTES,
) -> DataFrame:
    """The history after one more snapshot."""
    if history is None:
        return advance_current(None, snapshot, at, attributes)
    moved = advance_current(history.filter("is_current"), snapshot, at, attributes)
    return history.filter("NOT is_current").unionByName(moved)


def advance_current(
    current: DataFrame | None, snapshot: DataFrame, at: Column,
    attributes: tuple[str, ...] = ATTRIBUTES,
) -> DataFrame:
    """What becomes of the current ranges by one more snapshot: those that it closes, and
    those that are current after it. Ranges that were closed before take no part.

    Ranges of changed customers and of those who are no longer in the snapshot end at
    ``at``; a customer who comes back opens a new range. A changed customer's new range
    begins where the old one ends.
    """
    now = snapshot.select("customer_id", *attributes)
    if current is None:
        return now.select(
            "*", at.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"),
            F.lit(True).alias("is_current"))
    same = F.lit(True)
    for a in attributes:
        same = same & F.col(f"n.{a}").eqNullSafe(F.col(f"h.{a}"))
    met = current.alias("h").join(
        now.alias("n"), F.col("h.customer_id") == F.col("n.customer_id"), "full")
    old = met.filter(F.col("h.customer_id").isNotNull()).select(
        *[F.col(f"h.{c}") for c in ("customer_id", *attributes, "valid_from")],
        F.when(F.col("n.customer_id").isNotNull() & same, F.lit(None)).otherwise(at).alias("valid_to"),
    ).withColumn("is_current", F.col("valid_to").isNull())
    new = met.filter(F.col("n.customer_id").isNotNull() & ~(F.col("h.customer_id").isNotNull() & same)).select(
        *[F.col(f"n.{c}") for c in ("customer_id", *attributes)], at.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"))
    return old.unionByName(new)


def enrich_as_of(
    orders: DataFrame, history: DataFrame, history_bytes: int | None, limit_bytes: int,
    at: Column | None = None,
) -> DataFrame:
    """Attributes that were valid at the event time; unmatched orders are kept.

    A history within the limit is broadcast, a larger one meets the orders in time order.
    """
    at = F.col("event_time") if at is None else at
    ranges = history.drop("is_current")
    if history_bytes is None or history_bytes > limit_bytes:
        return sorted_as_of(orders, ranges, at)
    valid = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    return join_dimension(orders, ranges, history_bytes, limit_bytes, condition=valid)


def sorted_as_of(orders: DataFrame, ranges: DataFrame, at: Column, key: str = "customer_id") -> DataFrame:
    """As-of join by one sort: orders and ranges of a customer in one line of time.

    The last range that began is carried along it, so the work is linear in both sides. A
    customer who holds more than the fair share of a task is split at points of time, and
    each stretch gets a copy of the range that is valid at its begin; there are fewer
    such customers than tasks, and each is split into as many stretches as there are
    tasks. Orders without a customer are dealt out evenly.
    """
    parts = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    moment = F.unix_micros(at)
    timed = orders.select(F.struct("*").alias("_order"), F.col(key).alias("_key"), moment.alias("_at"))
    counts = timed.filter("_key IS NOT NULL").groupBy("_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"), F.max("_at").alias("_high"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    heavy = (
        counts.join(F.broadcast(total), F.col("_n") * parts > F.col("_total"))
        .select("_key", "_low", ((F.col("_high") - F.col("_low")) / parts + 1).alias("_width"))
    )

    def stretch(time: Column) -> Column:
        """Number of the stretch; all of a customer who is not split is the first."""
        place = F.floor((time - F.col("_low")) / F.col("_width")).cast("int")
        return F.when(F.col("_low").isNull(), 0).otherwise(
            F.greatest(F.lit(0), F.least(F.lit(parts - 1), F.coalesce(place, F.lit(0)))))

    spread = F.pmod(F.xxhash64(*[f"_order.{c}" for c in POSITION]), F.lit(parts)).cast("int")
    dealt = timed.join(F.broadcast(heavy), "_key", "left").select(
        "_key", F.when(F.col("_key").isNull(), spread).otherwise(stretch(F.col("_at"))).alias("_part"),
        "_at", F.lit(1).alias("_side"), "_order")
    begins, ends = F.unix_micros("valid_from"), F.unix_micros("valid_to")
    carried = (
        ranges.filter("valid_from IS NOT NULL").select(F.struct("*").alias("_range"), F.col(key).alias("_key"), begins.alias("_at"),
                      F.coalesce(ends, F.lit(1 << 62)).alias("_end"))
        .join(F.broadcast(heavy), "_key", "left")
        .select("_key", F.explode(F.sequence(stretch(F.col("_at")), stretch(F.col("_end")))).alias("_part"),
                "_at", F.lit(0).alias("_side"), "_range")
    )
    line = Window.partitionBy("_key", "_part").orderBy("_at", "_side").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    met = (
        dealt.unionByName(carried, allowMissingColumns=True)
        .withColumn("_range", F.last("_range", ignorenulls=True).over(line))
        .filter("_side = 1")
    )
    over = F.col("_key").isNull() | F.col("_at").isNull() | (
        F.unix_micros("_range.valid_to") <= F.col("_at"))
    found = met.withColumn("_range", F.when(over, F.lit(None)).otherwise(F.col("_range")))
    return found.select("_order.*", *[f"_range.{c}" for c in ranges.columns if c != key])
