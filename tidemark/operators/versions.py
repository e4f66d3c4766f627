"""Newest version per order and the guard against stale versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators.events import POSITION


def newest_first():
    """Of equal versions the first to arrive stays, as it does against the stored one."""
    return [F.col("lsn").desc(), *[F.col(c).asc() for c in ("arrived_at", *POSITION)]]


def latest_per_order(events: DataFrame, *extra_keys: str) -> DataFrame:
    """The newest event of each order.

    Spark limits each group to one row before the shuffle, so an order with a
    large share of all events sends at most one row per task.
    """
    window = Window.partitionBy("order_id", *extra_keys).orderBy(*newest_first())
    return (
        events.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1).drop("_rank")
    )


def label(judged: DataFrame, stored: DataFrame | None = None, parts: int | None = None) -> DataFrame:
    """Every judged event with its outcome, in one pass over the events.

    The events of an order are dealt over ``parts`` groups, and the losers of each group
    are superseded at once. Only the groups' winners meet: at most ``parts`` of an order,
    however many events it has. All others take part in that step under a key of their
    own, evenly spread, which also serves the join with ``stored`` (order_id, stored_lsn,
    stored_op), so the events are not joined with themselves and not read again.
    """
    parts = parts or int(judged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fresh = F.col("stage") == C.FRESH
    own = F.concat_ws("-", F.lit("#"), *POSITION)
    order = F.concat(F.lit("+"), F.col("order_id"))
    local = Window.partitionBy("_group", "_part").orderBy(*newest_first())
    dealt = judged.withColumns({
        "_group": F.when(fresh, order).otherwise(own),
        "_part": F.when(fresh, F.pmod(F.xxhash64(*POSITION), F.lit(parts))).otherwise(0),
    }).withColumn("_first", fresh & (F.row_number().over(local) == 1))
    whole = Window.partitionBy("_group").orderBy(*newest_first())
    met = (
        dealt.withColumn("_group", F.when(F.col("_first"), order).otherwise(own))
        .withColumn("_first", F.col("_first") & (F.row_number().over(whole) == 1)).drop("_part")
    )
    if stored is None:
        met = met.withColumns({
            "stored_lsn": F.lit(None).cast("bigint"), "stored_op": F.lit(None).cast("string")})
    else:
        known = stored.select(order.alias("_group"), "stored_lsn", "stored_op")
        met = met.join(known, "_group", "left").withColumns({
            c: F.when(F.col("_first"), F.col(c)) for c in ("stored_lsn", "stored_op")})
    return met.withColumn(
        "outcome",
        F.when(~fresh, F.col("stage")).when(~F.col("_first"), C.SUPERSEDED)
        .when(F.col("lsn") <= F.col("stored_lsn"), C.STALE)
        .when(F.col("op") == C.DELETE, C.REMOVE).otherwise(C.UPSERT),
    ).drop("_group", "_first")


def attach_stored(latest: DataFrame, stored: DataFrame) -> DataFrame:
    """Winners beside the version stored for their order, NULL for new orders.

    ``stored`` has one row (order_id, stored_lsn, stored_op) per known order.
    """
    return latest.join(stored, "order_id", "left")


def guard(attached: DataFrame) -> DataFrame:
    """Label each winner stale, upsert or delete against the stored version."""
    return attached.withColumn(
        "outcome",
        F.when(F.col("lsn") <= F.col("stored_lsn"), C.STALE)
        .when(F.col("op") == C.DELETE, C.REMOVE)
        .otherwise(C.UPSERT),
    )


def effective(guarded: DataFrame) -> DataFrame:
    return guarded.filter(F.col("outcome") != C.STALE)


def stored_versions(state: DataFrame, tombstones: bool = True) -> DataFrame:
    """The part of the state that the guard needs."""
    rows = state if tombstones else state.filter(F.col("op") != C.DELETE)
    return rows.select(
        "order_id", F.col("lsn").alias("stored_lsn"), F.col("op").alias("stored_op"),
    )


def lookup_versions(stored: DataFrame, events: DataFrame) -> DataFrame:
    """Stored versions of the orders that appear in ``events``."""
    return stored.join(events.select("order_id"), "order_id", "left_semi")


def outcomes(judged: DataFrame, guarded: DataFrame) -> DataFrame:
    """Exactly one outcome for every message of the batch.

    The join key is the message position: never NULL, unique, and evenly
    spread even if one order or one kind of junk fills most of the batch.
    """
    verdict = guarded.select(*POSITION, F.col("outcome").alias("_outcome"))
    return (
        judged.join(verdict, list(POSITION), "left")
        .withColumn(
            "outcome",
            F.when(F.col("stage") != C.FRESH, F.col("stage"))
            .otherwise(F.coalesce("_outcome", F.lit(C.SUPERSEDED))),
        )
        .drop("_outcome")
    )


def replace_rows(parts: list[DataFrame]) -> DataFrame:
    """One row per order from parts that replace each other, oldest first.

    Each part loses the orders that any newer part holds. Parts bucketed by
    order are joined in place.
    """
    kept = []
    for number, part in enumerate(parts):
        for newer in parts[number + 1:]:
            part = part.join(newer.select("order_id"), "order_id", "left_anti")
        kept.append(part)
    return reduce(DataFrame.unionByName, kept)
