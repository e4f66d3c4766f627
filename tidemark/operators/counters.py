"""Counters that have to add up to the input."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators.versions import guard, latest_per_order


def op_mix(changes: DataFrame) -> DataFrame:
    return changes.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


def batch_counters(judged: DataFrame, guarded: DataFrame, *keys: str) -> DataFrame:
    """One counters row per batch (per distinct value of ``keys``).

    Both inputs are reduced to a handful of rows before they meet.
    """
    per_event = judged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("stage") == C.INVALID).alias("invalid"),
        F.count_if(F.col("stage") == C.LATE).alias("late"),
        F.count_if(F.col("stage") == C.FRESH).alias("accepted"),
    )
    kept = F.col("outcome") != C.STALE
    removed = F.col("outcome") == C.REMOVE
    per_order = guarded.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("winners"),
        F.count_if(~kept).alias("stale"),
        F.count_if(F.col("outcome") == C.UPSERT).alias("upserts"),
        F.count_if(removed).alias("deletes"),
        F.count_if(removed & (F.col("stored_op") != C.DELETE)).alias("deletes_effective"),
        F.count_if(kept & (F.col("op") == "I")).alias("inserts"),
        F.count_if(kept & (F.col("op") == "U")).alias("updates"),
        F.count_if(kept & ~F.col("op").isin(*C.OPS)).alias("unknown_ops"),
    )
    # Stacked rather than joined: each side fills its own columns of a batch.
    stacked = per_event.unionByName(per_order, allowMissingColumns=True)
    names = [c for c in stacked.columns if c not in keys]
    both = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names]).fillna(0, names)
    total = sum(F.col(c) for c in ("invalid", "late", "superseded", "stale", "upserts", "deletes"))
    return (
        both.withColumn("superseded", F.col("accepted") - F.col("winners")).drop("winners")
        .withColumn("reconciles", total == F.col("processed"))
    )


def sequence_outcomes(fresh: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Winners of many batches, labelled as if applied one after the other.

    With tombstones a winner is stale exactly if an earlier batch held the same
    or a newer version, so the whole sequence is one window over the winners:
    at most one row per order and batch.
    """
    earlier = (
        Window.partitionBy("order_id").orderBy(batch)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return guard(
        latest_per_order(fresh, batch)
        .withColumn("stored_lsn", F.max("lsn").over(earlier))
        .withColumn("stored_op", F.max_by("op", "lsn").over(earlier))
    )


def counter_trend(metrics: DataFrame, batches: int = 5) -> DataFrame:
    """Share of superseded and stale events, averaged over the last batches of a run.

    Every row is sent to the ``batches`` batch ids whose average it belongs to,
    so the trend is a grouped aggregate and not one global sort.
    """
    runs = [c for c in ("run_id",) if c in metrics.columns]
    share = metrics.filter(F.col("processed") > 0).select(
        *runs, "batch_id",
        (F.col("superseded") / F.col("processed")).alias("superseded_share"),
        (F.col("stale") / F.col("processed")).alias("stale_share"),
    )
    ahead = F.explode(F.sequence(F.lit(0), F.lit(batches - 1)))
    trend = (
        share.withColumn("_ahead", ahead)
        .groupBy(*runs, (F.col("batch_id") + F.col("_ahead")).alias("batch_id"))
        .agg(
            F.avg("superseded_share").alias("superseded_trend"),
            F.avg("stale_share").alias("stale_trend"),
        )
    )
    return share.join(trend, [*runs, "batch_id"])


def partition_lag(offsets: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Messages waiting per topic partition; nothing committed means all of them."""
    return offsets.select(
        "topic", "partition", "end_offset", "committed_offset",
        F.coalesce(
            F.col("end_offset") - F.col("committed_offset"), F.col("end_offset"),
        ).alias("lag"),
    )


def total_lag(lag: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Lag per topic, flagged when the stream cannot keep up."""
    limit = cfg.max_offsets_per_trigger * cfg.lag_warn_factor
    return (
        lag.groupBy("topic").agg(F.sum("lag").alias("total_lag"))
        .withColumn("over_threshold", F.col("total_lag") > limit)
    )


def sink_audit(facts: DataFrame) -> DataFrame:
    """One row: a served table is sound if it holds each order once."""
    per_order = facts.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("name").isNull()).alias("unmatched"),
    )
    return per_order.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.count("order_id").alias("distinct_orders"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("order_id")).alias("duplicates"),
        F.coalesce(F.sum("unmatched"), F.lit(0)).alias("enrichment_nulls"),
    ).withColumn("sound", F.col("duplicates") == 0)
