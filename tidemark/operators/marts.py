"""Reports over the served orders."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.safe import instant


def revenue_by_window(facts: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Revenue per segment and city in fixed windows of event time."""
    return (
        facts.groupBy(F.window("event_time", width).alias("w"), "segment", "city")
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
        .select(F.col("w.start").alias("window_start"), "segment", "city", "revenue", "orders")
    )


def revenue_trailing(
    facts: DataFrame, now: datetime, back: timedelta = timedelta(minutes=15),
) -> DataFrame:
    """Revenue per segment and city over the time just before ``now``."""
    recent = (F.col("event_time") > instant(now - back)) & (F.col("event_time") <= instant(now))
    return (
        facts.filter(recent).groupBy("segment", "city")
        .agg(F.sum("amount").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


def peek(facts: DataFrame, n: int = 5) -> DataFrame:
    """The first few served orders."""
    return facts.orderBy("_id").limit(n)
