"""Revenue by window of event time as a running result, corrected as orders change.

Every change that is applied takes back what its order was counted for and adds what it
is worth now. How old an order may be when it is corrected is not limited, so the state
of its window cannot be kept until then. It need not be: totals are kept by *epoch*, the
stretch of time in which changes were applied. That time never goes back, so a watermark
on it closes an epoch, evicts its state and drops nothing; a later correction is part of
a later epoch. Revenue is the sum of a window's totals over the epochs.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import contract as C
from tidemark.functions.safe import instant

TOTALS = ("epoch timestamp, window_start timestamp, segment string, city string, revenue double, "
          "orders bigint, batch_id bigint")
KEY = ("epoch", "window_start", "segment", "city")


def deltas(labelled: DataFrame) -> DataFrame:
    """What applied changes add to the revenue of a time, and what they take back."""
    back = F.struct(
        *[F.col(f"old_{c}").alias(c) for c in ("event_time", "segment", "city")],
        (-F.col("old_amount")).alias("amount"), F.lit(-1).cast("bigint").alias("orders"))
    add = F.struct(
        "event_time", "segment", "city", F.expr("try_cast(amount AS DOUBLE)").alias("amount"),
        F.lit(1).cast("bigint").alias("orders"))
    parts = F.array(
        F.when(F.col("old_event_time").isNotNull(), back),
        F.when(F.col("outcome") == C.UPSERT, add))
    return (
        labelled.filter(F.col("outcome").isin(C.UPSERT, C.REMOVE))
        .select("applied_at", F.explode(F.array_compact(parts)).alias("part"))
        .select("applied_at", "part.*")
    )


def epoch_totals(changed: DataFrame, width: timedelta = timedelta(minutes=15), epoch: str = "1 hour",
                 delay: str = "10 minutes") -> DataFrame:
    """Totals of the windows that changes touched, by the epoch in which they did.

    ``delay`` is how much the files of one batch may come behind those of a later one.
    """
    micros, step = F.unix_micros("event_time"), F.lit(width // timedelta(microseconds=1))
    return (
        changed.withColumn("window_start", F.timestamp_micros(micros - F.pmod(micros, step)))
        .withWatermark("applied_at", delay)
        .groupBy(F.window("applied_at", epoch).alias("e"), "window_start", "segment", "city")
        .agg(F.sum("amount").alias("revenue"), F.sum("orders").alias("orders"))
        .select(F.col("e.start").alias("epoch"), "window_start", "segment", "city", "revenue", "orders")
    )


def write_totals(totals: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Touched totals of every batch; a batch that is repeated replaces what it wrote."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        totals.writeStream.foreachBatch(handle).outputMode("update")
        .option("checkpointLocation", checkpoint)
    )


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOTALS).parquet(path)


def revenue(totals: DataFrame) -> DataFrame:
    """Revenue of each window, segment and city as of the last batch."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("batch_id").desc())
    return (
        totals.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1)
        .groupBy("window_start", "segment", "city")
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
        .filter(F.col("orders") != 0)
    )


def revenue_since(totals: DataFrame, now: datetime, back: timedelta = timedelta(minutes=15)) -> DataFrame:
    """Revenue by segment and city of the windows that began in the time just before ``now``.

    Only those windows are read of the totals.
    """
    recent = (F.col("window_start") >= instant(now - back)) & (F.col("window_start") < instant(now))
    return (
        revenue(totals.filter(recent)).groupBy("segment", "city")
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )
