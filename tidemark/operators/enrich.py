"""Joining orders with the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import contract as C
from tidemark.operators.events import POSITION


def enrichment_columns(dimension: DataFrame) -> DataFrame:
    """The served attributes of a dimension; times without a zone become text."""
    served_fields = [f for f in dimension.schema if f.name in C.DIMENSION_COLUMNS]
    if C.DIMENSION_KEY not in {f.name for f in served_fields}:
        raise KeyError(f"orders cannot be matched without {C.DIMENSION_KEY}")
    as_text = (T.TimestampNTZType,)
    return dimension.selectExpr(*[
        f"CAST({f.name} AS STRING) AS {f.name}" if isinstance(f.dataType, as_text) else f.name
        for f in sorted(served_fields, key=lambda f: C.DIMENSION_COLUMNS.index(f.name))])


def join_dimension(
    orders: DataFrame, dimension: DataFrame, dimension_bytes: int | None,
    limit_bytes: int, condition: Column | None = None, key: str = "customer_id",
) -> DataFrame:
    """Left join that keeps every order.

    A dimension of a known size within the limit is broadcast. Otherwise both sides are
    shuffled and merged, and heavy keys are split: their orders are dealt out by message
    position and their few dimension rows are repeated. A key is heavy if it holds more
    than the fair share of one task, so there are fewer of them than tasks.
    """
    if dimension_bytes is not None and dimension_bytes <= limit_bytes:
        return _left_join(orders, F.broadcast(dimension), [key], condition)
    parts = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = orders.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    heavy = (
        counts.join(F.broadcast(total), F.col("_n") * parts > F.col("_total"))
        .select(F.col(key), F.lit(True).alias("_heavy"))
    )
    spread = F.col("_heavy") | F.col(key).isNull()
    dealt = orders.join(F.broadcast(heavy), key, "left").withColumn(
        "_part", F.when(spread, F.pmod(F.xxhash64(*POSITION), F.lit(parts))).otherwise(0),
    )
    last = F.when(F.col("_heavy"), parts - 1).otherwise(0).cast("bigint")
    repeated = dimension.join(F.broadcast(heavy), key, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("bigint"), last)),
    )
    return _left_join(
        dealt.drop("_heavy"), repeated.drop("_heavy").hint("merge"), [key, "_part"], condition).drop("_part")


def _left_join(
    orders: DataFrame, dimension: DataFrame, keys: list[str], condition: Column | None,
) -> DataFrame:
    if condition is None:
        return orders.join(dimension, keys, "left")
    right = dimension.withColumnsRenamed({k: f"{k}_right" for k in keys})
    if "_part" in keys:
        right = right.hint("merge")
    for k in keys:
        condition = condition & (F.col(k) == F.col(f"{k}_right"))
    return orders.join(right, condition, "left").drop(*[f"{k}_right" for k in keys])


def state_rows(changes: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Changes as rows of the state table; deletes carry no attributes."""
    return changes.select(*[
        F.col(f.name).cast(f.dataType) for f in C.with_id_type(C.ORDER_STATE, cfg)])


def served(state: DataFrame) -> DataFrame:
    """The published contract: live orders, twelve columns, keyed by ``_id``."""
    return (
        state.filter(F.col("op") != C.DELETE)
        .select(F.col("order_id").alias("_id"), *C.SERVED_COLUMNS[1:])
    )
