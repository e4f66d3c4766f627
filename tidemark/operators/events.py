"""From raw messages to judged order events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.safe import instant
from tidemark.functions.verdict import age_seconds, broken_rule

POSITION = ("partition", "offset")
EVENT_FIELDS = tuple(f.name for f in C.ORDER_EVENT)


def parse(messages: DataFrame) -> DataFrame:
    """Decode the JSON payload and keep its raw text beside the fields.

    A payload that is not an object leaves every field NULL. The position
    (partition, offset) stays on the row as its identity. The fields come out
    of a generator, since a filter on them would otherwise be moved below the
    parsing and repeat it.
    """
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in C.ORDER_EVENT)
    fields = ", ".join(
        f"{'try_to_timestamp(e.event_time)' if f == 'event_time' else 'e.' + f} AS {f}"
        for f in EVENT_FIELDS
    )
    return (
        messages.selectExpr(
            *POSITION, "timestamp AS arrived_at", "CAST(value AS STRING) AS json_str")
        .selectExpr("*", f"""inline(transform(
            array(from_json(json_str, '{schema}')), e -> struct({fields})))""")
    )


def judge(parsed: DataFrame, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Add ``rule`` (first broken one), ``age_s`` and ``stage`` to every event.

    They come out of a generator for the same reason as the fields: a filter on the stage
    would otherwise evaluate the rules twice.
    """
    def verdict(found):
        stage = (
            F.when(found["rule"].isNotNull(), C.INVALID)
            .when(found["age_s"] > cfg.allowed_lateness_s, C.LATE).otherwise(C.FRESH)
        )
        return F.struct(found["rule"].alias("rule"), found["age_s"].alias("age_s"), stage.alias("stage"))

    found = F.array(F.struct(broken_rule(cfg).alias("rule"), age_seconds(cfg).alias("age_s")))
    return parsed.select("*", F.inline(F.transform(found, verdict)))


def raw_of_rejects(judged: DataFrame) -> DataFrame:
    """Drop the raw text where it is not needed any more, before events are kept."""
    raw = F.when(F.col("stage") != C.FRESH, F.col("json_str"))
    return judged.withColumn("json_str", raw)


def typed(judged: DataFrame, ingested_at=None, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Valid events with their served types and the ingestion clock."""
    clock = F.current_timestamp() if ingested_at is None else instant(ingested_at)
    return judged.filter(F.col("stage") != C.INVALID).select(
        *POSITION, "arrived_at", "stage", "age_s", "op", "order_id",
        F.expr(f"try_cast(customer_id AS {cfg.customer_id_type}) AS customer_id"),
        F.expr("try_cast(amount AS DOUBLE) AS amount"),
        "product_category", "event_time", "lsn", clock.alias("ingested_at"),
    )


def fresh(judged: DataFrame, ingested_at=None, cfg: C.PipelineConfig = C.PipelineConfig()) -> DataFrame:
    """Typed events young enough to be applied."""
    return typed(judged, ingested_at, cfg).filter(F.col("stage") == C.FRESH).drop("stage", "age_s")


def rejected(judged: DataFrame, rejected_at=None) -> DataFrame:
    """Invalid and late events, raw fields included, with their reason."""
    clock = F.current_timestamp() if rejected_at is None else instant(rejected_at)
    return judged.filter(F.col("stage") != C.FRESH).select(
        *POSITION, "arrived_at", "json_str", *EVENT_FIELDS, "rule",
        clock.alias("rejected_at"),
        F.when(F.col("stage") == C.LATE, C.REASON_LATE)
        .otherwise(C.REASON_INVALID).alias("reject_reason"),
    )


def invalid_by_rule(judged: DataFrame) -> DataFrame:
    return (
        judged.filter(F.col("stage") == C.INVALID)
        .groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    )
