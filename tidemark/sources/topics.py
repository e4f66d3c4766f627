"""Order topic and dead-letter topic, or their file twins.

The broker connector is a package that is given to the session at start-up
(``spark.jars.packages``); nothing here needs it to be present.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.safe import instant


def kafka_read_options(
    servers: str, topic: str = C.ORDERS_TOPIC, group: str | None = None,
    cfg: C.PipelineConfig = C.PipelineConfig(),
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(cfg.max_offsets_per_trigger),
        **({"kafka.group.id": group} if group else {}),
    }


def kafka_write_options(servers: str, topic: str = C.DEAD_LETTER_TOPIC) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers, "topic": topic, "kafka.producer.acks": "all",
    }


def kafka_stream(spark: SparkSession, servers: str, **kwargs) -> DataFrame:
    """Order messages as a stream; columns as in ``contract.MESSAGE``."""
    options = kafka_read_options(servers, **kwargs)
    return _message_columns(spark.readStream.format("kafka").options(**options).load())


def kafka_range_options(
    servers: str, topic: str, begin: datetime, end: datetime,
) -> dict[str, str]:
    """Times apply to every partition; a partition without later messages adds none."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingTimestamp": _millis(begin),
        "endingTimestamp": _millis(end),
        "startingOffsetsByTimestampStrategy": "latest",
        "failOnDataLoss": "false",
    }


def kafka_range(
    spark: SparkSession, servers: str, topic: str, begin: datetime, end: datetime,
) -> DataFrame:
    """A bounded range of a topic, for a backfill."""
    options = kafka_range_options(servers, topic, begin, end)
    return _message_columns(spark.read.format("kafka").options(**options).load())


def write_kafka(letters: DataFrame, servers: str, topic: str = C.DEAD_LETTER_TOPIC) -> None:
    """Publish dead letters; writing none is harmless."""
    options = kafka_write_options(servers, topic)
    letters.select("key", "value").write.format("kafka").options(**options).save()


def file_stream(
    spark: SparkSession, folder: str, max_files: int | None = None,
) -> DataFrame:
    """The same messages from Parquet files dropped into a folder."""
    reader = spark.readStream.schema(C.MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def arrived_between(messages: DataFrame, begin: datetime, end: datetime) -> DataFrame:
    """Messages that arrived in [begin, end); naive times are UTC."""
    arrived = F.col("timestamp")
    return messages.filter((arrived >= instant(begin)) & (arrived < instant(end)))


def _millis(moment: datetime) -> str:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return str(int(moment.timestamp() * 1000))


def _message_columns(messages: DataFrame) -> DataFrame:
    return messages.select(*C.MESSAGE.fieldNames())
