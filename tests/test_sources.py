"""Options of connectors that are not part of the image."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark import fixtures as X
from tidemark.plans.refresh import RefreshStopped, refresh_dimension
from tidemark.sources.snapshots import SnapshotStore
from tidemark.sources import topics
from tidemark.sources.database import JdbcSource


def test_topic_options():
    options = topics.kafka_read_options("broker:9092", cfg=C.PipelineConfig(max_offsets_per_trigger=5))
    assert options["subscribe"] == "orders_stream"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "5"
    assert topics.kafka_write_options("broker:9092") == {
        "kafka.bootstrap.servers": "broker:9092", "topic": "orders_stream_dlt",
        "kafka.producer.acks": "all",
    }


def test_database_options():
    source = JdbcSource("jdbc:postgresql://host/db", "user", "secret", partitions=4)
    split = source.split_options(1, 1000)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"],
            split["numPartitions"]) == ("customer_id", "1", "1000", "4")
    assert "partitionColumn" not in source.split_options(None, None)
    assert source.query_options(source.baseline_query())["query"] == (
        "SELECT COUNT(*) AS row_count, MAX(updated_at) AS max_updated_at FROM customers")


def test_the_gate_sees_what_the_database_sent(spark, sf_dir, tmp_path):
    """The connector alone is replaced: absent columns and bad ids arrive as they are."""
    sent = X.source_customers(spark, sf_dir).withColumn("customer_id", F.concat(F.lit("x"), "customer_id")).drop("city")
    asked = []

    def reader(options):
        asked.append(options)
        return sent if "dbtable" in options else sent.selectExpr("1 AS low", "9 AS high")

    source = JdbcSource("jdbc:postgresql://host/db", "user", "secret")
    rows = source.read(spark, reader)
    assert rows.columns == sent.columns and asked[1]["upperBound"] == "9"
    with pytest.raises(RefreshStopped, match="customer_id_numeric, .*required_columns_present"):
        refresh_dimension(rows, None, SnapshotStore(spark, str(tmp_path)), X.RULES, datetime(2001, 8, 2))


def test_topic_range_options():
    begin, end = datetime(2024, 1, 10), datetime(2024, 1, 11, tzinfo=timezone.utc)
    options = topics.kafka_range_options("broker:9092", "orders_stream", begin, end)
    assert (options["startingTimestamp"], options["endingTimestamp"]) == (
        "1704844800000", "1704931200000")
