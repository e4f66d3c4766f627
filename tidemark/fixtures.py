"""Test inputs derived from the given tables.

The feed plays ``events`` back as order messages, with fixed shares of broken
and late payloads; the dimension is ``customer`` with its nation and the dates
of its orders. Every row of the tables takes part.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.safe import instant

FEED_TOPIC = C.ORDERS_TOPIC
CATEGORIES = ("Electronics", "Grocery", "Apparel", "Home")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
QUALITY_CLOCK = datetime(2001, 8, 2)
FIRST_DAY = datetime(1992, 1, 1)
CORRUPT_UNTIL = datetime(2001, 7, 25)
SECOND_VERSION_AT = datetime(2024, 1, 16)
RULES = C.QualityRules(allowed=SEGMENTS)


# Given, so that opening a table does not run a job to find its schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


_ISO = "yyyy-MM-dd\'T\'HH:mm:ss.SSSSSS\'+00:00\'"


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as messages of the order topic (key, value, position, time)."""
    def payload(customer_id: str, amount: str) -> str:
        return f"""to_json(named_struct('op', {sent('op', "CASE WHEN event_id % 50 = 17 THEN 'X' ELSE op END")},
            'order_id', {sent('order_id')},
            'customer_id', {sent('customer_id', customer_id)}, 'amount', {sent('amount', amount)},
            'product_category', {sent('product_category', "CASE WHEN event_id % 50 = 33 THEN '9-volt!' ELSE product_category END")},
            'event_time', event_time, 'lsn', {sent('lsn', 'event_id')}))"""

    def sent(field: str, value: str | None = None) -> str:
        """One event in fifty lacks one of the required fields, each in turn."""
        turn = C.REQUIRED_EVENT_FIELDS.index(field)
        return f"CASE WHEN event_id % 50 = 3 AND event_id DIV 50 % 6 = {turn} THEN NULL ELSE {value or field} END"

    number = "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT)"
    categories = ", ".join(f"'{c}'" for c in CATEGORIES)
    return (
        table(spark, sf_dir, "events").selectExpr(
            "event_id", "ts", "user_id", "value AS amount",
            "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op",
            f"concat('o', user_id * 10 + {number} % 10) AS order_id",
            f"array({categories})[CAST({number} % {len(CATEGORIES)} AS INT)] AS product_category",
            f"""CASE WHEN event_id % 50 = 41 THEN 'nope' ELSE date_format(
                CASE WHEN event_id % 50 = 29 THEN ts - INTERVAL 2 HOURS ELSE ts END,
                "{_ISO}") END AS event_time""",
        )
        .selectExpr(
            "CAST(order_id AS BINARY) AS key",
            f"""CAST(CASE
                WHEN event_id % 50 = 0 THEN '{{"op":"I","order_id":"truncated-'
                WHEN event_id % 20 = 7 THEN {payload("'NOT_A_NUMBER'", "'bad_data'")}
                WHEN event_id % 50 = 23 THEN {payload("user_id", "'12,5'")}
                ELSE {payload(
                    "CASE WHEN event_id % 100 = 61 THEN 99999999999 ELSE user_id END",
                    "CASE event_id % 50 WHEN 13 THEN -amount WHEN 31 THEN amount + 1e7D ELSE amount END")}
                END AS BINARY) AS value""",
            f"'{FEED_TOPIC}' AS topic", "CAST(event_id % 3 AS INT) AS partition",
            "event_id AS offset", "CAST(ts AS TIMESTAMP) AS timestamp",
        )
    )


def first_part(messages: DataFrame) -> DataFrame:
    """Batch A of an out-of-order delivery: two partitions of three."""
    return messages.filter(F.col("partition") != 1)


def second_part(messages: DataFrame) -> DataFrame:
    """Batch B: the partition that arrives after A, old versions included."""
    return messages.filter(F.col("partition") == 1)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment dimension: every customer with city and segment."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("city"))
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").cast("int").alias("customer_id"), F.col("c_name").alias("name"),
            "city", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        )
    )


def solvent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with gaps: customers in debt are missing."""
    return customers(spark, sf_dir).filter(F.col("balance") >= 0)


def source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``customers`` source table of the dimension refresh.

    Ids are shifted by one, because the first key, 0, is not a valid id there.
    """
    dates = (
        table(spark, sf_dir, "orders").groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("signup_date"), F.max("o_orderdate").alias("updated_at"))
    )
    return (
        customers(spark, sf_dir)
        .join(dates, F.col("customer_id") == F.col("o_custkey"), "left")
        .select(
            (F.col("customer_id") + 1).alias("customer_id"), "name", "city", "segment",
            F.col("signup_date").cast("timestamp").alias("signup_date"),
            F.col("updated_at").cast("timestamp").alias("updated_at"),
        )
    )


def dated_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source where a customer who never ordered signed up on the first day."""
    first = F.lit(FIRST_DAY.isoformat()).cast("timestamp")
    return source_customers(spark, sf_dir).withColumns(
        {c: F.coalesce(c, first) for c in ("signup_date", "updated_at")})


def corrupt_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source with one kind of damage per check of the quality gate.

    The newest changes are missing, as in a snapshot that was taken too early, and some
    customers are in it twice.
    """
    key = F.col("customer_id")
    day = F.date_format("signup_date", "yyyy-MM-dd")
    copies = F.when(key % 200 == 13, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        dated_customers(spark, sf_dir).withColumn("copy", F.explode(copies))
        .select(
            F.when(key % 50 == 3, "abc").when(key % 50 == 7, (-key).cast("string"))
            .when(key % 50 == 11, "1").otherwise(key.cast("string")).alias("id"),
            F.when(key % 40 == 1, F.lit(None)).when(key % 40 == 2, "   ")
            .otherwise(F.col("name")).alias("name"),
            "city",
            F.when(key % 30 == 5, "Platinum").otherwise(F.col("segment")).alias("segment"),
            F.when(key % 60 == 9, "not-a-date").when(key % 60 == 10, "2030-01-01")
            .otherwise(day).alias("signup_date"),
            F.least("updated_at", instant(CORRUPT_UNTIL)).alias("updated_at"),
        )
        .withColumnRenamed("id", "customer_id")
    )


def second_version(dimension: DataFrame, changed_at: Column) -> DataFrame:
    """The same customers after one in ten has moved to the next segment."""
    after = F.create_map(*[
        F.lit(s) for pair in zip(SEGMENTS, SEGMENTS[1:] + SEGMENTS[:1]) for s in pair
    ])
    return dimension.withColumn(
        "segment",
        F.when(F.col("customer_id") % 10 == 0, after[F.col("segment")])
        .otherwise(F.col("segment")),
    ).withColumn("updated_at", changed_at)


def topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End and committed offsets of a consumer that stopped in mid January.

    The last partition has nothing committed.
    """
    read = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    partition = (F.col("event_id") % 3).cast("int")
    return (
        table(spark, sf_dir, "events").groupBy(partition.alias("partition"))
        .agg(F.count(F.lit(1)).alias("end_offset"), F.count_if(read).alias("read"))
        .select(
            F.lit(FEED_TOPIC).alias("topic"), "partition", "end_offset",
            F.when(F.col("partition") != 2, F.col("read")).alias("committed_offset"),
        )
    )
