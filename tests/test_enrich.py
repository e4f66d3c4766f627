import random
from datetime import datetime, timedelta

import pytest
from helpers import dimension
from pyspark.sql import functions as F

from tidemark import fixtures as X
from tidemark.operators import enrich, events, history
from tidemark.plans.batch import apply_batch

ORDER = "order_id string, customer_id int, `partition` int, `offset` bigint"


def test_missing_key_is_an_error(spark):
    with pytest.raises(KeyError, match="customer_id"):
        enrich.enrichment_columns(dimension(spark).drop("customer_id"))


def test_only_served_columns_are_kept(spark):
    frame = dimension(spark).drop("city").withColumn("signup_date", F.current_date())
    assert enrich.enrichment_columns(frame).columns == ["customer_id", "name", "segment"]


def test_naive_timestamps_become_text(spark):
    frame = dimension(spark).withColumn("city", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert dict(enrich.enrichment_columns(frame).dtypes)["city"] == "string"


def test_both_joins_agree_with_a_hot_customer_and_nulls(spark):
    rows = [(f"o{i}", 1 if i % 3 == 0 else (None if i % 7 == 0 else i % 12), i % 3, i)
            for i in range(600)]
    orders = spark.createDataFrame(rows, ORDER)
    frame = dimension(spark, 8)
    small = enrich.join_dimension(orders, frame, 1000, 10_000)
    large = enrich.join_dimension(orders, frame, 100_000, 10_000)
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert small.count() == 600


def test_every_key_above_its_share_is_split(spark):
    """More hot customers than a fixed number of them, beside rare ones."""
    rows = [(f"o{i}", i % 3 + 1 if i < 300 else 10 + i, i % 3, i) for i in range(400)]
    joined = enrich.join_dimension(
        spark.createDataFrame(rows, ORDER), dimension(spark, 4), None, 0).collect()
    assert len(joined) == 400
    assert all((r.name == f"name {r.customer_id}") == (r.customer_id <= 4) for r in joined)


@pytest.mark.parametrize("sf, missing", [("0.001", 185), ("0.01", 1190)])
def test_unmatched_events_of_a_dimension_with_gaps(spark, sf, missing):
    sf_dir = f"/root/testdata/sf{sf}"
    gaps = X.customers(spark, sf_dir).filter(F.col("customer_id") % 7 != 0)
    fresh = events.fresh(events.judge(events.parse(X.order_messages(spark, sf_dir))))
    joined = enrich.join_dimension(fresh, enrich.enrichment_columns(gaps), 1, 1)
    assert joined.filter("name IS NULL").count() == missing


def test_served_contract(spark, sf_dir):
    batch = apply_batch(X.order_messages(spark, sf_dir))
    dim = enrich.enrichment_columns(X.customers(spark, sf_dir))
    facts = enrich.served(enrich.state_rows(enrich.join_dimension(batch.effective(), dim, 1, 1)))
    assert facts.columns == [
        "_id", "order_id", "op", "customer_id", "amount", "product_category",
        "event_time", "lsn", "ingested_at", "name", "city", "segment"]
    assert dict(facts.dtypes)["customer_id"] == "int"


def test_history_joins_unchanged_snapshots_and_ranges(spark):
    rows = [(1, "n", "c", s, f"2024-01-0{d} 00:00:00") for d, s in enumerate("AABA", start=1)]
    versions = spark.createDataFrame(
        rows, "customer_id int, name string, city string, segment string, t string",
    ).select("customer_id", "name", "city", "segment", F.col("t").cast("timestamp").alias("updated_at"))
    ranges = history.type2_history(versions).orderBy("valid_from").collect()
    assert [(r.segment, r.valid_from.day, r.valid_to and r.valid_to.day, r.is_current)
            for r in ranges] == [("A", 1, 3, False), ("B", 3, 4, False), ("A", 4, None, True)]


def test_ties_and_vanished_customers_in_the_history(spark):
    columns = "customer_id int, name string, city string, segment string"
    tied = spark.createDataFrame(
        [(1, "n", "c", "A"), (1, "n", "c", "B")], columns).withColumn("updated_at", F.lit("2024-01-01").cast("timestamp"))
    (only,) = history.type2_history(tied).collect()
    assert only.is_current and only.segment == "B"

    def day(n):
        return F.lit(f"2024-01-0{n}").cast("timestamp")

    first = spark.createDataFrame([(1, "n", "c", "A"), (2, "n", "c", "A"), (3, "n", "c", None)], columns)
    second = spark.createDataFrame([(1, "n", "c", "B"), (3, "n", "c", None)], columns)
    ranges = history.advance(history.advance(history.advance(None, first, day(1)), second, day(2)), first, day(3))
    assert sorted((r.customer_id, r.segment or "", r.valid_from.day, r.valid_to.day if r.valid_to else None)
                  for r in ranges.collect()) == [
        (1, "A", 1, 2), (1, "A", 3, None), (1, "B", 2, 3), (2, "A", 1, 2), (2, "A", 3, None), (3, "", 1, None)]


def test_sorted_as_of_equals_every_range_against_every_order(spark):
    """Also with one customer as most of the orders, whose time is then split."""
    draw = random.Random(6)
    start = datetime(2024, 1, 1)

    def at(minutes):
        return start + timedelta(minutes=minutes)

    ranges = []
    for customer in range(8):
        cuts = sorted(draw.sample(range(0, 3000), draw.randint(1, 40)))
        for a, b in zip(cuts, cuts[1:] + [None]):
            if draw.random() < 0.8:
                ranges.append((customer, f"s{a}", at(a), None if b is None else at(b)))
    orders = [(k % 3, k, draw.choice([1, 1, 1, 1, 2, 3, 99, None]),
               None if k % 50 == 7 else at(draw.randint(-50, 3100))) for k in range(900)]
    history_rows = spark.createDataFrame(
        ranges, "customer_id int, segment string, valid_from timestamp, valid_to timestamp")
    frame = spark.createDataFrame(orders, "partition int, offset long, customer_id int, event_time timestamp")
    got = {r.offset: r.segment for r in history.sorted_as_of(frame, history_rows, F.col("event_time")).collect()}
    want = {}
    for _, offset, customer, when in orders:
        valid = [s for c, s, a, b in ranges if when is not None and c == customer and a <= when and (b is None or when < b)]
        want[offset] = valid[0] if valid else None
    assert got == want and len(orders) == len(got)
