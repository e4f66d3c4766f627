"""Properties of the physical plans that have to hold at scale."""

import re
from datetime import datetime

import pytest
from helpers import dimension, event, messages

from tidemark import contract as C
from tidemark import fixtures as X
from tidemark.operators import enrich, events, marts, versions
from tidemark.plans.batch import OrderPipeline, apply_batch


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def feed(spark, sf_dir, tmp_path):
    X.order_messages(spark, sf_dir).write.parquet(f"{tmp_path}/feed")
    return spark.read.schema(C.MESSAGE).parquet(f"{tmp_path}/feed")


def test_payload_is_parsed_once(feed):
    assert plan(events.fresh(events.judge(events.parse(feed)))).count("from_json") == 1


def test_rules_are_evaluated_once(feed):
    judged = events.judge(events.parse(feed))
    assert plan(events.rejected(judged)).count("RLIKE") == 3
    assert plan(events.fresh(judged)).count("RLIKE") == 3


def test_unused_message_columns_are_not_read(feed):
    text = plan(events.fresh(events.judge(events.parse(feed))))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "topic" not in schema and "key" not in schema


def test_orders_are_reduced_before_the_shuffle(feed):
    text = plan(versions.latest_per_order(events.fresh(events.judge(events.parse(feed)))))
    assert text.count("WindowGroupLimit") == 2
    assert text.count("Exchange hashpartitioning") == 1
    exchange = text.index("Exchange hashpartitioning")
    assert "Partial" in text[exchange:] and "Final" in text[:exchange]


def test_arrival_range_reaches_the_scan(spark, feed):
    from tidemark.sources.topics import arrived_between

    text = plan(arrived_between(feed, datetime(2024, 1, 10), datetime(2024, 1, 20)))
    assert "GreaterThanOrEqual(timestamp" in text and "LessThan(timestamp" in text


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, feed):
    orders = apply_batch(feed).effective()
    big = spark.range(10**6).selectExpr(
        "CAST(id AS INT) AS customer_id", "'n' AS name", "'c' AS city", "'s' AS segment")
    assert "BroadcastHashJoin" in plan(enrich.join_dimension(orders, big, 10, 100))
    text = plan(enrich.join_dimension(orders, big, 1000, 100))
    assert re.search(r"SortMergeJoin \[customer_id#\d+, _part#\d+L\]", text)
    assert "CartesianProduct" not in text


def test_outcomes_read_the_feed_once(spark, feed):
    judged = events.judge(events.parse(feed))
    stored = spark.range(9).selectExpr("CAST(id AS STRING) AS order_id", "id AS stored_lsn", "'U' AS stored_op")
    for text in (plan(versions.label(judged)), plan(versions.label(judged, stored.hint("merge")))):
        assert text.count("FileScan") == 1 and text.count("from_json") == 1
        # The second exchange of the events serves the ranking and the join.
        assert text.count("Exchange hashpartitioning(_group#") == text.count("SortMergeJoin") + 2


def test_shuffled_enrichment_shuffles(spark, sf_dir):
    from tidemark.queries import QUERIES

    frame = QUERIES["enrich_orders_shuffled"](spark, sf_dir)
    frame.collect()
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[customer_id#\d+, _part", plan(frame))


def test_orders_and_ranges_meet_in_one_sort(spark, sf_dir):
    """No join tests the ranges of a customer against each of the orders."""
    from tidemark.queries import QUERIES

    text = plan(QUERIES["enrich_as_of_shuffled"](spark, sf_dir))
    assert re.search(r"Exchange hashpartitioning\(_key#\d+, _part", text)
    assert "valid_from" not in " ".join(line for line in text.splitlines() if "Join" in line)


def above(text: str, scan: str) -> list[str]:
    """Operators between a scan and the join that reads it, in the text of a plan."""
    lines = text.splitlines()
    (at,) = [i for i, line in enumerate(lines) if scan in line]
    depth, out = len(lines[at]) - len(lines[at].lstrip(" :+-*")), []
    for line in reversed(lines[:at]):
        here = len(line) - len(line.lstrip(" :+-*"))
        if here < depth:
            depth = here
            out.append(line.strip(" :+-*"))
            if "Join" in line:
                break
    return out


@pytest.mark.parametrize("limit, join", [(10**6, "BroadcastHashJoin"), (0, "ShuffledHashJoin")])
def test_the_guard_neither_sorts_nor_shuffles_the_base(spark, tmp_path, limit, join):
    frame = dimension(spark)
    cfg = C.PipelineConfig(state_buckets=4, broadcast_limit_bytes=limit, prune_keys=1)
    job = OrderPipeline(spark, str(tmp_path), lambda: (frame, 100), cfg)
    job.apply(messages(spark, [event("a", 1), event("b", 2), event("c", 2)]), 0, "run")
    job.state.compact()
    winners = spark.createDataFrame([("a", 4), ("z", 1)], "order_id string, lsn long").repartition(3)
    guard = job.state.attach(winners, job.state.manifest())
    text = plan(guard)
    operators = above(text, "FileScan parquet spark_catalog")
    assert join in operators[-1], text
    assert not any(o.startswith(("Sort", "Exchange")) for o in operators), text
    columns = re.findall(r"spark_catalog\.default\.tidemark_\w+\[([^\]]*)\]", text)
    assert {re.sub(r"#\d+L?", "", c) for c in columns} == {"order_id,op,lsn"}
    assert sorted((r.order_id, r.stored_lsn) for r in guard.collect()) == [("a", 1), ("z", None)]


@pytest.mark.parametrize("keys", [2, 9, 30, 31])
def test_the_guard_reads_the_buckets_of_the_batch(spark, tmp_path, keys):
    """By the metric of the scan: rows of the buckets that it has opened."""
    frame = dimension(spark)
    job = OrderPipeline(spark, str(tmp_path), lambda: (frame, 100), C.PipelineConfig(state_buckets=64, prune_keys=30))
    job.apply(messages(spark, [event(f"o{k}", k + 1) for k in range(600)]), 0, "run")
    job.state.compact()
    batch = [(f"o{17 * k}", 10**6) for k in range(keys - 1)] + [("new", 1)]
    winners = spark.createDataFrame(batch, "order_id string, lsn long")
    found = job.state._stored(
        job.state.base(job.state.manifest()["base"]).select("order_id", "lsn", "op"), winners.select("order_id"))
    executed = found._jdf.queryExecution().executedPlan()
    rows = executed.executeCollect()
    (scan,) = [p for p in leaves(executed) if "FileScan" in p.toString()]
    read = scan.metrics().apply("numOutputRows").value()
    assert len(rows) == keys - 1
    assert keys - 1 <= read <= 600 / 64 * keys * 2 if keys <= 30 else read == 600
    assert sorted((r.order_id, r.stored_lsn) for r in job.state.attach(winners, job.state.manifest()).collect()) == sorted(
        [(f"o{17 * k}", 17 * k + 1) for k in range(keys - 1)] + [("new", None)])


def leaves(executed) -> list:
    """Scans of a plan, also of one that was changed as it ran."""
    text = executed.getClass().getSimpleName()
    if text == "AdaptiveSparkPlanExec":
        return leaves(executed.executedPlan())
    if text.endswith("QueryStageExec"):
        return leaves(executed.plan())
    children = executed.children()
    if not children.size():
        return [executed]
    return [p for k in range(children.size()) for p in leaves(children.apply(k))]


@pytest.mark.parametrize("name", ["feed_outcomes", "batch_counters", "counter_trend", "event_outcomes"])
def test_reports_on_the_feed_parse_it_once(spark, sf_dir, name):
    """What a report uses twice is written once; the state of an earlier batch is its own read."""
    from tidemark.queries import QUERIES

    assert plan(QUERIES[name](spark, sf_dir)).count("from_json") <= 1


def test_report_aggregates_before_the_shuffle(spark, sf_dir):
    from tidemark.queries import QUERIES

    text = plan(QUERIES["revenue_segment_city"](spark, sf_dir))
    assert "partial_sum" in text and "CartesianProduct" not in text
    assert plan(marts.peek(QUERIES["order_facts"](spark, sf_dir))).count("TakeOrdered") == 1
