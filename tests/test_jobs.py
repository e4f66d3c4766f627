"""The command line, on Parquet folders in place of broker and database."""

import pytest
from helpers import NOW, event, messages
from test_streaming import PROGRESS

from tidemark import contract as C
from tidemark import fixtures as X
from tidemark.jobs import arguments, main
from tidemark.plans.batch import OrderPipeline
from tidemark.sources.snapshots import SnapshotStore
from tidemark.streaming import outcomes, revenue
from tidemark.streaming.run import LagReporter

SEGMENTS = ["--segments", *X.SEGMENTS]
CLOCK = ["--now", "2001-08-02T00:00:00"]


@pytest.fixture
def root(spark, sf_dir, tmp_path):
    X.source_customers(spark, sf_dir).write.parquet(f"{tmp_path}/source")
    return str(tmp_path)


def run(spark, command, root, *more):
    return main([command, "--root", root, *more], spark)


def refresh(spark, root, *more):
    return run(spark, "refresh", root, "--source", f"{root}/source", *more)


def orders(spark, root):
    facts = OrderPipeline(spark, f"{root}/facts", None).state.served()
    return {r.order_id: (r.lsn, r.name) for r in facts.collect()}


def test_refresh_reports_by_exit_code(spark, root):
    assert refresh(spark, root, *CLOCK) == 1
    assert refresh(spark, root, *CLOCK, *SEGMENTS) == 0
    assert refresh(spark, root, *CLOCK, *SEGMENTS, "--min-rows", "1000") == 1


def test_stream_needs_a_dimension(spark, root):
    with pytest.raises(FileNotFoundError):
        run(spark, "stream", root, "--inbox", f"{root}/inbox", "--available-now")


def test_stream_backfill_and_audit(spark, root):
    refresh(spark, root, *CLOCK, *SEGMENTS)
    feed = [event("a", 3), event("b", 1, customer_id=999), event("c", 1, age_s=7000), "junk"]
    messages(spark, feed).write.parquet(f"{root}/inbox")
    inbox = ["--inbox", f"{root}/inbox"]
    assert run(spark, "stream", root, *inbox, "--available-now") == 0
    served = orders(spark, root)
    assert {k: v[0] for k, v in served.items()} == {"a": 3, "b": 1}
    assert served["a"][1] is not None and served["b"][1] is None
    day = ["--begin", NOW.isoformat(), "--end", "2024-05-02"]
    assert run(spark, "backfill", root, *inbox, *day, "--label", "x", "--lateness-s", "9000") == 0
    assert set(orders(spark, root)) == {"a", "b", "c"}
    assert run(spark, "backfill", root, *inbox, *day, "--label", "x") == 3
    assert run(spark, "compact", root, "--buckets", "3") == 0
    assert set(orders(spark, root)) == {"a", "b", "c"}
    assert run(spark, "audit", root) == 0


def test_what_does_not_exist_is_not_sound(spark, root):
    assert run(spark, "audit", root) == 1
    assert run(spark, "lag", root) == 1


def test_stream_on_the_state_store(spark, root):
    refresh(spark, root, *CLOCK, *SEGMENTS)
    messages(spark, [event("a", 3), "junk"]).write.parquet(f"{root}/inbox")
    assert run(spark, "stream", root, "--inbox", f"{root}/inbox", "--available-now", "--state-store") == 0
    labelled = outcomes.read_labelled(spark, f"{root}/versions/labelled")
    (row,) = outcomes.served(labelled).collect()
    assert (row.order_id, row.lsn) == ("a", 3) and row.name is not None
    assert outcomes.letters(labelled).count() == 1 and outcomes.counters(labelled).first().reconciles
    assert run(spark, "revenue", root, "--available-now", "--minutes", "30") == 0
    (earned,) = revenue.revenue(revenue.read_totals(spark, f"{root}/versions/revenue")).collect()
    assert (earned.revenue, earned.orders, earned.window_start.minute % 30) == (10.5, 1, 0)


def test_revenue_needs_labelled_messages(spark, root):
    assert run(spark, "revenue", root, "--available-now") == 1


def test_large_ids_of_the_source_are_kept(spark, root):
    """An id beyond the type stops the refresh; it never becomes NULL."""
    X.source_customers(spark, "/root/testdata/sf0.001").selectExpr(
        "customer_id + 2999999999 AS customer_id", "name", "city", "segment", "signup_date",
        "updated_at").write.parquet(f"{root}/large")
    large = ["refresh", "--root", root, "--source", f"{root}/large", *CLOCK, *SEGMENTS]
    assert main(large, spark) == 1
    assert main([*large, "--customer-id-type", "bigint"], spark) == 0
    store = SnapshotStore(spark, f"{root}/customers")
    assert store.current()["number"] == 1
    ids = [r.customer_id for r in store.read().collect()]
    assert min(ids) == 3000000000 and len(set(ids)) == 150


def test_lag_of_the_last_report(spark, root):
    reporter = LagReporter(spark, f"{root}/lag", C.PipelineConfig(lag_report_every=1))
    reporter.record({**PROGRESS, "timestamp": "2024-05-01T00:00:00.000Z", "batchId": 90})
    caught_up = {"endOffset": {"orders_stream": {"0": 100}}, "latestOffset": {"orders_stream": {"0": 101}}}
    reporter.record({
        **PROGRESS, "timestamp": "2024-05-02T00:00:00.000Z", "sources": [caught_up]})
    assert run(spark, "lag", root) == 0
    assert run(spark, "lag", root, "--max-offsets", "0") == 1


def test_broker_options_reach_the_command_line():
    args = arguments().parse_args(["stream", "--root", "r", "--servers", "broker:9092"])
    assert (args.topic, args.dead_letter_topic, args.group) == (
        "orders_stream", "orders_stream_dlt", None)
