from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from helpers import event, messages
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark import fixtures as X
from tidemark.functions.safe import instant
from tidemark.operators import history, quality
from tidemark.plans.batch import OrderPipeline
from tidemark.plans.refresh import RefreshStopped, extract, publish, refresh_dimension, validate
from tidemark.sources import files
from tidemark.sources.measure import memory_bytes
from tidemark.sources.snapshots import PublishedDimension, SnapshotStore

CLOCK = datetime(2001, 8, 2)


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path))


def refresh(store, source, baseline=None):
    baseline = quality.baseline(source) if baseline is None else baseline
    return refresh_dimension(source, baseline, store, X.RULES, CLOCK)


def test_refresh_publishes_what_passed(spark, sf_dir, store):
    report = refresh(store, X.source_customers(spark, sf_dir))
    assert quality.summary(report).first().ok
    assert report.count() == 13
    assert store.current()["number"] == 1 and store.read().count() == 150
    assert store.read().schema == C.CUSTOMER


def test_failed_gate_keeps_the_published_version(spark, sf_dir, store):
    source = X.source_customers(spark, sf_dir)
    refresh(store, source)
    before = store.current()
    with pytest.raises(RefreshStopped, match="segment_domain"):
        refresh(store, X.corrupt_customers(spark, sf_dir), quality.baseline(source))
    assert store.current() == before
    rejected = spark.read.parquet(f"{store.root}/rejected/*/report")
    assert rejected.filter("NOT passed").count() >= 8


def test_stages_can_run_one_by_one(spark, sf_dir, store):
    source = X.source_customers(spark, sf_dir)
    candidate = extract(source, store)
    assert store.current() is None
    validate(candidate, quality.baseline(source), store, X.RULES, CLOCK)
    assert publish(candidate, store, CLOCK)["number"] == 1


def test_failed_extraction_stops_the_run(spark, sf_dir, store):
    source = X.source_customers(spark, sf_dir).withColumn(
        "name", F.raise_error(F.lit("source is down")))
    with pytest.raises(RefreshStopped, match="could not be copied"):
        refresh(store, source, quality.baseline(X.source_customers(spark, sf_dir)))
    assert store.current() is None


def test_reading_without_a_snapshot_is_an_error(store):
    with pytest.raises(FileNotFoundError):
        store.read()
    with pytest.raises(FileNotFoundError):
        PublishedDimension(store)()


def test_lookup_follows_the_published_version(spark, store):
    def version(segment):
        return spark.createDataFrame(
            [(1, "n", "c", segment)], "customer_id int, name string, city string, segment string")

    lookup = PublishedDimension(store)
    store.publish(store.write_candidate(version("Premium")))
    frame, size = lookup()
    assert frame.first().segment == "Premium" and size > 0
    assert lookup()[0] is frame
    store.publish(store.write_candidate(version("Standard")))
    assert lookup()[0].first().segment == "Standard" and len(lookup.known) == 1


def test_stream_picks_up_a_new_version_between_batches(spark, store, tmp_path):
    job = OrderPipeline(spark, f"{tmp_path}/facts", PublishedDimension(store))
    for batch, segment in enumerate(("Premium", "Standard")):
        store.publish(store.write_candidate(spark.createDataFrame(
            [(1, "n", "c", segment)],
            "customer_id int, name string, city string, segment string")))
        job.apply(messages(spark, [event(f"o{batch}", batch + 1)]), batch, "run")
    assert {r.order_id: r.segment for r in job.state.served().collect()} == {
        "o0": "Premium", "o1": "Standard"}


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path = f"{tmp_path}/folder/one.json"
    assert files.read_json(spark, path) is None
    assert files.create_json(spark, path, {"n": 1})
    assert not files.create_json(spark, path, {"n": 2})
    assert files.read_json(spark, path) == {"n": 1}
    assert files.names(spark, f"{tmp_path}/folder") == ["one.json"]


@pytest.mark.parametrize("broken, check", [
    (lambda f: f.drop("city"), "required_columns_present"),
    (lambda f: f.withColumn("customer_id", F.concat(F.lit("x"), "customer_id")), "customer_id_numeric"),
    (lambda f: f.withColumn("signup_date", F.lit("someday")), "signup_date_parseable"),
    (lambda f: f.withColumn("segment", F.lit("Zinc")), "segment_domain"),
    (lambda f: f.unionByName(f), "customer_id_unique"),
    (lambda f: f.limit(0), "row_count_minimum"),
])
def test_broken_sources_are_refused_before_they_are_typed(spark, sf_dir, store, broken, check):
    """Even where NULLs are allowed."""
    source = X.source_customers(spark, sf_dir)
    rules = replace(X.RULES, max_null_rate=1.0)
    with pytest.raises(RefreshStopped, match=check):
        refresh_dimension(broken(source), quality.baseline(source), store, rules, CLOCK)
    assert store.current() is None


def test_unexpected_segments_are_listed(spark, sf_dir):
    frame = X.source_customers(spark, sf_dir).withColumn(
        "segment", F.when(F.col("customer_id") % 9 == 0, "Zinc").when(F.col("customer_id") % 9 == 1, "Brass")
        .otherwise(F.col("segment")))
    report = quality.quality_report(frame, X.RULES, clock=CLOCK)
    assert report.filter("check_name = 'segment_domain'").first().detail.endswith(": Brass, Zinc")


def test_history_is_kept_by_the_refresh(spark, sf_dir, store):
    source = X.source_customers(spark, sf_dir)
    moved = source.filter("customer_id <> 5").withColumn(
        "segment", F.when(F.col("customer_id") == 7, "BUILDING").otherwise(F.col("segment")))
    before = source.filter("customer_id = 7").first().segment
    for rows, clock in ((source, CLOCK), (moved, CLOCK + timedelta(hours=1))):
        refresh_dimension(rows, quality.baseline(rows), store, X.RULES, clock, keep_history=True)
    closed = {r.customer_id for r in store.history().filter("NOT is_current").collect()}
    assert closed == {5} | ({7} if before != "BUILDING" else set())
    assert store.read().count() == 149


def test_a_refresh_adds_to_the_closed_ranges_only(spark, store):
    """Three refreshes: each writes what it closes and the current part, the rest stays as it is."""
    def people(rows):
        return spark.createDataFrame(
            [(k, f"n{k}", "c", s, CLOCK, CLOCK) for k, s in rows], C.CUSTOMER)

    versions = [[(1, "HOUSEHOLD"), (2, "BUILDING"), (3, "BUILDING")], [(1, "BUILDING"), (2, "BUILDING")],
                [(1, "BUILDING"), (2, "BUILDING")], [(1, "FURNITURE"), (2, "BUILDING"), (3, "BUILDING")]]
    whole, held = None, []
    for k, rows in enumerate(versions):
        at = CLOCK + timedelta(hours=k)
        refresh_dimension(people(rows), None, store, X.RULES, at, keep_history=True)
        whole = history.advance(whole, people(rows), instant(at))
        held.append(store.current()["history"])
        found, want = ({tuple(r) for r in f.select(*sorted(f.columns)).collect()} for f in (store.history(), whole))
        assert found == want
    assert [len(h["closed"]) for h in held] == [0, 1, 1, 2]
    assert held[3]["closed"][:1] == held[1]["closed"]
    assert spark.read.parquet(held[3]["closed"][1]).count() == 1
    assert len({h["current"] for h in held}) == 4


def test_memory_bound_follows_the_text_and_not_the_files(spark, tmp_path):
    """Repeated text is stored once in Parquet, but takes its place in memory."""
    frame = spark.range(2000).selectExpr("id AS customer_id", "repeat('x', 1000) AS name")
    frame.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    assert files.size_bytes(spark, f"{tmp_path}/rows") < 200_000
    assert 2000 * 1000 < memory_bytes(stored) < 2000 * 1200
    assert memory_bytes(stored.limit(0)) == 0


@pytest.mark.parametrize("retain_s, kept", [(3600, [True, True, True]), (0, [False, True, True])])
def test_replaced_snapshots_stay_for_their_time(spark, tmp_path, retain_s, kept):
    store, paths = SnapshotStore(spark, str(tmp_path), retain_s), []
    for n in range(3):
        paths.append(store.write_candidate(spark.range(n + 1).withColumnRenamed("id", "customer_id")))
        store.publish(paths[-1])
        assert store.publish(paths[-1])["number"] == n + 1
    assert [files.exists(spark, p) for p in paths] == kept
    assert store.read().count() == 3
