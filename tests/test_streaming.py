import json

import pytest
from helpers import dimension, event, messages

from tidemark import contract as C
from tidemark.operators import counters
from tidemark.plans.batch import OrderPipeline
from tidemark.sources import topics
from tidemark.streaming.newest import live_orders, merge_changes, version_stream, write_changes, write_rejects
from tidemark.streaming.run import OFFSETS, LagReporter, progress_offsets, start


@pytest.fixture
def job(spark, tmp_path):
    frame = dimension(spark)
    return OrderPipeline(
        spark, f"{tmp_path}/facts", lambda: (frame, 1000), C.PipelineConfig(state_buckets=4))


def drop(spark, tmp_path, payloads, first_offset=0):
    messages(spark, payloads, first_offset).coalesce(1).write.mode("append").parquet(
        f"{tmp_path}/inbox")


def run(spark, job, tmp_path, checkpoint="checkpoint", max_files=1):
    stream = start(
        topics.file_stream(spark, f"{tmp_path}/inbox", max_files), job,
        f"{tmp_path}/{checkpoint}", available_now=True)
    stream.awaitTermination()


def live(job):
    return {r.order_id: r.lsn for r in job.state.served().collect()}


def test_batches_restart_and_replay(spark, job, tmp_path):
    drop(spark, tmp_path, [event("a", 1, "I"), event("b", 4), "junk"])
    drop(spark, tmp_path, [event("a", 3, "D"), event("b", 2)], 10)
    run(spark, job, tmp_path)
    assert live(job) == {"b": 4}
    drop(spark, tmp_path, [event("a", 2), event("c", 5)], 20)
    run(spark, job, tmp_path)
    assert live(job) == {"b": 4, "c": 5}
    assert [m.batch_id for m in job.metrics().orderBy("batch_id").collect()] == [0, 1, 2]
    run(spark, job, tmp_path, checkpoint="new")
    assert live(job) == {"b": 4, "c": 5}
    replayed = [m for m in job.metrics().collect() if m.upserts + m.deletes == 0]
    assert len(replayed) == 3 and all(m.reconciles for m in job.metrics().collect())
    assert counters.sink_audit(job.state.served()).first().sound


def test_crash_between_commit_and_checkpoint(spark, job, tmp_path, monkeypatch):
    drop(spark, tmp_path, [event("a", 1), event("b", 2), "junk"])
    applied = OrderPipeline.apply

    def apply_then_crash(self, *args):
        applied(self, *args)
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patched:
        patched.setattr(OrderPipeline, "apply", apply_then_crash)
        with pytest.raises(Exception, match="lost the driver"):
            run(spark, job, tmp_path)
    run(spark, job, tmp_path)
    assert live(job) == {"a": 1, "b": 2}
    assert job.metrics().count() == 1 and job.letters().count() == 1


def test_versions_in_the_state_store(spark, tmp_path):
    def step():
        changes = version_stream(topics.file_stream(spark, f"{tmp_path}/inbox", 1))
        write_changes(changes, f"{tmp_path}/changes", f"{tmp_path}/cp").trigger(
            availableNow=True).start().awaitTermination()
        return {r.order_id: r.lsn for r in live_orders(spark, f"{tmp_path}/changes").collect()}

    drop(spark, tmp_path, [event("a", 5, "D"), event("b", 2), event("b", 1), "junk"])
    assert step() == {"b": 2}
    drop(spark, tmp_path, [event("a", 4), event("b", 3), event("c", 1, age_s=9000)], 10)
    assert step() == {"b": 3}


def test_state_store_survives_a_new_checkpoint(spark, tmp_path):
    """A replay under a new checkpoint, whose batch ids begin again, changes nothing."""
    def step(checkpoint, folder, files=1):
        changes = version_stream(topics.file_stream(spark, f"{tmp_path}/{folder}", files))
        frame = dimension(spark)
        write_changes(
            changes, f"{tmp_path}/changes", f"{tmp_path}/{checkpoint}", lambda: (frame, 100),
        ).trigger(availableNow=True).start().awaitTermination()
        return {r.order_id: (r.lsn, r.amount, r.name) for r in live_orders(spark, f"{tmp_path}/changes").collect()}

    drop(spark, tmp_path, [event("a", 5), event("b", 2, amount=1), event("b", 2, amount=2)])
    step("one", "inbox")
    drop(spark, tmp_path, [event("a", 9), event("b", 2, amount=3)], 10)
    want = {"a": (9, 10.5, "name 1"), "b": (2, 1.0, "name 1")}
    assert step("one", "inbox") == want
    messages(spark, [event("a", 5)]).coalesce(1).write.parquet(f"{tmp_path}/old")
    assert step("two", "old") == want
    merge_changes(spark, f"{tmp_path}/changes")
    assert step("two", "old") == want


def test_rejects_beside_the_state_store(spark, tmp_path):
    drop(spark, tmp_path, ["junk", event("a", 1, age_s=9000), event("b", 1)])
    write_rejects(
        topics.file_stream(spark, f"{tmp_path}/inbox"), f"{tmp_path}/out", f"{tmp_path}/cp",
    ).trigger(availableNow=True).start().awaitTermination()
    letters = spark.read.parquet(f"{tmp_path}/out/dead_letters")
    assert sorted(r.reject_reason for r in letters.collect()) == ["late_event", "schema_or_parse_failure"]
    counted = spark.read.parquet(f"{tmp_path}/out/counters").collect()
    assert {r.stage: r.n for r in counted} == {"invalid": 1, "late": 1, "fresh": 1}


PROGRESS = {
    "batchId": 7, "numInputRows": 10,
    "sources": [{
        "endOffset": json.dumps({"orders_stream": {"0": 40, "1": 50}}),
        "latestOffset": {"orders_stream": {"0": 100, "1": 50, "2": 9}},
    }],
}


def test_lag_from_progress(spark):
    rows = progress_offsets(PROGRESS)
    lag = counters.partition_lag(spark.createDataFrame(rows, OFFSETS))
    assert {r.partition: r.lag for r in lag.collect()} == {0: 60, 1: 0, 2: 9}
    (total,) = counters.total_lag(lag).collect()
    assert (total.total_lag, total.over_threshold) == (69, False)
    cfg = C.PipelineConfig(max_offsets_per_trigger=6)
    assert counters.total_lag(lag, cfg).first().over_threshold


def test_file_sources_report_no_lag():
    assert progress_offsets({"batchId": 0, "sources": [{"endOffset": {"logOffset": 3}}]}) == []


def test_reporter_records_every_nth_batch(spark, tmp_path):
    reporter = LagReporter(spark, f"{tmp_path}/lag", C.PipelineConfig(lag_report_every=2))
    for n in range(5):
        reporter.record({**PROGRESS, "batchId": n})
    reporter.record({**PROGRESS, "numInputRows": 0})
    recorded = spark.read.parquet(f"{tmp_path}/lag")
    assert sorted({r.batch_id for r in recorded.collect()}) == [1, 3]


@pytest.mark.parametrize("offsets, warned", [(6, True), (7, False)])
def test_reporter_warns_of_lag(spark, tmp_path, caplog, offsets, warned):
    cfg = C.PipelineConfig(lag_report_every=1, max_offsets_per_trigger=offsets)
    LagReporter(spark, f"{tmp_path}/lag", cfg).record(PROGRESS)
    assert ("69 messages behind" in caplog.text) is warned


def test_state_is_updated_once_in_a_batch(spark, tmp_path):
    """However often the join without a broadcast reads a batch, its state is read once."""
    drop(spark, tmp_path, [event(f"o{k}", 1) for k in range(40)])
    tried, frame = spark.sparkContext.accumulator(0), dimension(spark)

    def seen(rows):
        for batch in rows:
            tried.add(batch.num_rows)
            yield batch

    stream = topics.file_stream(spark, f"{tmp_path}/inbox")
    # Behind the state, so that a second pass over the batch is seen.
    changes = version_stream(stream)
    changes = changes.mapInArrow(seen, changes.schema)
    write_changes(
        changes, f"{tmp_path}/changes", f"{tmp_path}/cp", lambda: (frame, None),
    ).trigger(availableNow=True).start().awaitTermination()
    assert live_orders(spark, f"{tmp_path}/changes").filter("name = 'name 1'").count() == 40
    assert tried.value == 40
