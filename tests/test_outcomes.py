"""Messages labelled by the state store, revenue and triage as streams."""

import time

import pandas as pd
import pytest
from helpers import NOW, dimension, event, messages
from pyspark.sql import functions as F
from test_pipeline import newest, random_feed

from tidemark import contract as C
from tidemark.operators import deadletter, events, marts, versions
from tidemark.plans.batch import apply_batch
from tidemark.sources import topics
from tidemark.streaming import letters, outcomes, revenue


class Run:
    """A stream of labelled messages, and revenue from it, run batch by batch."""

    def __init__(self, spark, folder, cfg=C.PipelineConfig()):
        self.spark, self.folder, self.cfg, self.sent = spark, folder, cfg, 0

    def step(self, payloads, people=None):
        messages(self.spark, payloads, self.sent).coalesce(1).write.mode("append").parquet(f"{self.folder}/inbox")
        self.sent += len(payloads)
        frame = people if people is not None else dimension(self.spark)
        stream = outcomes.label_stream(
            topics.file_stream(self.spark, f"{self.folder}/inbox", 1), frame, 1000, self.cfg)
        writer = outcomes.write_labelled(stream, f"{self.folder}/labelled", f"{self.folder}/checkpoint")
        outcomes.catch_up(writer, outcomes.expires(self.cfg))
        return self.labelled()

    def labelled(self):
        return outcomes.read_labelled(self.spark, f"{self.folder}/labelled")

    def revenue(self):
        changed = revenue.deltas(outcomes.labelled_stream(self.spark, f"{self.folder}/labelled"))
        revenue.write_totals(
            revenue.epoch_totals(changed, epoch="1 second", delay="0 seconds"), f"{self.folder}/totals",
            f"{self.folder}/checkpoint-totals").trigger(availableNow=True).start().awaitTermination()
        return revenue.read_totals(self.spark, f"{self.folder}/totals")


def fates(labelled, since=0):
    return {r.offset: r.outcome for r in labelled.filter(F.col("offset") >= since).collect()}


def test_labels_over_batches_and_restarts(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    first = [event("a", 5, "D"), event("b", 2), event("b", 1), "junk", event("c", 1, age_s=9000), event("b", 2)]
    assert fates(run.step(first)) == {
        0: "delete", 1: "upsert", 2: "superseded", 3: "invalid", 4: "late", 5: "superseded"}
    second = [event("a", 4), event("b", 3, amount=7), event("b", 2), event("a", 6, amount=3), event("z", 9)]
    labelled = run.step(second)
    assert fates(labelled, 6) == {6: "superseded", 7: "upsert", 8: "superseded", 9: "upsert", 10: "upsert"}
    labelled = run.step([event("b", 3), event("z", 8), event("a", 6, "D")])
    assert fates(labelled, 11) == {11: "stale", 12: "stale", 13: "stale"}
    assert {r.order_id: (r.lsn, r.amount) for r in outcomes.served(labelled).collect()} == {
        "a": (6, 3.0), "b": (3, 7.0), "z": (9, 10.5)}
    counted = outcomes.counters(labelled).orderBy("applied_at").collect()
    assert [(r.processed, r.superseded, r.stale, r.upserts, r.deletes) for r in counted] == [
        (6, 2, 0, 1, 1), (5, 2, 0, 3, 0), (3, 0, 3, 0, 0)]
    assert all(r.reconciles for r in counted)
    assert outcomes.letters(labelled).count() == 2


def test_stream_and_batch_agree_on_a_hot_order(spark, tmp_path):
    """One order is a third of all events; every batch gives the counters of the batch job."""
    run, feed = Run(spark, str(tmp_path)), random_feed(11)
    feed += [event("hot", k % 97) for k in range(len(feed) // 2)]
    half = len(feed) // 2
    run.step(feed[:half])
    labelled = run.step(feed[half:])
    assert {r.order_id: r.lsn for r in outcomes.served(labelled).collect()} == {
        order: row[0] for order, row in newest(feed).items()}
    first = apply_batch(messages(spark, feed[:half]))
    stored = versions.stored_versions(first.effective())
    second = apply_batch(messages(spark, feed[half:], half), lambda latest: versions.attach_stored(latest, stored))
    same = [c for c in second.counters().columns if c != "recorded_at"]
    got = [tuple(r[c] for c in same) for r in outcomes.counters(labelled).orderBy("applied_at").collect()]
    assert got == [tuple(b.counters().first()[c] for c in same) for b in (first, second)]


def test_hard_deletes_and_expired_tombstones(spark, tmp_path):
    forgetful = Run(spark, f"{tmp_path}/hard", C.PipelineConfig(tombstones=False))
    forgetful.step([event("a", 5, "D")])
    assert fates(forgetful.step([event("a", 4)]), 1) == {1: "upsert"}
    expiring = Run(spark, f"{tmp_path}/ttl", C.PipelineConfig(tombstone_ttl_s=1))
    expiring.step([event("a", 5, "D"), event("b", 5)])
    time.sleep(1.5)
    assert fates(expiring.step([event("a", 4), event("b", 4)]), 2) == {2: "upsert", 3: "stale"}


def test_revenue_is_corrected(spark, tmp_path):
    """Each batch is an epoch whose state is gone before the next: corrections still count."""
    run = Run(spark, str(tmp_path))
    run.step([event("a", 1, amount=10), event("b", 1, amount=5), event("c", 1, amount=1, customer_id=99)])
    run.revenue()
    time.sleep(1.2)
    moved = dimension(spark).withColumn("segment", F.lit("Standard"))
    run.step([event("a", 2, amount=4, age_s=3000), event("b", 2, "D"), event("c", 1, amount=8)], moved)
    run.revenue()
    time.sleep(1.2)
    run.step([event("a", 3, amount=6, age_s=100), event("d", 1, amount=2)], moved)
    totals = run.revenue()
    got = {(r.window_start, r.segment, r.city): (r.revenue, r.orders) for r in revenue.revenue(totals).collect()}
    served = outcomes.served(run.labelled())
    want = {(r.window_start, r.segment, r.city): (r.revenue, r.orders)
            for r in marts.revenue_by_window(served).collect()}
    assert got == want and len({k[1] for k in got}) == 2
    recent = revenue.revenue_since(totals, NOW.replace(minute=1)).collect()
    assert {(r.segment, r.orders) for r in recent} == {("Standard", 1), (None, 1)}


def test_repeated_letters_count_once(spark, tmp_path):
    feed = ["junk", "more junk", event("a", 1, age_s=9000)]
    sent = deadletter.envelope(events.rejected(events.judge(events.parse(messages(spark, feed)))))
    rows = sent.selectExpr("CAST(key AS BINARY) AS key", "value", "'dlt' AS topic", "0 AS partition",
                           "CAST(0 AS BIGINT) AS offset", "arrived_at AS timestamp")
    for copies in (2, 1):
        for _ in range(copies):
            rows.write.mode("append").parquet(f"{tmp_path}/inbox")
        unique = letters.unique_letters(topics.file_stream(spark, f"{tmp_path}/inbox"))
        letters.write_triage(unique, f"{tmp_path}/counts", f"{tmp_path}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    counts = letters.read_triage(spark, f"{tmp_path}/counts").collect()
    assert {r.reject_reason: r.n for r in counts} == {"late_event": 1, "schema_or_parse_failure": 2}


@pytest.mark.parametrize("parts", [1, 3])
def test_labels_in_one_pass(spark, parts):
    feed = random_feed(4) + [event("hot", k % 50) for k in range(100)]
    batch = apply_batch(messages(spark, feed))
    want = {r.offset: r.outcome for r in batch.outcomes().collect()}
    assert {r.offset: r.outcome for r in versions.label(batch.judged, parts=parts).collect()} == want
    stored = spark.createDataFrame([("hot", 60, "U"), ("a", 1, "D"), ("unseen", 1, "I")],
                                   "order_id string, stored_lsn long, stored_op string")
    guarded = apply_batch(messages(spark, feed), lambda latest: versions.attach_stored(latest, stored))
    want = {r.offset: r.outcome for r in guarded.outcomes().collect()}
    assert {r.offset: r.outcome for r in versions.label(batch.judged, stored, parts).collect()} == want
    assert "stale" in want.values()


class Kept(dict):
    """A map of the state store that counts its calls."""

    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


def test_a_group_of_orders_costs_few_frames_and_calls():
    """Many orders of a group come back together, and each asks the state at most twice."""
    names = ["partition", "offset", "arrived_at", "op", "order_id", "lsn", "stage", "event_time", "segment", "city"]
    processor, live = outcomes.Versions(names, True, None), Kept()
    processor.init(type("Handle", (), {"getMapState": lambda self, *given, **more: live})())

    def frame(version, op):
        rows = [("0", str(k), "5", op, f"o{k}", str((1 << 62) + version), C.FRESH, "7", "s", "c", "1.5")
                for k in range(1000) for _ in range(2)]
        return pd.DataFrame(rows + [(None,) * 6 + (C.LATE,) + (None,) * 4], columns=[*names, "sum"])

    for version, op, fate in ((2, "U", "upsert"), (1, "U", "stale"), (3, "D", "delete"), (3, "U", "stale")):
        live.calls = 0
        out = list(processor.handleInputRows((0,), iter([frame(version, op)]), None))
        assert len(out) == 2 and live.calls <= 2000
        counted = pd.concat(out).outcome.value_counts().to_dict()
        assert counted == {fate: 1000, "superseded": 1000, "late": 1}
    assert all(value[:2] == ((1 << 62) + 3, "D") for value in live.values())


def test_values_come_back_as_they_were_sent(spark, tmp_path):
    """Numbers beyond a double's digits and times beyond nanoseconds, without a broadcast."""
    run = Run(spark, str(tmp_path), C.PipelineConfig(broadcast_limit_bytes=0))
    far = "9999-12-31T23:59:59.123456+00:00"
    first = run.step([event("a", (1 << 62) + 1, event_time=far), "junk"]).collect()
    assert {(r.lsn, r.name, r.age_s is None) for r in first} == {((1 << 62) + 1, "name 1", False), (None, None, True)}
    last = run.step([event("a", (1 << 62) + 2, amount=0.1 + 0.2), event("a", (1 << 62) + 1)])
    got = {(r.outcome, str(r.old_event_time), r.old_amount) for r in last.filter("offset >= 2").collect()}
    assert got == {("upsert", "9999-12-31 23:59:59.123456", 10.5), ("superseded", "None", None)}
