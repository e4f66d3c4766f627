"""The batch job against a plain fold, under disorder, replays and crashes."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from helpers import dimension, event, messages

from tidemark import contract as C
from tidemark.operators import counters, versions
from tidemark.plans.batch import OrderPipeline, apply_batch
from tidemark.sources import files
from tidemark.sources.order_state import OrderState


def pipeline(spark, root, **settings):
    frame = dimension(spark)
    settings = {"state_buckets": 4, **settings}
    return OrderPipeline(spark, str(root), lambda: (frame, 1000), C.PipelineConfig(**settings))


def served(job):
    return {r.order_id: (r.lsn, r.op, r.amount, r.name) for r in job.state.served().collect()}


def random_feed(seed, n=120, orders=9):
    rng = random.Random(seed)
    feed = []
    for lsn in range(1, n + 1):
        roll = rng.random()
        if roll < 0.08:
            feed.append("junk")
        elif roll < 0.16:
            feed.append(event(f"o{rng.randrange(orders)}", lsn, age_s=9000))
        else:
            feed.append(event(
                f"o{rng.randrange(orders)}", lsn, rng.choice("IUUD"),
                amount=rng.randrange(100), customer_id=rng.randrange(1, 6)))
    rng.shuffle(feed)
    return feed + rng.sample(feed, 10)


def newest(feed):
    """What is live once the newest fresh version of each order has won."""
    best = {}
    for e in feed:
        if isinstance(e, dict) and "T12:00" in e["event_time"]:
            if e["order_id"] not in best or e["lsn"] > best[e["order_id"]]["lsn"]:
                best[e["order_id"]] = e
    return {
        k: (e["lsn"], e["op"], float(e["amount"]),
            f"name {e['customer_id']}" if e["customer_id"] <= 3 else None)
        for k, e in best.items() if e["op"] != "D"
    }


@pytest.mark.parametrize("seed, cache, compact_after, limit", [
    (1, True, 2, 10**6), (2, True, None, 10**6), (3, False, 2, 0)])
def test_batches_in_any_order_converge(spark, tmp_path, seed, cache, compact_after, limit):
    feed = random_feed(seed)
    job = pipeline(
        spark, tmp_path, cache_batch=cache, compact_after=compact_after, broadcast_limit_bytes=limit)
    size = 50
    for i in range(0, len(feed), size):
        job.apply(messages(spark, feed[i:i + size], i), i // size, "run")
    assert served(job) == newest(feed)
    metrics = job.metrics().collect()
    assert sum(m.processed for m in metrics) == len(feed)
    assert all(m.reconciles for m in metrics)
    assert job.letters().count() == sum(m.invalid + m.late for m in metrics)


def test_outcomes_partition_the_batch(spark):
    feed = random_feed(5)
    batch = apply_batch(messages(spark, feed))
    rows = batch.outcomes().select("offset", "outcome").collect()
    assert sorted(r.offset for r in rows) == list(range(len(feed)))
    assert {r.outcome for r in rows} <= set(C.OUTCOMES)
    counted = batch.counters().first()
    by_outcome = {o: sum(r.outcome == o for r in rows) for o in C.OUTCOMES}
    assert [counted[c] for c in (
        "invalid", "late", "superseded", "stale", "upserts", "deletes")] == [
        by_outcome[o] for o in C.OUTCOMES]


def test_one_order_and_one_payload_may_fill_the_batch(spark):
    feed = [event("hot", 5)] * 300 + [event("hot", lsn) for lsn in range(6, 120)] + ["junk"] * 300
    batch = apply_batch(messages(spark, feed))
    counted = batch.counters().first()
    assert (counted.invalid, counted.superseded, counted.upserts) == (300, 413, 1)
    assert batch.guarded.first().lsn == 119
    assert batch.outcomes().count() == len(feed)


def test_replay_changes_nothing(spark, tmp_path):
    feed = random_feed(7)
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, feed), 0, "run")
    before = served(job)
    job.apply(messages(spark, feed), 0, "another checkpoint")
    again = {m.run_id: m for m in job.metrics().collect()}["another checkpoint"]
    assert (again.upserts, again.deletes) == (0, 0) and again.stale > 0
    assert served(job) == before
    audit = counters.sink_audit(job.state.served()).first()
    assert audit.sound and audit.documents == len(before)


def test_committed_batch_is_skipped(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, [event("a", 1)]), 0, "run")
    job.apply(messages(spark, [event("a", 9)]), 0, "run")
    assert served(job)["a"][0] == 1
    assert job.metrics().count() == 1


def test_empty_batch_leaves_no_trace(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, [event()]).limit(0), 0, "run")
    assert job.state.manifest()["number"] == 0 and job.state.rows().isEmpty()
    assert not files.exists(spark, f"{tmp_path}/batch_metrics")


def test_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    job = pipeline(spark, tmp_path)
    job.state.create()
    feed = ["junk", event("a", 1), event("b", 2, "D")]

    def crash(*_):
        raise RuntimeError("lost the driver")

    with monkeypatch.context() as patched:
        patched.setattr("tidemark.sources.manifests.files.create_json", crash)
        with pytest.raises(RuntimeError):
            job.apply(messages(spark, feed), 0, "run")
    assert job.state.rows().isEmpty()
    job.apply(messages(spark, feed), 0, "run")
    assert served(job) == {"a": (1, "U", 10.5, "name 1")}
    assert job.letters().count() == 1
    (metrics,) = job.metrics().collect()
    assert (metrics.processed, metrics.deletes, metrics.deletes_effective) == (3, 1, 0)


def test_all_rejected_batch_still_reports(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, ["junk", "junk"]), 0, "run")
    (metrics,) = job.metrics().collect()
    assert (metrics.processed, metrics.accepted, metrics.reconciles) == (2, 0, True)


@pytest.mark.parametrize("tombstones, live", [(True, {}), (False, {"a": 1})])
def test_older_change_after_a_delete(spark, tmp_path, tombstones, live):
    job = pipeline(spark, tmp_path, tombstones=tombstones)
    job.apply(messages(spark, [event("a", 2, "D")]), 0, "run")
    job.state.compact()
    job.apply(messages(spark, [event("a", 1)]), 1, "run")
    assert {k: v[0] for k, v in served(job).items()} == live


def test_hard_delete_then_older_insert_without_compaction(spark, tmp_path):
    job = pipeline(spark, tmp_path, tombstones=False)
    for batch, (lsn, op) in enumerate([(5, "I"), (6, "D"), (3, "I"), (2, "U")]):
        job.apply(messages(spark, [event("a", lsn, op)]), batch, "run")
    assert {k: v[0] for k, v in served(job).items()} == {"a": 3}


def test_compaction_keeps_rows_and_expires_tombstones(spark, tmp_path):
    now = datetime.now(timezone.utc)
    job = pipeline(spark, tmp_path, tombstone_ttl_s=3600)
    job.apply(messages(spark, [event("a", 1), event("b", 2, "D")]), 0, "run")
    job.state.compact(now)
    job.apply(messages(spark, [event("a", 3), event("c", 4)]), 1, "run")
    job.state.compact(now)
    assert sorted((r.order_id, r.lsn, r.op) for r in job.state.rows().collect()) == [
        ("a", 3, "U"), ("b", 2, "D"), ("c", 4, "U")]
    job.apply(messages(spark, [event("d", 5)]), 2, "run")
    job.state.compact(now + timedelta(hours=2))
    assert {r.order_id for r in job.state.rows().collect()} == {"a", "c", "d"}
    assert job.state.manifest()["deltas"] == []


@pytest.mark.parametrize("tombstones, live", [(True, {"b": 2}), (False, {"a": 1, "b": 2})])
def test_a_delete_hides_rows_of_the_base(spark, tmp_path, tombstones, live):
    job = pipeline(spark, tmp_path, tombstones=tombstones)
    job.apply(messages(spark, [event("a", 5), event("b", 2)]), 0, "run")
    job.state.compact()
    job.apply(messages(spark, [event("a", 6, "D")]), 1, "run")
    assert {k: v[0] for k, v in served(job).items()} == {"b": 2}
    job.apply(messages(spark, [event("a", 1)]), 2, "run")
    assert {k: v[0] for k, v in served(job).items()} == live
    job.state.compact()
    assert {k: v[0] for k, v in served(job).items()} == live


def test_buckets_are_set_and_can_change(spark, tmp_path):
    job = pipeline(spark, tmp_path, state_buckets=None)
    job.apply(messages(spark, [event("a", 1), event("b", 2)]), 0, "run")
    with pytest.raises(ValueError, match="state_buckets"):
        job.state.compact()
    for buckets in (2, 5):
        assert job.state.compact(buckets=buckets)
        assert job.state.manifest()["base"]["buckets"] == buckets
        assert {k: v[0] for k, v in served(job).items()} == {"a": 1, "b": 2}


def test_replaced_folders_stay_for_their_time(spark, tmp_path):
    job = pipeline(spark, tmp_path, retain_s=3600)
    job.apply(messages(spark, [event("a", 1)]), 0, "run")
    (delta,) = job.state.manifest()["deltas"]
    reader = job.state.served()
    job.state.compact()
    job.apply(messages(spark, [event("b", 2)]), 1, "run")
    job.state.compact()
    assert reader.count() == 1 and files.exists(spark, delta)
    short = pipeline(spark, tmp_path, retain_s=0)
    short.apply(messages(spark, [event("c", 3)]), 2, "run")
    short.state.compact()
    assert not files.exists(spark, delta)
    assert len(short.state.manifests.numbers()) == 1
    assert {k: v[0] for k, v in served(job).items()} == {"a": 1, "b": 2, "c": 3}


def test_interleaved_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """Another writer commits between this batch's guard and its manifest."""
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, [event("a", 1)]), 0, "stream")
    commit, between = OrderState.commit, []

    def late_commit(self, changes, manifest, run_id, batch_id):
        if run_id == "stream" and not between:
            between.append(True)
            pipeline(spark, tmp_path).apply(messages(spark, [event("a", 7), event("b", 3)]), 0, "backfill")
        return commit(self, changes, manifest, run_id, batch_id)

    monkeypatch.setattr(OrderState, "commit", late_commit)
    job.apply(messages(spark, [event("a", 5), event("c", 4)]), 1, "stream")
    assert {k: v[0] for k, v in served(job).items()} == {"a": 7, "b": 3, "c": 4}
    assert job.state.manifest()["runs"] == {"stream": 1, "backfill": 0}
    last = {(m.run_id, m.batch_id): m for m in job.metrics().collect()}["stream", 1]
    assert (last.stale, last.upserts, last.reconciles) == (1, 1, True)


def test_a_reader_never_finds_a_gap(spark, tmp_path):
    import threading

    from tidemark.sources.manifests import Manifests

    table, seen, stop = Manifests(spark, f"{tmp_path}/t"), [], threading.Event()
    table.add({"number": 0})

    def poll():
        while not stop.is_set():
            seen.append(table.latest()["number"])

    reader = threading.Thread(target=poll)
    reader.start()
    for number in range(1, 60):
        assert table.add({"number": number}) is not None
        assert table.add({"number": number}) is None
        if number % 10 == 0:
            table.expire(0)
    stop.set()
    reader.join()
    assert seen == sorted(seen) and table.latest()["number"] == 59


def test_lost_manifests_are_an_error(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        job.state.served()
    job.apply(messages(spark, [event("a", 1)]), 0, "run")
    files.remove(spark, f"{job.state.root}/manifests")
    with pytest.raises(FileNotFoundError, match="no manifest"):
        job.apply(messages(spark, [event("b", 1)]), 1, "run")


def test_equal_versions_keep_the_first(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, [event("a", 1, amount=5), event("a", 1, amount=6)]), 0, "run")
    job.apply(messages(spark, [event("a", 1, amount=7)], 10), 1, "run")
    assert served(job)["a"][2] == 5


def test_large_ids_by_setting(spark, tmp_path):
    big = [event("a", 1, customer_id=3_000_000_000)]
    narrow, wide = pipeline(spark, tmp_path / "n"), pipeline(spark, tmp_path / "w", customer_id_type="bigint")
    narrow.apply(messages(spark, big), 0, "run")
    wide.apply(messages(spark, big), 0, "run")
    wide.state.compact()
    assert narrow.metrics().first().invalid == 1
    assert wide.state.served().first().customer_id == 3_000_000_000
    other = pipeline(spark, tmp_path / "w")
    assert other.state.served().first().customer_id == 3_000_000_000
    with pytest.raises(ValueError, match="bigint"):
        other.apply(messages(spark, big), 1, "run")


def test_a_repeated_batch_replaces_its_reports(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    for batch in range(6):
        job.apply(messages(spark, ["junk", event("a", batch + 1)], 10 * batch), batch, "run")
    seen = job.letters()
    held = {r.batch_id: r.value for r in seen.collect()}
    # A repeated batch replaces its own part; one of another run is beside it.
    job._write_letters(apply_batch(messages(spark, ["junk", "more junk"], 20)).letters(), "run", 2)
    job._write_letters(apply_batch(messages(spark, ["junk"], 20)).letters(), "other/run = 1", 2)
    counted = {(r.run_id, r.batch_id): r["count"] for r in job.letters().groupBy("run_id", "batch_id").count().collect()}
    assert counted == {("run", k): 2 if k == 2 else 1 for k in range(6)} | {("other/run = 1", 2): 1}
    assert {r.batch_id: r.value for r in job.letters().filter("batch_id <> 2").collect()} == {
        k: v for k, v in held.items() if k != 2}
    # Who began to read before goes on with the batches that were not repeated.
    assert seen.filter("run_id = 'run' AND batch_id < 2").count() == 2
    assert job.metrics().count() == 6


def test_a_backfill_is_known_by_label_and_range(spark, tmp_path):
    from tidemark.plans.batch import backfill

    job = pipeline(spark, tmp_path, allowed_lateness_s=10**9)
    day = datetime(2024, 5, 1), datetime(2024, 5, 2)
    assert backfill(job, messages(spark, [event("a", 1)]), "x", *day)
    assert not backfill(job, messages(spark, [event("b", 1)]), "x", *day)
    assert backfill(job, messages(spark, [event("b", 1)]), "x", day[0], datetime(2024, 5, 3))
    assert set(served(job)) == {"a", "b"}


def test_a_backfill_parses_its_input_once(spark, tmp_path):
    feed = random_feed(11)
    reads = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            reads.add(batch.num_rows)
            yield batch

    counted = messages(spark, feed).mapInArrow(count, C.MESSAGE)
    job = pipeline(spark, tmp_path, cache_batch=False)
    job.apply(counted, 0, "run")
    assert reads.value == len(feed)
    assert served(job) == newest(feed)
    assert files.names(spark, f"{tmp_path}/staged") == []


@pytest.mark.parametrize("on_arrival, late", [(True, 0), (False, 1)])
def test_lateness_by_arrival_or_by_processing(spark, tmp_path, on_arrival, late):
    job = pipeline(spark, tmp_path, late_on_arrival=on_arrival)
    job.apply(messages(spark, [event("a", 1)]), 0, "run")
    assert job.metrics().first().late == late


def test_letters_are_sent_on(spark, tmp_path):
    sent = []
    job = pipeline(spark, tmp_path)
    job.publish_letters = lambda letters: sent.extend(letters.select("key", "value").collect())
    job.apply(messages(spark, ["junk", event("a", 1), event("b", 1, age_s=9000)]), 0, "run")
    assert sorted(r.key for r in sent) == ["", "b"]
    assert "late_event" in {r.key: r.value.decode() for r in sent}["b"]


def test_state_is_found_by_a_new_session(spark, tmp_path):
    job = pipeline(spark, tmp_path)
    job.apply(messages(spark, [event("a", 1)]), 0, "run")
    job.state.compact()
    other = spark.newSession()
    assert OrderState(other, f"{tmp_path}/orders").served().count() == 1


def test_equal_versions_are_settled_by_position(spark):
    feed = [event("a", 1, amount=n) for n in range(9)]
    frame = messages(spark, feed)
    first = apply_batch(frame).guarded.first().amount
    assert first == apply_batch(frame.repartition(5)).guarded.first().amount


def test_lookup_returns_only_touched_orders(spark):
    stored = spark.createDataFrame(
        [("a", 1, "U"), ("b", 2, "D")], "order_id string, stored_lsn bigint, stored_op string")
    asked = spark.createDataFrame([("b",), ("z",)], "order_id string")
    assert [tuple(r) for r in versions.lookup_versions(stored, asked).collect()] == [("b", 2, "D")]


# processed, invalid, late, superseded, stale, upserts, deletes, live
EXPECTED = {
    "a": (667, 114, 13, 395, 0, 113, 32),
    "b": (333, 56, 7, 151, 66, 42, 11),
    "replay": (1000, 170, 20, 662, 148, 0, 0),
}


def test_known_counters_of_the_feed(spark, sf_dir):
    from tidemark.queries import QUERIES

    rows = {(r.run_id, r.batch_id): r for r in QUERIES["replay_idempotence"](spark, sf_dir).collect()}
    for key, name in ((("delivery", 0), "a"), (("delivery", 1), "b"), (("replay", 0), "replay")):
        r = rows[key]
        assert (r.processed, r.invalid, r.late, r.superseded, r.stale, r.upserts, r.deletes) \
            == EXPECTED[name]
    assert QUERIES["hard_delete_apply"](spark, sf_dir).count() == 123
