"""Parsing and judging single payloads."""

import json

import pytest
from helpers import NOW, event, messages
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.operators import deadletter, events


def judged_rows(spark, payloads, cfg=C.PipelineConfig()):
    frame = events.judge(events.parse(messages(spark, payloads)), cfg)
    return [r.asDict() for r in frame.orderBy("offset").collect()]


@pytest.mark.parametrize("payload", ['{"op":"I","order_id":"trunc', "[1,2]", "", "null", None])
def test_unparseable_is_rejected_and_kept(spark, payload):
    (row,) = judged_rows(spark, [payload])
    assert (row["stage"], row["rule"]) == (C.INVALID, "unparseable")
    assert row["json_str"] == payload


@pytest.mark.parametrize("change, rule", [
    ({"op": "X"}, "unknown_op"),
    ({"op": None}, "missing_field"),
    ({"order_id": None}, "missing_field"),
    ({"product_category": None}, "missing_field"),
    ({"product_category": "9x"}, "category_malformed"),
    ({"amount": "bad_data"}, "amount_not_numeric"),
    ({"amount": "1."}, "amount_not_numeric"),
    ({"customer_id": "NOT_A_NUMBER"}, "customer_id_not_numeric"),
    ({"customer_id": -1}, "customer_id_not_numeric"),
    ({"customer_id": 99999999999}, "customer_id_out_of_range"),
    ({"lsn": "3"}, "missing_field"),
    ({"lsn": 3.5}, "missing_field"),
    ({"event_time": "nope"}, "event_time_unparseable"),
    ({"event_time": None}, "event_time_unparseable"),
])
def test_rules(spark, change, rule):
    (row,) = judged_rows(spark, [{**event(), **change}])
    assert (row["stage"], row["rule"]) == (C.INVALID, rule)


@pytest.mark.parametrize("amount, value", [
    (12.50, 12.5), (-5.25, -5.25), ("7", 7.0), (100000000.5, 100000000.5), (0, 0.0),
])
def test_amounts(spark, amount, value):
    frame = events.judge(events.parse(messages(spark, [event(amount=amount)])))
    assert [r.amount for r in events.fresh(frame).collect()] == [value]


def test_strict_amount_refuses_rendered_exponent(spark):
    (row,) = judged_rows(spark, [event(amount=100000000.5)], C.PipelineConfig(strict_amount=True))
    assert row["rule"] == "amount_not_numeric"


@pytest.mark.parametrize("age, stage", [
    (-60, C.FRESH), (0, C.FRESH), (3600, C.FRESH), (3601, C.LATE),
])
def test_lateness_boundary(spark, age, stage):
    (row,) = judged_rows(spark, [event(age_s=age)])
    assert (row["stage"], row["age_s"]) == (stage, age)


def test_fixed_clock(spark):
    cfg = C.PipelineConfig(clock=NOW.replace(hour=14))
    (row,) = judged_rows(spark, [event()], cfg)
    assert (row["stage"], row["age_s"]) == (C.LATE, 7200)


def test_every_message_is_accepted_or_rejected(spark):
    payloads = [event(lsn=1), "junk", event(lsn=2, age_s=9999), event(op="?"), None]
    frame = events.judge(events.parse(messages(spark, payloads)))
    accepted = {r.offset for r in events.fresh(frame).collect()}
    rejected = {r.offset for r in events.rejected(frame).collect()}
    assert accepted | rejected == set(range(len(payloads)))
    assert not accepted & rejected


def test_dead_letter_envelope(spark):
    frame = events.judge(events.parse(messages(spark, ["junk", event(lsn=7, age_s=9999)])))
    letters = deadletter.envelope(events.rejected(frame, NOW)).orderBy("reject_reason").collect()
    assert [(r.key, r.reject_reason) for r in letters] == [
        ("a", "late_event"), ("", "schema_or_parse_failure")]
    late, junk = (json.loads(bytes(r.value)) for r in letters)
    assert late["lsn"] == 7 and late["amount"] == "10.5"
    assert junk["json_str"] == "junk" and "op" not in junk


def test_triage_counts_by_window(spark):
    frame = events.judge(events.parse(messages(spark, ["junk", "more", event(age_s=9999)])))
    rows = deadletter.triage(deadletter.envelope(events.rejected(frame))).select(
        "reject_reason", "n", F.col("window_start").cast("string")).collect()
    assert sorted((r[0], r[1]) for r in rows) == [("late_event", 1), ("schema_or_parse_failure", 2)]


def test_letters_read_back_from_their_topic(spark):
    frame = events.judge(events.parse(messages(spark, [event("a", 7, age_s=9000), "junk"])))
    sent = deadletter.envelope(events.rejected(frame, NOW)).select("key", "value")
    letters = deadletter.from_messages(sent)
    assert {(r.reject_reason, r.lsn) for r in deadletter.read_back(letters).collect()} == {
        (C.REASON_LATE, 7), (C.REASON_INVALID, None)}
    assert {r.arrived_at for r in letters.collect()} == {NOW.replace(tzinfo=None)}
