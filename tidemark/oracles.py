"""The registered queries in plain SQL, computed from the tables directly.

None of them goes through JSON payloads: the fate of every event follows from
its id, as the feed of the fixtures defines it.
"""

from __future__ import annotations

from tidemark.fixtures import SEGMENTS

FEED = """
feed AS (
  SELECT event_id AS lsn, event_id AS pos, CAST(event_id % 3 AS INTEGER) AS part,
    ts AS arrived, user_id AS customer_id,
    'o' || (user_id * 10 + CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 10) AS order_id,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op,
    CASE event_id % 50 WHEN 13 THEN -value WHEN 31 THEN value + 1e7::DOUBLE ELSE value END AS amount,
    CASE CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 4
      WHEN 0 THEN 'Electronics' WHEN 1 THEN 'Grocery' WHEN 2 THEN 'Apparel' ELSE 'Home' END
      AS product_category,
    CASE WHEN event_id % 50 = 29 THEN ts - INTERVAL 2 HOUR ELSE ts END AS event_time,
    CASE WHEN event_id % 50 = 3 THEN event_id // 50 % 6 END AS lost,
    CASE WHEN event_id % 50 = 0 THEN 'unparseable' WHEN event_id % 50 = 3 THEN 'missing_field'
      WHEN event_id % 50 = 17 THEN 'unknown_op'
      WHEN event_id % 50 = 23 THEN 'amount_not_numeric'
      WHEN event_id % 50 = 33 THEN 'category_malformed'
      WHEN event_id % 20 = 7 THEN 'customer_id_not_numeric'
      WHEN event_id % 50 = 41 THEN 'event_time_unparseable'
      WHEN event_id % 100 = 61 THEN 'customer_id_out_of_range'
      WHEN event_id % 50 = 29 THEN 'late' ELSE 'ok' END AS kind
  FROM events),
sent AS (  -- the fields as they are in the payload
  SELECT pos,
    CASE WHEN kind = 'unparseable' OR lost = 0 THEN NULL WHEN kind = 'unknown_op' THEN 'X' ELSE op END AS op,
    CASE WHEN kind <> 'unparseable' AND lost IS DISTINCT FROM 1 THEN order_id END AS order_id,
    CASE WHEN kind = 'unparseable' OR lost = 2 THEN NULL WHEN pos % 20 = 7 THEN 'NOT_A_NUMBER'
      WHEN kind = 'customer_id_out_of_range' THEN '99999999999' ELSE CAST(customer_id AS VARCHAR) END
      AS customer_id,
    CASE WHEN kind NOT IN ('unparseable', 'amount_not_numeric') AND pos % 20 <> 7
      AND lost IS DISTINCT FROM 3 THEN amount END AS amount,
    CASE WHEN kind <> 'unparseable' AND lost IS DISTINCT FROM 4 THEN lsn END AS lsn,
    CASE WHEN kind = 'unparseable' OR lost = 5 THEN NULL WHEN kind = 'category_malformed' THEN '9-volt!'
      ELSE product_category END AS product_category,
    CASE WHEN kind <> 'unparseable' AND pos % 50 <> 41 THEN event_time END AS event_time
  FROM feed),
stages AS (
  SELECT *, CASE kind WHEN 'ok' THEN 'fresh' WHEN 'late' THEN 'late' ELSE 'invalid' END AS stage,
    CAST(epoch(date_trunc('second', arrived)) - epoch(date_trunc('second', event_time)) AS BIGINT)
      AS age_s
  FROM feed),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) AS rn
  FROM stages WHERE stage = 'fresh'),
winners AS (SELECT * FROM ranked WHERE rn = 1)
"""

DIMENSION = """
dim AS (
  SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS name, n_name AS city,
    c_mktsegment AS segment, c_acctbal AS balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)
"""

FACTS = f"""
WITH {FEED}, {DIMENSION},
facts AS (
  SELECT w.order_id AS _id, w.order_id, w.op, CAST(w.customer_id AS INTEGER) AS customer_id,
    w.amount, w.product_category, w.event_time, w.lsn, d.name, d.city, d.segment
  FROM winners w LEFT JOIN dim d ON w.customer_id = d.customer_id
  WHERE w.op <> 'D')
"""

# Batch A holds two partitions of three, batch B the other one.
TWO_BATCHES = f"""
WITH {FEED},
part_a AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) AS ra
  FROM stages WHERE stage = 'fresh' AND part <> 1),
state_a AS (SELECT order_id, lsn, op, amount FROM part_a WHERE ra = 1),
part_b AS (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY lsn DESC) AS rb
  FROM stages WHERE stage = 'fresh' AND part = 1),
guarded AS (
  SELECT b.*, a.lsn AS stored_lsn, a.op AS stored_op,
    CASE WHEN b.lsn <= a.lsn THEN 'stale' WHEN b.op = 'D' THEN 'delete' ELSE 'upsert' END
      AS outcome
  FROM part_b b LEFT JOIN state_a a ON a.order_id = b.order_id WHERE b.rb = 1)
"""

SOURCE = f"""
{DIMENSION},
dates AS (
  SELECT o_custkey, min(o_orderdate) AS signup_date, max(o_orderdate) AS updated_at
  FROM orders GROUP BY o_custkey),
source AS (
  SELECT customer_id + 1 AS customer_id, name, city, segment, signup_date, updated_at
  FROM dim LEFT JOIN dates ON customer_id = o_custkey)
"""

CORRUPT = """
corrupt AS (
  SELECT CASE WHEN customer_id % 50 = 3 THEN 'abc'
      WHEN customer_id % 50 = 7 THEN CAST(-customer_id AS VARCHAR)
      WHEN customer_id % 50 = 11 THEN '1' ELSE CAST(customer_id AS VARCHAR) END AS customer_id,
    CASE WHEN customer_id % 40 = 1 THEN NULL WHEN customer_id % 40 = 2 THEN '   '
      ELSE name END AS name,
    city,
    CASE WHEN customer_id % 30 = 5 THEN 'Platinum' ELSE segment END AS segment,
    CASE WHEN customer_id % 60 = 9 THEN 'not-a-date' WHEN customer_id % 60 = 10 THEN '2030-01-01'
      ELSE strftime(coalesce(signup_date, TIMESTAMP '1992-01-01'), '%Y-%m-%d') END AS signup_date,
    least(coalesce(updated_at, TIMESTAMP '1992-01-01'), TIMESTAMP '2001-07-25') AS updated_at
  FROM source JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR customer_id % 200 = 13)
"""

_ALLOWED = ", ".join(f"'{s}'" for s in SEGMENTS)


def _gate(table: str) -> str:
    """The thirteen checks over ``table``, as rows."""
    return f"""
m AS (
  SELECT count(*) AS n,
    greatest(avg(CAST(customer_id IS NULL AS INT)), avg(CAST(name IS NULL AS INT)),
      avg(CAST(city IS NULL AS INT)), avg(CAST(segment IS NULL AS INT)),
      avg(CAST(signup_date IS NULL AS INT))) AS worst,
    count(*) FILTER (trim(name) = '') + count(*) FILTER (trim(city) = '')
      + count(*) FILTER (trim(segment) = '') AS blanks,
    count(*) - count(DISTINCT customer_id) - max(CAST(customer_id IS NULL AS INT)) AS surplus,
    count(*) FILTER (TRY_CAST(customer_id AS DOUBLE) IS NULL) AS non_numeric,
    count(*) FILTER (TRY_CAST(customer_id AS DOUBLE) <= 0) AS non_positive,
    count(*) FILTER (segment NOT IN ({_ALLOWED})) AS unexpected,
    count(*) FILTER (TRY_CAST(signup_date AS TIMESTAMP) IS NULL) AS unparseable,
    count(*) FILTER (TRY_CAST(signup_date AS TIMESTAMP) > TIMESTAMP '2001-08-02') AS future,
    max(updated_at) AS newest
  FROM {table}),
s AS (SELECT count(*) AS row_count, max(updated_at) AS newest FROM source),
checks AS (
  SELECT 'row_count_minimum' AS check_name, n >= 1 AS passed, CAST(n AS DOUBLE) AS metric,
    'error' AS severity FROM m
  UNION ALL SELECT 'required_columns_present', true, 0.0, 'error'
  UNION ALL SELECT 'null_rate', worst <= 0, worst, 'error' FROM m
  UNION ALL SELECT 'no_empty_strings', blanks = 0, blanks, 'error' FROM m
  UNION ALL SELECT 'customer_id_unique', surplus = 0, surplus, 'error' FROM m
  UNION ALL SELECT 'customer_id_numeric', non_numeric = 0, non_numeric, 'error' FROM m
  UNION ALL SELECT 'customer_id_positive', non_positive = 0, non_positive, 'error' FROM m
  UNION ALL SELECT 'segment_domain', unexpected = 0, unexpected, 'error' FROM m
  UNION ALL SELECT 'signup_date_parseable', unparseable = 0, unparseable, 'error' FROM m
  UNION ALL SELECT 'signup_date_not_future', future = 0, future, 'warning' FROM m
  UNION ALL SELECT 'row_count_reconciles_with_source', n = row_count, n - row_count, 'error'
    FROM m, s
  UNION ALL SELECT 'snapshot_freshness',
    epoch(TIMESTAMP '2001-08-02' - newest) / 3600.0 <= 26,
    epoch(TIMESTAMP '2001-08-02' - newest) / 3600.0, 'error' FROM m
  UNION ALL SELECT 'no_rows_lost_against_source_watermark', m.newest >= s.newest,
    epoch(m.newest - s.newest), 'error' FROM m, s)
"""


def _sequence(batches: str) -> str:
    """Counters of batches applied in order; ``batches`` adds batch_no to stages."""
    return f"""
WITH {FEED},
batches AS ({batches}),
per_order AS (
  SELECT *, row_number() OVER (PARTITION BY batch_no, order_id ORDER BY lsn DESC) AS r
  FROM batches WHERE stage = 'fresh'),
steps AS (
  SELECT *, max(lsn) OVER before AS stored_lsn, arg_max(op, lsn) OVER before AS stored_op
  FROM per_order WHERE r = 1
  WINDOW before AS (PARTITION BY order_id ORDER BY batch_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
labelled AS (
  SELECT *, CASE WHEN lsn <= stored_lsn THEN 'stale' WHEN op = 'D' THEN 'delete'
    ELSE 'upsert' END AS outcome FROM steps),
per_batch AS (
  SELECT batch_no, count(*) AS processed, count(*) FILTER (stage = 'fresh') AS accepted,
    count(*) FILTER (stage = 'invalid') AS invalid, count(*) FILTER (stage = 'late') AS late
  FROM batches GROUP BY batch_no),
per_winner AS (
  SELECT batch_no, count(*) AS w, count(*) FILTER (outcome = 'stale') AS stale,
    count(*) FILTER (outcome = 'upsert') AS upserts,
    count(*) FILTER (outcome = 'delete') AS deletes,
    count(*) FILTER (outcome = 'delete' AND stored_op <> 'D') AS deletes_effective,
    count(*) FILTER (outcome <> 'stale' AND op = 'I') AS inserts,
    count(*) FILTER (outcome <> 'stale' AND op = 'U') AS updates
  FROM labelled GROUP BY batch_no),
counters AS (
  SELECT batch_no, processed, accepted, invalid, late, accepted - w AS superseded, stale,
    upserts, deletes, deletes_effective, inserts, updates, CAST(0 AS BIGINT) AS unknown_ops,
    processed = invalid + late + (accepted - w) + stale + upserts + deletes AS reconciles
  FROM per_batch JOIN per_winner USING (batch_no))
"""


_COUNTS = """processed, accepted, invalid, late, superseded, stale, upserts, deletes,
  deletes_effective, inserts, updates, unknown_ops, reconciles"""
_TWO = "SELECT *, CASE WHEN part = 1 THEN 1 ELSE 0 END AS batch_no FROM stages"
_SERVED = """SELECT _id, order_id, op, customer_id, amount, product_category, event_time, lsn,
  name, city, segment FROM facts"""
_FINAL_KEYS = f"WITH {FEED} SELECT order_id, lsn, op FROM winners WHERE op <> 'D'"
_MATCHED = f"""
WITH {FEED}, {DIMENSION}
SELECT w.order_id, CAST(w.customer_id AS INTEGER) AS customer_id, d.name, d.city, d.segment
FROM winners w LEFT JOIN dim d ON w.customer_id = d.customer_id AND d.balance >= 0
WHERE w.op <> 'D'"""
_MOVED = f"""CASE segment {' '.join(
    f"WHEN '{a}' THEN '{b}'" for a, b in zip(SEGMENTS, SEGMENTS[1:] + SEGMENTS[:1]))} END"""
HISTORY = f"""
WITH {FEED}, {DIMENSION},
history AS (
  SELECT customer_id, name, city, segment, TIMESTAMP '2024-01-01' AS valid_from,
    CASE WHEN customer_id % 10 = 0 THEN TIMESTAMP '2024-01-16' END AS valid_to,
    customer_id % 10 <> 0 AS is_current
  FROM dim
  UNION ALL
  SELECT customer_id, name, city, {_MOVED}, TIMESTAMP '2024-01-16', NULL, true
  FROM dim WHERE customer_id % 10 = 0)
"""
_AS_OF = f"""{HISTORY}
SELECT s.lsn, s.order_id, CAST(s.customer_id AS INTEGER) AS customer_id, h.name, h.city, h.segment,
  h.valid_from
FROM stages s LEFT JOIN history h ON s.customer_id = h.customer_id
  AND s.event_time >= h.valid_from AND (h.valid_to IS NULL OR s.event_time < h.valid_to)
WHERE s.stage = 'fresh'"""
_CUSTOMER_COLUMNS = "customer_id, name, city, segment, signup_date, updated_at"

ORACLES: dict[str, str] = {
    "parse_payload": f"""WITH {FEED}
SELECT pos AS "offset", op, order_id, customer_id, amount, product_category, event_time, lsn
FROM sent""",
    "split_valid": f"""WITH {FEED} SELECT pos AS "offset", lsn FROM stages WHERE stage <> 'invalid'""",
    "split_invalid": f"""WITH {FEED}
SELECT pos AS "offset", sent.lsn, kind AS rule
FROM stages JOIN sent USING (pos) WHERE stage = 'invalid'""",
    "invalid_by_rule": f"""WITH {FEED}
SELECT kind AS rule, count(*) AS n FROM stages WHERE stage = 'invalid' GROUP BY kind""",
    "accepted_events": f"""WITH {FEED}
SELECT lsn, op, order_id, CAST(customer_id AS INTEGER) AS customer_id, amount,
  product_category, event_time FROM stages WHERE stage <> 'invalid'""",
    "late_events": f"""WITH {FEED}
SELECT lsn, order_id, op, age_s FROM stages WHERE stage <> 'invalid' AND age_s > 3600""",
    "fresh_events": f"""WITH {FEED}
SELECT lsn, order_id, op, age_s FROM stages WHERE stage <> 'invalid' AND age_s <= 3600""",
    "latest_per_order": f"WITH {FEED} SELECT order_id, lsn, op, amount FROM winners",
    "superseded_events": f"WITH {FEED} SELECT order_id, lsn, op FROM ranked WHERE rn > 1",
    "stored_lsn_lookup": f"""{TWO_BATCHES}
SELECT order_id, lsn AS stored_lsn, op AS stored_op FROM state_a
WHERE order_id IN (SELECT order_id FROM part_b)""",
    "drop_stale": f"""{TWO_BATCHES}
SELECT order_id, lsn, op, amount, outcome FROM guarded WHERE outcome <> 'stale'""",
    "event_outcomes": f"""{TWO_BATCHES}
SELECT s.pos AS "offset",
  CASE WHEN s.stage <> 'fresh' THEN s.stage ELSE coalesce(g.outcome, 'superseded') END AS outcome
FROM stages s LEFT JOIN guarded g ON g.pos = s.pos WHERE s.part = 1""",
    "feed_outcomes": f"""WITH {FEED}
SELECT s.pos AS "offset", CASE WHEN s.stage <> 'fresh' THEN s.stage
  WHEN w.pos IS NULL THEN 'superseded' WHEN w.op = 'D' THEN 'delete' ELSE 'upsert' END AS outcome
FROM stages s LEFT JOIN winners w ON w.pos = s.pos""",
    "stream_outcomes": f"""{TWO_BATCHES}
SELECT s.pos AS "offset",
  CASE WHEN s.stage <> 'fresh' THEN s.stage WHEN a.ra = 1 AND a.op = 'D' THEN 'delete'
    WHEN a.ra = 1 THEN 'upsert' ELSE coalesce(g.outcome, 'superseded') END AS outcome
FROM stages s LEFT JOIN part_a a ON a.pos = s.pos LEFT JOIN guarded g ON g.pos = s.pos""",
    "op_mix": f"WITH {FEED} SELECT op, count(*) AS n FROM winners GROUP BY op",
    "batch_counters": f"{_sequence(_TWO)} SELECT batch_no AS batch_id, {_COUNTS} FROM counters",
    "cdc_deletes": f"WITH {FEED} SELECT order_id, lsn FROM winners WHERE op = 'D'",
    "order_facts": f"{FACTS} {_SERVED}",
    "enrich_orders": _MATCHED,
    "enrich_orders_shuffled": _MATCHED,
    "dim_enrich_columns": f"WITH {DIMENSION} SELECT customer_id, name, city, segment FROM dim",
    "sink_peek": f"{FACTS} {_SERVED} ORDER BY _id LIMIT 5",
    "sink_audit": f"""{FACTS}
SELECT count(*) AS documents, count(DISTINCT order_id) AS distinct_orders,
  count(*) - count(DISTINCT order_id) AS duplicates,
  count(*) FILTER (name IS NULL) AS enrichment_nulls,
  count(*) = count(DISTINCT order_id) AS sound FROM facts""",
    "sink_op_mix": f"{FACTS} SELECT op, count(*) AS n FROM facts GROUP BY op",
    "dlq_payloads": f"""WITH {FEED}
SELECT coalesce(sent.order_id, '') AS key,
  CASE WHEN stage = 'late' THEN 'late_event' ELSE 'schema_or_parse_failure' END AS reject_reason,
  sent.order_id, sent.op, sent.customer_id, sent.lsn, pos AS "offset", true AS has_payload
FROM stages JOIN sent USING (pos) WHERE stage <> 'fresh'""",
    "dlq_triage": f"""WITH {FEED}
SELECT CASE WHEN stage = 'late' THEN 'late_event' ELSE 'schema_or_parse_failure' END
    AS reject_reason,
  date_trunc('hour', arrived) AS window_start, count(*) AS n
FROM stages WHERE stage <> 'fresh' GROUP BY 1, 2""",
    "out_of_order_apply": f"{FACTS} {_SERVED}",
    "hard_delete_apply": f"""{TWO_BATCHES},
held AS (SELECT * FROM state_a WHERE op <> 'D'),
applied AS (
  SELECT b.order_id, b.lsn, b.op FROM part_b b LEFT JOIN held h ON h.order_id = b.order_id
  WHERE b.rb = 1 AND (h.lsn IS NULL OR b.lsn > h.lsn))
SELECT order_id, lsn, op FROM applied WHERE op <> 'D'
UNION ALL
SELECT order_id, lsn, op FROM held WHERE order_id NOT IN (SELECT order_id FROM applied)""",
    "replay_idempotence": f"""{_sequence(_TWO + " UNION ALL SELECT *, 2 AS batch_no FROM stages")}
SELECT CASE batch_no WHEN 2 THEN 'replay' ELSE 'delivery' END AS run_id,
  CAST(batch_no % 2 AS BIGINT) AS batch_id, {_COUNTS} FROM counters""",
    "backfill_range": FACTS.replace(
        "FROM events)",
        "FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20')",
    ) + _SERVED,
    "stream_order_facts": f"{FACTS} {_SERVED}",
    "stream_lsn_state": f"""{FACTS}
SELECT order_id, lsn, op, amount, name, city, segment FROM facts""",
    "dim_extract": f"WITH {SOURCE} SELECT {_CUSTOMER_COLUMNS} FROM source",
    "dim_snapshot": f"""WITH {SOURCE}
SELECT customer_id, name, city,
  CASE WHEN customer_id % 10 = 0 THEN {_MOVED} ELSE segment END AS segment, signup_date,
  updated_at + INTERVAL 1 DAY AS updated_at FROM source""",
    "dim_refresh": f"""WITH {SOURCE}
SELECT customer_id, name, city, segment FROM source""",
    "source_baseline": f"""WITH {SOURCE}
SELECT count(*) AS row_count, max(updated_at) AS max_updated_at FROM source""",
    "dq_report": f"WITH {SOURCE}, {_gate('source')} SELECT * FROM checks",
    "dq_report_corrupt": f"WITH {SOURCE}, {CORRUPT}, {_gate('corrupt')} SELECT * FROM checks",
    "dq_summary": f"""WITH {SOURCE}, {CORRUPT}, {_gate('corrupt')}
SELECT count(*) FILTER (passed) AS passed,
  count(*) FILTER (NOT passed AND severity = 'warning') AS warnings,
  count(*) FILTER (NOT passed AND severity = 'error') AS failures,
  bool_and(passed OR severity = 'warning') AS ok FROM checks""",
    "dq_null_rates": f"""WITH {SOURCE}, {CORRUPT}
SELECT 'customer_id' AS column_name, avg(CAST(customer_id IS NULL AS INT)) AS null_rate FROM corrupt
UNION ALL SELECT 'name', avg(CAST(name IS NULL AS INT)) FROM corrupt
UNION ALL SELECT 'city', avg(CAST(city IS NULL AS INT)) FROM corrupt
UNION ALL SELECT 'segment', avg(CAST(segment IS NULL AS INT)) FROM corrupt
UNION ALL SELECT 'signup_date', avg(CAST(signup_date IS NULL AS INT)) FROM corrupt""",
    "dq_unexpected_segments": f"""WITH {SOURCE}, {CORRUPT}
SELECT segment AS value, count(*) AS n FROM corrupt
WHERE segment NOT IN ({_ALLOWED}) GROUP BY segment""",
    "lag_by_partition": """WITH o AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS "partition", count(*) AS end_offset,
    CASE WHEN event_id % 3 <> 2 THEN count(*) FILTER (ts < TIMESTAMP '2024-01-15') END
      AS committed_offset
  FROM events GROUP BY event_id % 3)
SELECT 'orders_stream' AS topic, "partition", end_offset, committed_offset,
  end_offset - coalesce(committed_offset, 0) AS lag FROM o""",
    "lag_total": """SELECT 'orders_stream' AS topic,
  count(*) - count(*) FILTER (event_id % 3 <> 2 AND ts < TIMESTAMP '2024-01-15') AS total_lag,
  count(*) - count(*) FILTER (event_id % 3 <> 2 AND ts < TIMESTAMP '2024-01-15') > 200000
    AS over_threshold FROM events""",
    "revenue_segment_city": f"""{FACTS}
SELECT time_bucket(INTERVAL 15 MINUTE, event_time) AS window_start, segment, city,
  round(sum(amount), 2) AS revenue, count(*) AS orders FROM facts GROUP BY 1, 2, 3""",
    "revenue_trailing": f"""{FACTS}
SELECT segment, city, round(sum(amount), 2) AS revenue, count(*) AS orders FROM facts
WHERE event_time > TIMESTAMP '2024-01-15' AND event_time <= TIMESTAMP '2024-01-16'
GROUP BY segment, city""",
    "counter_trend": f"""{_sequence("SELECT *, pos * 7 % 24 AS batch_no FROM stages")},
shares AS (
  SELECT batch_no AS batch_id, superseded / processed AS a, stale / processed AS b FROM counters)
SELECT batch_id, round(a, 6) AS superseded_share, round(b, 6) AS stale_share,
  round(avg(a) OVER w, 6) AS superseded_trend, round(avg(b) OVER w, 6) AS stale_trend
FROM shares
WINDOW w AS (ORDER BY batch_id RANGE BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "dim_scd2": f"""{HISTORY}
SELECT customer_id, name, city, segment, valid_from, valid_to, is_current FROM history""",
    "enrich_as_of": _AS_OF,
    "enrich_as_of_shuffled": _AS_OF,
}
# A stream gives what the batch gives.
ORACLES |= {
    "stream_counters": ORACLES["batch_counters"],
    "stream_revenue": ORACLES["revenue_segment_city"],
    "stream_triage": ORACLES["dlq_triage"],
}
