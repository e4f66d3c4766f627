"""Messages and dimensions built by hand."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from tidemark import contract as C

NOW = datetime(2024, 5, 1, 12, 0, tzinfo=timezone.utc)


def event(order_id="a", lsn=1, op="U", age_s=0, **fields) -> dict:
    return {
        "op": op, "order_id": order_id, "customer_id": 1, "amount": 10.5,
        "product_category": "Home", "lsn": lsn,
        "event_time": (NOW - timedelta(seconds=age_s)).isoformat(), **fields,
    }


def messages(spark, payloads, first_offset=0):
    """Payloads (dict, text, or None) as messages that arrive at NOW."""
    rows = []
    for i, p in enumerate(payloads):
        text = json.dumps(p) if isinstance(p, dict) else p
        value = None if text is None else bytearray(text.encode())
        rows.append((None, value, C.ORDERS_TOPIC, i % 3, first_offset + i, NOW))
    return spark.createDataFrame(rows, C.MESSAGE)


def dimension(spark, n=3):
    return spark.createDataFrame(
        [(i, f"name {i}", "Chennai", "Premium") for i in range(1, n + 1)],
        "customer_id int, name string, city string, segment string")
