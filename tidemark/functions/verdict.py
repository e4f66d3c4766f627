"""The verdict on one parsed order event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract as C
from tidemark.functions.safe import instant

_FIELDS = C.REQUIRED_EVENT_FIELDS


def broken_rule(cfg: C.PipelineConfig) -> Column:
    """Name of the first broken rule, NULL for a valid event.

    NULL fields are settled first, so no later predicate can be NULL and every
    event ends up either valid or rejected.
    """
    amount = C.AMOUNT_PATTERN if cfg.strict_amount else C.AMOUNT_PATTERN_RENDERED
    return F.expr(f"""
        CASE
          WHEN coalesce({', '.join(f'CAST({f} AS STRING)' for f in _FIELDS)}) IS NULL
            THEN 'unparseable'
          WHEN {' OR '.join(f'{f} IS NULL' for f in _FIELDS)} THEN 'missing_field'
          WHEN op NOT IN ({', '.join(f"'{op}'" for op in C.OPS)}) THEN 'unknown_op'
          WHEN NOT customer_id RLIKE r'{C.CUSTOMER_ID_PATTERN}' THEN 'customer_id_not_numeric'
          WHEN try_cast(customer_id AS {cfg.customer_id_type}) IS NULL THEN 'customer_id_out_of_range'
          WHEN NOT amount RLIKE r'{amount}' THEN 'amount_not_numeric'
          WHEN NOT product_category RLIKE r'{C.CATEGORY_PATTERN}' THEN 'category_malformed'
          WHEN event_time IS NULL THEN 'event_time_unparseable'
        END""")


def age_seconds(cfg: C.PipelineConfig) -> Column:
    """Whole seconds between an event and the clock it is judged by."""
    clock = F.col("arrived_at") if cfg.clock is None else instant(cfg.clock)
    return F.unix_seconds(clock) - F.unix_seconds("event_time")
