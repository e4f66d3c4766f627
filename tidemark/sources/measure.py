"""Sizes that decide whether a table may be copied to every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Memory of a row and of each of its fields beside the text they hold; generous.
ROW_BYTES, FIELD_BYTES = 64, 16


def memory_bytes(frame: DataFrame) -> int:
    """Upper bound of the memory that rows take once decoded, measured on all of them."""
    size = F.lit(ROW_BYTES + FIELD_BYTES * len(frame.columns)).cast("bigint")
    for column in frame.schema:
        if not isinstance(column.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)):
            text = F.octet_length(F.col(column.name).cast("string"))
            size = size + F.coalesce(text, F.lit(0))
    return frame.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
