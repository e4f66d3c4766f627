"""Casts and tests that give NULL or FALSE for bad text, also in ANSI mode."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings taken as numbers. Spark alone would also take '1d' and 'nan'.
NUMBER_PATTERN = (
    r"^[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
)
_MICROSECOND = timedelta(microseconds=1)
WHITESPACE = " \t\n\r\f\x0b"


def stripped(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def is_blank(column: Column) -> Column:
    """Empty after stripping whitespace; NULL is not blank."""
    return F.coalesce(stripped(column.cast("string")) == "", F.lit(False))


def to_number(column: Column, dtype: T.DataType) -> Column:
    """Value as double, or NULL where the text is not a number."""
    if isinstance(dtype, T.NumericType):
        return column.cast("double")
    text = stripped(column.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_time(column: Column, dtype: T.DataType) -> Column:
    """Value as timestamp, or NULL where the text is not one."""
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(column)
    return column.try_cast("timestamp")


def instant(moment: datetime) -> Column:
    """Literal timestamp; a naive datetime is read as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    micros = (moment - datetime(1970, 1, 1, tzinfo=timezone.utc)) // _MICROSECOND
    return F.timestamp_micros(F.lit(micros).cast("long"))
