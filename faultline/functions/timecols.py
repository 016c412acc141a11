"""Time units. All time arithmetic in faultline runs on integer epoch
microseconds: exact, orderable and free of session-time-zone effects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

US_PER_SECOND = 1_000_000
US_PER_MINUTE = 60 * US_PER_SECOND
US_PER_HOUR = 60 * US_PER_MINUTE
US_PER_DAY = 24 * US_PER_HOUR

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def minutes(n: float) -> int:
    return int(round(n * US_PER_MINUTE))


def hours(n: float) -> int:
    return int(round(n * US_PER_HOUR))


def epoch_micros(df: DataFrame, col: str) -> Column:
    """Epoch microseconds of a timestamp column.

    ``TIMESTAMP_NTZ`` values are read as UTC wall clock (no session zone
    involved); ``TIMESTAMP`` values are instants already."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return F.col(col).cast("long")
    # strings / dates: parse, then treat as UTC wall clock
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, try_cast(`{col}` AS TIMESTAMP_NTZ))")


def micros_to_ntz(c: Column) -> Column:
    """Inverse of ``epoch_micros`` for display columns (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", c, F.expr(_EPOCH_NTZ))


def elapsed_minutes(later_us: Column, earlier_us: Column) -> Column:
    """Minutes between two micro instants as a double (one IEEE division, so
    the value is bit-identical in any engine that divides the same way)."""
    return (later_us - earlier_us).cast("double") / F.lit(float(US_PER_MINUTE))
