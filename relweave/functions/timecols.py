"""Order columns as one long number: microseconds for time stamps, the value itself for row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MICROS = 1_000_000


def seconds(n: float) -> int:
    return round(n * MICROS)


def minutes(n: float) -> int:
    return seconds(60 * n)


def hours(n: float) -> int:
    return minutes(60 * n)


def days(n: float) -> int:
    return hours(24 * n)


def weeks(n: float) -> int:
    return days(7 * n)


def datetime_literal(year: int, month: int, day: int, hour: int = 0, minute: int = 0, second: int = 0) -> str:
    """SQL literal of a time stamp without zone; comparing with it is pushed to the scan."""
    return f"TIMESTAMP_NTZ'{year:04d}-{month:02d}-{day:02d} {hour:02d}:{minute:02d}:{second:02d}'"


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType))


def order_sql(df: DataFrame, column: str) -> str:
    """SQL text of `column` as a long that keeps its order.

    Zone-less time stamps are counted from the zone-less epoch. Sessions run in UTC
    (see session.SETTINGS), where no day is shorter or longer than the others.
    """
    dtype = df.schema[column].dataType
    quoted = f"`{column}`"
    if isinstance(dtype, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {quoted})"
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({quoted})"
    if isinstance(dtype, T.DateType):
        return f"CAST(unix_date({quoted}) AS BIGINT) * {days(1)}"
    if isinstance(dtype, T.IntegralType):
        return f"CAST({quoted} AS BIGINT)"
    raise TypeError(f"{column}: a time stamp, date or integer is needed, not {dtype.simpleString()}")


def ticks_per_unit(df: DataFrame, column: str) -> int:
    """Divisor from order numbers to the unit used in features: seconds, or rows."""
    return MICROS if is_time(df.schema[column].dataType) else 1
