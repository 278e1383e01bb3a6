"""Epoch-microsecond conversions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICROS = 1_000_000


def whole_seconds(c: Column) -> Column:
    """Epoch micros -> epoch seconds, truncated toward zero (-1.5 s -> -1 s).
    Exact integer arithmetic: a double quotient may round up near a second
    boundary for far-future values."""
    c = c.cast("long")
    return ((c - c % _MICROS) / _MICROS).cast("long")


def micros_to_text(c: Column) -> Column:
    """Epoch micros -> 'yyyy-MM-dd HH:mm:ss' in the session time zone; NULL
    stays NULL."""
    return F.when(c.isNotNull(), F.from_unixtime(whole_seconds(c)))


def micros_to_timestamp(c: Column) -> Column:
    """Epoch micros -> typed timestamp."""
    return F.timestamp_micros(c)


def ts_to_micros(c: Column) -> Column:
    """timestamp or timestamp_ntz -> epoch micros (ntz read as UTC wall time)."""
    return F.unix_micros(c.cast("timestamp"))
