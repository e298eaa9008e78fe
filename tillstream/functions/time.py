"""Event-time helpers. createdTime is epoch milliseconds in a BIGINT."""

from pyspark.sql import Column, functions as F


def event_time_from_millis(col="createdTime") -> Column:
    """BIGINT epoch millis -> TIMESTAMP (what watermarks and windows need)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c)


def now_millis() -> Column:
    """The current time as BIGINT epoch millis (one value for a whole query or micro-batch)."""
    return F.unix_millis(F.current_timestamp())


def millis_of(col) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> BIGINT epoch millis (NTZ read as UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c.cast("timestamp"))
