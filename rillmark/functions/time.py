"""Time expressions over epoch milliseconds and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(col(ms))


def epoch_ms(ts: Column | str) -> Column:
    """Timestamp to epoch milliseconds, rounding down."""
    return F.unix_millis(col(ts).cast("timestamp"))


def unixtime_text(ms: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch milliseconds to second-precision text."""
    return F.from_unixtime(F.floor(col(ms) / 1000), pattern)


def parse_timestamp(text: Column | str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp(col(text), pattern)


def processing_time() -> Column:
    """The clock at the start of the batch or micro-batch."""
    return F.current_timestamp()


def minus(ts: Column | str, interval: str) -> Column:
    """A timestamp less an interval given as text, such as ``1 second``."""
    return col(ts) - F.expr(f"interval {interval}")


def timestamp_text(ms: Column | str) -> Column:
    """Epoch milliseconds to text with a fraction that drops trailing zeros but keeps one digit."""
    text = F.date_format(event_time(ms), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, "(\\.\\d+?)0*$", "$1")


def window_start_ms(ms: Column | str, size_ms: int) -> Column:
    """Start of the tumbling window that holds a non-negative epoch millisecond value."""
    m = col(ms)
    return m - F.pmod(m, F.lit(size_ms).cast("bigint"))


def window_end(window: str = "window") -> Column:
    return F.col(f"{window}.end")
