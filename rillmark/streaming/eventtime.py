"""Event time and watermarks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from rillmark.functions.time import event_time


def with_event_time(df: DataFrame, *, ms: str, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """Add a timestamp from epoch milliseconds and, if a delay is given, a watermark on it.

    A delay of ``0 seconds`` suits times that only rise. A batch table ignores the watermark.
    """
    timed = df.withColumn(ts, event_time(ms))
    return timed.withWatermark(ts, delay) if delay else timed


def with_watermark(df: DataFrame, *, ts: str, delay: str, lateness: str | None = None) -> DataFrame:
    """Watermark a stream; ``lateness`` keeps windows that much longer for late updates.

    With lateness the query runs in update mode, and each trigger with late rows sends
    the changed counts of their windows again. Spark wants a zoned timestamp, so a
    timestamp without zone is read as UTC.
    """
    total = f"{delay} {lateness}" if lateness else delay
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, total)


def current_watermark(query: StreamingQuery) -> str | None:
    """The watermark of the last micro-batch."""
    progress = query.lastProgress
    return progress["eventTime"].get("watermark") if progress else None


class WatermarkLog(StreamingQueryListener):
    """Collects (query, batch, watermark, rows dropped as late) of each micro-batch."""

    def __init__(self) -> None:
        self.seen: list[tuple[str | None, int, str | None, int]] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        dropped = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.seen.append((p.name, p.batchId, (p.eventTime or {}).get("watermark"), dropped))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
