"""Late data and timers over a finished table, exact per record.

A stream's watermark moves once per micro-batch. Replaying a table in arrival order
shows what a watermark that moves with every record would do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.operators.ordered import Running, with_running
from rillmark.operators.windows import interval, with_window


def with_watermark_replay(
    df: DataFrame,
    *,
    ts: str,
    arrival: Names,
    delay: str,
    before_record: bool = True,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add the ``watermark`` at each record: the largest time so far less the delay.

    ``before_record`` takes the state before the record itself; the first one has none.
    """
    seen = with_running(
        df,
        keys=None,
        order=arrival,
        measures={"_seen": Running("max", F.col(ts))},
        exclusive=before_record,
        slice_rows=slice_rows,
    )
    return seen.withColumn("watermark", F.col("_seen") - interval(delay)).drop("_seen")


def classify_late(
    df: DataFrame,
    *,
    ts: str,
    arrival: Names,
    delay: str,
    size: str,
    lateness: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Tag each record ``on_time``, ``refire`` (its window has fired but is kept) or ``late``."""
    seen = with_watermark_replay(df, ts=ts, arrival=arrival, delay=delay, slice_rows=slice_rows)
    windowed = with_window(seen, ts, size)
    tag = (
        F.when(F.col("watermark").isNull() | (F.col("window_end") > F.col("watermark")), "on_time")
        .when(F.col("window_end") + interval(lateness) > F.col("watermark"), "refire")
        .otherwise("late")
    )
    return windowed.withColumn("arrival_class", tag)


def late_window_counts(classified: DataFrame, *, key: Names) -> DataFrame:
    """Per key and window: the count with late updates, the count at first firing, the updates.

    Records tagged ``late`` belong to the side output and are not counted.
    """
    updates = F.count_if(F.col("arrival_class") == "refire")
    return (
        classified.filter(F.col("arrival_class") != "late")
        .groupBy(*names(key), "window_start", "window_end")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.count_if(F.col("arrival_class") == "on_time").alias("first_cnt"),
            updates.alias("updates"),
        )
    )


def late_rows(classified: DataFrame) -> DataFrame:
    """The side output of records that came after their window was dropped."""
    return classified.filter(F.col("arrival_class") == "late").drop("arrival_class")


def timer_firings(df: DataFrame, *, key: Names, ts: str, after: str) -> DataFrame:
    """Every (key, time) at which a timer set by each record fires, once."""
    return df.select(*names(key), (F.col(ts) + interval(after)).alias("fires_at")).distinct()
