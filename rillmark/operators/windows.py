"""Time and count windows.

Time windows aggregate straight from the scan, so Spark combines rows before the
shuffle and a hot key costs one row per window and input task. Windows that overlap
(hopping, cumulating) first aggregate short panes and spread the panes, not the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillmark.columns import Names, names, split_window
from rillmark.functions.aggregate import Mergeable, floor_div, integer_avg, merged, partials, rows
from rillmark.functions.time import epoch_ms
from rillmark.operators.ordered import (
    Running,
    Slices,
    cut,
    with_position,
    with_row_frames,
    with_running,
)


def interval(text: str) -> Column:
    return F.expr(f"interval {text}")


MICROS = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def length(text: str) -> int | None:
    """Microseconds of an interval such as ``10 seconds`` or ``1 day 2 hours``; None if it is written another way."""
    parts = text.lower().split()
    total = 0
    for number, unit in zip(parts[::2], parts[1::2]):
        unit = unit.removesuffix("s")
        if not number.isdigit() or unit not in MICROS:
            return None
        total += int(number) * MICROS[unit]
    return total if parts and len(parts) % 2 == 0 else None


def divides(step: str, size: str) -> bool:
    """Whether an interval is known to be a whole number of steps."""
    a, b = length(size), length(step)
    return bool(a and b) and a % b == 0


def with_window(df: DataFrame, ts: str, size: str, slide: str | None = None, offset: str | None = None) -> DataFrame:
    """Add ``window_start`` and ``window_end`` to each row, once per window that holds it."""
    w = F.window(ts, size, slide or size, offset) if offset else F.window(ts, size, slide)
    return split_window(df.select("*", w.alias("window")))


def tumble(
    df: DataFrame,
    *,
    ts: str,
    size: str,
    key: Names | None = None,
    aggs: list[Column] | None = None,
    offset: str | None = None,
) -> DataFrame:
    """Aggregate per key and fixed window; ``offset`` shifts the window starts."""
    w = F.window(ts, size, size, offset) if offset else F.window(ts, size)
    found = df.groupBy(*names(key), w.alias("window")).agg(*(aggs or partials(rows())))
    return split_window(found)


def hop(
    df: DataFrame,
    *,
    ts: str,
    size: str,
    slide: str,
    key: Names | None = None,
    measures: dict[str, Mergeable] | None = None,
    panes: bool = True,
) -> DataFrame:
    """Aggregate per key and sliding window.

    With ``panes``, and if ``size`` is a multiple of ``slide``, rows are first aggregated per
    slide-long pane and only panes are spread over windows: best where a key has several rows per pane. For sparse keys, where panes
    are hardly fewer than rows, the built-in window saves a shuffle. Streams always use the
    latter, which every output mode allows.
    """
    measures = measures or rows()
    if df.isStreaming or not panes or not divides(slide, size):
        found = df.groupBy(*names(key), F.window(ts, size, slide).alias("window")).agg(*partials(measures))
        return split_window(found)
    per_pane = tumble(df, ts=ts, size=slide, key=key, aggs=partials(measures))
    first = F.col("window_start") - interval(size) + interval(slide)
    starts = F.sequence(first, F.col("window_start"), interval(slide))
    spread = per_pane.withColumn("window_start", F.explode(starts)).withColumn(
        "window_end", F.col("window_start") + interval(size)
    )
    return spread.groupBy(*names(key), "window_start", "window_end").agg(*merged(measures))


def cumulate(
    df: DataFrame,
    *,
    ts: str,
    size: str,
    step: str,
    key: Names | None = None,
    measures: dict[str, Mergeable] | None = None,
) -> DataFrame:
    """Windows that start together and grow by ``step`` up to ``size``, a multiple of it.

    On a stream this needs append mode, as one aggregation follows another.
    """
    if not divides(step, size):
        raise ValueError(f"{size} is no multiple of {step}")
    measures = measures or rows()
    if df.isStreaming:
        per_step = df.groupBy(*names(key), F.window(ts, step).alias("pane")).agg(*partials(measures))
        whole = F.window(F.window_time("pane"), size)
        panes = per_step.select(*names(key), *measures, whole.alias("window"), F.col("pane.end").alias("at"))
        ends = F.sequence(F.col("at"), F.col("window.end"), interval(step))
        spread = panes.withColumn("window_end", F.explode(ends)).groupBy(*names(key), "window", "window_end")
        found = spread.agg(*merged(measures))
        return found.select(*names(key), F.col("window.start").alias("window_start"), "window_end", *measures)
    panes = tumble(df, ts=ts, size=step, key=key, aggs=partials(measures))
    whole = F.window("window_start", size)
    ends = F.sequence(F.col("window_end"), F.col("whole.end"), interval(step))
    spread = panes.withColumn("whole", whole).select(
        *names(key),
        *measures,
        F.col("whole.start").alias("window_start"),
        F.explode(ends).alias("window_end"),
    )
    return spread.groupBy(*names(key), "window_start", "window_end").agg(*merged(measures))


def session(
    df: DataFrame,
    *,
    ts: str,
    gap: str,
    key: Names,
    measures: dict[str, Mergeable] | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Aggregate per key and session; a session ends where the pause is longer than ``gap``.

    Rows of a key in one gap-long bucket always share a session. A batch table is
    therefore aggregated per bucket before the shuffle, and sessions are built from
    buckets. A stream uses the built-in session window.
    """
    measures = measures or rows()
    keys = names(key)
    if df.isStreaming:
        w = F.session_window(ts, gap)
        return split_window(df.groupBy(*keys, w.alias("window")).agg(*partials(measures)))
    # Hot keys are cut on the narrow input; a bucket lies in one slice, as its rows share its start.
    placed = df.withColumn("_bucket", F.window(ts, gap)["start"])
    cuts = cut(placed, keys, "_bucket", slice_rows)
    group = keys + cuts.columns
    buckets = cuts.df.groupBy(*group, "_bucket").agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), *partials(measures)
    )
    found = _linked(buckets, group, gap, measures)
    if cuts.columns:
        # Only the first and the last session of a slice can go on in another slice.
        w = Window.partitionBy(*group)
        ends = (F.col("_session") == 1) | (F.col("_session") == F.max("_session").over(w))
        marked = found.withColumn("_ends", ends)
        inner = marked.filter(~F.col("_ends")).drop("_ends", *cuts.columns)
        outer = _linked(marked.filter("_ends"), keys, gap, measures)
        found = inner.unionByName(outer)
    return found.select(
        *keys, F.col("_first").alias("window_start"), (F.col("_last") + interval(gap)).alias("window_end"), *measures
    )


def _linked(spans: DataFrame, group: list[str], gap: str, measures: dict[str, Mergeable]) -> DataFrame:
    """Join the spans of a group, each from ``_first`` to ``_last``, that lie no more than a gap apart."""
    w = Window.partitionBy(*group).orderBy("_first")
    before = F.lag("_last").over(w)
    fresh = before.isNull() | (F.col("_first") > before + interval(gap))
    numbered = spans.withColumn("_fresh", fresh.cast("bigint")).withColumn("_session", F.sum("_fresh").over(w))
    return numbered.groupBy(*group, "_session").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), *merged(measures)
    )


def count_window(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    size: int,
    aggs: list[Column],
    slice_rows: int | None = None,
) -> DataFrame:
    """Aggregate each ``size`` successive rows of a key; the unfilled rest gives no result."""
    placed = with_position(df, keys=key, order=order, name="_pos", slice_rows=slice_rows)
    return count_window_at(placed, key=key, position="_pos", size=size, aggs=aggs)


def count_window_at(placed: DataFrame, *, key: Names, position: str, size: int, aggs: list[Column]) -> DataFrame:
    """``count_window`` of rows that are numbered from 1 within their key."""
    number = floor_div(F.col(position) - 1, F.lit(size).cast("bigint"))
    return (
        placed.groupBy(*names(key), number.alias("window_no"))
        .agg(*aggs, F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") == size)
        .drop("_n")
    )


def count_window_sliding(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    size: int,
    slide: int,
    aggs: dict[str, Column],
    slice_rows: int | None = None,
) -> DataFrame:
    """After each ``slide`` rows of a key, aggregate its last ``size`` rows, or fewer at the start."""
    cuts = cut(df, key, order, slice_rows)
    framed = with_row_frames(
        df,
        keys=key,
        order=order,
        before=size - 1,
        columns={n: (lambda w, a=a: a.over(w.rowsBetween(-(size - 1), 0))) for n, a in aggs.items()},
        sliced=cuts,
    )
    placed = with_running(
        framed,
        keys=key,
        order=order,
        measures={"position": Running("count", F.lit(1))},
        sliced=Slices(framed, cuts.columns, cuts.count),
    )
    return placed.filter(F.col("position") % slide == 0).select(*names(key), "position", *aggs)


def avg_event_time(df: DataFrame, *, key: Names, ts: str, size: str) -> DataFrame:
    """Average event time per key and window, in whole epoch milliseconds."""
    return tumble(df, ts=ts, size=size, key=key, aggs=[integer_avg(epoch_ms(ts)).alias("avg_ms")])


def pv_uv(df: DataFrame, *, ts: str, size: str, user: str) -> DataFrame:
    """Views, distinct users and views per user of each window over all keys.

    Users are counted in two steps, per (window, user) and then per window, so no
    window's rows or users meet in one task. On a stream this needs append mode.
    """
    per_user = df.groupBy(F.window(ts, size).alias("window"), user).agg(F.count(F.lit(1)).alias("_n"))
    found = per_user.groupBy("window").agg(F.sum("_n").alias("pv"), F.count(user).alias("uv"))
    return split_window(found.withColumn("pv_per_uv", F.col("pv") / F.col("uv")))


