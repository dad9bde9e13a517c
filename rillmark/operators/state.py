"""Per-key state over a finished table, as ordered expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.operators.ordered import with_position, with_row_frames
from rillmark.operators.windows import interval


def previous_event(
    df: DataFrame, *, key: Names, order: Names, keep: Names, slice_rows: int | None = None
) -> DataFrame:
    """Add the previous record of the same key as ``prev_*`` columns."""
    columns = {f"prev_{c}": (lambda w, c=c: F.lag(c).over(w)) for c in names(keep)}
    return with_row_frames(df, keys=key, order=order, before=1, columns=columns, slice_rows=slice_rows)


def previous_with_ttl(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    ts: str,
    value: str,
    ttl: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add the key's previous value, unless it is older than ``ttl``."""
    seen = previous_event(df, key=key, order=order, keep=[ts, value], slice_rows=slice_rows)
    alive = F.col(f"prev_{ts}") + interval(ttl) > F.col(ts)
    return seen.withColumn(f"prev_{value}", F.when(alive, F.col(f"prev_{value}"))).drop(f"prev_{ts}")


def history_length(df: DataFrame, *, key: Names, order: Names, slice_rows: int | None = None) -> DataFrame:
    """Length of the key's history after each record. The history itself is the key's rows
    with a position up to this one; written out for every record it would grow squared."""
    return with_position(df, keys=key, order=order, name="history_len", slice_rows=slice_rows)


def recent_history(
    df: DataFrame, *, key: Names, order: Names, value: str, length: int, slice_rows: int | None = None
) -> DataFrame:
    """The last ``length`` values of the key after each record, oldest first."""
    columns = {"history": lambda w: F.collect_list(value).over(w.rowsBetween(-(length - 1), 0))}
    return with_row_frames(
        df, keys=key, order=order, before=length - 1, columns=columns, slice_rows=slice_rows
    )
