"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Names = str | Iterable[str]


def names(value: Names | None) -> list[str]:
    """One name, several names or none, as a list."""
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def micros(df: DataFrame, column: str) -> Column:
    """A column on a whole-number scale: timestamps in microseconds, numbers as they are."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    raise TypeError(f"order column {column} must hold a timestamp or a whole number, not {kind.simpleString()}")


def split_window(df: DataFrame, column: str = "window") -> DataFrame:
    """Replace a window struct by flat ``window_start`` and ``window_end`` columns."""
    return df.select(
        "*",
        F.col(f"{column}.start").alias("window_start"),
        F.col(f"{column}.end").alias("window_end"),
    ).drop(column)
