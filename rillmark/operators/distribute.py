"""How rows are spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names


def by_key(df: DataFrame, key: Names, parts: int | None = None) -> DataFrame:
    """All rows of a key in one task. Aggregates and joins do this by themselves, after
    partial aggregation; ask for it only where the layout itself is wanted."""
    return df.repartition(*([parts] if parts else []), *names(key))


def at_random(df: DataFrame, parts: int, seed: int = 0) -> DataFrame:
    return df.repartition(parts, F.rand(seed))


def round_robin(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts)


def rescale(df: DataFrame, parts: int, current: int) -> DataFrame:
    """Fewer tasks by merging neighbours without a shuffle, more tasks by a shuffle."""
    return df.coalesce(parts) if parts <= current else df.repartition(parts)


def copy_to_all(df: DataFrame, parts: int, copy: str = "copy") -> DataFrame:
    """Every row once in each of ``parts`` tasks. For a join use ``broadcast`` instead."""
    copies = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return copies.repartitionById(parts, F.col(copy))


def to_one_task(df: DataFrame, *aggs: Column) -> DataFrame:
    """What one task would find over all rows. Each task sends its partial aggregate there, never its rows."""
    return df.agg(*aggs)


def by_rule(df: DataFrame, parts: int, task: Column) -> DataFrame:
    """Send each row to the task whose number the expression gives."""
    return df.repartitionById(parts, task.cast("int"))
