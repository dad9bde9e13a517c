"""Per-record operators. Each works alike on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.functions.text import tokens


def project(df: DataFrame, columns: Names, where: Column | None = None) -> DataFrame:
    """Keep some columns of the rows that satisfy a condition."""
    return (df if where is None else df.filter(where)).select(*names(columns))


def tokenize(df: DataFrame, text: str, *, separator: str = " ", token: str = "word") -> DataFrame:
    """One row per token of a text column."""
    return df.select(F.explode(tokens(text, separator)).alias(token))


def pairs(df: DataFrame, key: str, one: str = "n") -> DataFrame:
    """``(key, 1)`` rows."""
    return df.select(key, F.lit(1).cast("bigint").alias(one))


def emit(df: DataFrame, branches: list[tuple[Column, Column]], *, keep: Names, out: str = "out") -> DataFrame:
    """Emit zero, one or several values per record: one for each branch whose condition holds."""
    values = F.array_compact(F.array(*[F.when(cond, value) for cond, value in branches]))
    return df.select(*names(keep), F.explode(values).alias(out))


def map_with_lifecycle(
    df: DataFrame,
    schema: str,
    fn: Callable[[Any, int, pd.DataFrame], pd.DataFrame],
    *,
    open_task: Callable[[int], Any] = lambda task: None,
    close_task: Callable[[Any, int], None] = lambda resource, task: None,
) -> DataFrame:
    """Map batches of rows with a resource that is opened and closed once per task.

    ``fn(resource, task_index, batch)`` gets pandas batches and returns one.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get().partitionId()
        resource = open_task(task)
        try:
            for batch in batches:
                yield fn(resource, task, batch)
        finally:
            close_task(resource, task)

    return df.mapInPandas(run, schema)
