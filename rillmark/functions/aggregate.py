"""Aggregate expressions built from mergeable built-ins, so partial aggregation applies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from rillmark.functions.time import col


def floor_div(a: Column, b: Column) -> Column:
    """Integer division that drops the fraction."""
    return F.call_function("div", a, b)


def integer_avg(value: Column | str) -> Column:
    """Average of whole numbers as a whole number."""
    return floor_div(F.sum(col(value)), F.count(col(value)))


def weighted_avg(value: Column | str, weight: Column | str) -> Column:
    """Weighted average in whole numbers; null where the weights sum to zero."""
    v, w = col(value), col(weight)
    return floor_div(F.sum(v * w), F.nullif(F.sum(w), F.lit(0)))


@dataclass(frozen=True)
class Mergeable:
    """An aggregate whose parts can be merged: ``kind`` is count, sum, min or max."""

    kind: str
    column: Column

    def partial(self) -> Column:
        return {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](self.column)

    def merged(self, part: str) -> Column:
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.kind](part)


def rows(name: str = "cnt") -> dict[str, Mergeable]:
    """The plain row count."""
    return {name: Mergeable("count", F.lit(1))}


def partials(measures: dict[str, Mergeable]) -> list[Column]:
    return [m.partial().alias(n) for n, m in measures.items()]


def merged(measures: dict[str, Mergeable]) -> list[Column]:
    return [m.merged(n).alias(n) for n, m in measures.items()]
