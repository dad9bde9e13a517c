"""Registry of queries over the given tables, and access to those tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.registry import register_functions
from rillmark.functions.time import epoch_ms
from rillmark.session import shared_folder, use_utc

ORIGIN = "TIMESTAMP '1970-01-01'"


@dataclass(frozen=True)
class Tables:
    """The Parquet tables of one folder."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def events(self) -> DataFrame:
        return self.table("events")

    def event(self, *types: str) -> DataFrame:
        """Key, time and id of the events of some types."""
        chosen = self.events.filter(F.col("event_type").isin(*types))
        return chosen.select("user_id", "ts", "event_id")

    def clicks(self) -> DataFrame:
        """Events in the shape of click records: username, url, epoch milliseconds."""
        return self.events.select(
            F.col("user_id").cast("string").alias("username"),
            F.col("event_type").alias("url"),
            epoch_ms("ts").alias("timestamp"),
        )

    def register(self, *tables: str) -> SparkSession:
        """Name tables and functions for SQL text."""
        for name in tables:
            self.table(name).createOrReplaceTempView(name)
        register_functions(self.spark)
        return self.spark

    def scratch(self, purpose: str) -> str:
        return shared_folder(self.spark, purpose)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a query; ``sql`` is the same question for another engine."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(use_utc(spark), folder))
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def bucket(size: str, ts: str = "ts") -> str:
    """SQL for the start of the fixed window that holds a time."""
    return f"time_bucket(INTERVAL '{size}', {ts}, {ORIGIN})"


MS = "(epoch_us(ts) // 1000)"
