"""Drain a bounded stream into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from rillmark.session import shared_folder
from rillmark.sinks.keyed import AddingSink, KeyedSink, KeyedTable
from rillmark.sinks.writers import append_stream, changelog_stream, checkpointed, merge_batch


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process all that is there, however long it takes, then stop."""
    query = checkpointed(writer, checkpoint, every=None).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def drain_appended(df: DataFrame) -> DataFrame:
    """The final rows of an append-mode stream, by way of Parquet files."""
    spark = df.sparkSession
    path = shared_folder(spark, "stream")
    drain(append_stream(df).format("parquet").option("path", f"{path}/out"), f"{path}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def drain_updated(df: DataFrame, key: list[str], buckets: int = 8) -> DataFrame:
    """The current row of each key of an update-mode stream."""
    spark = df.sparkSession
    path = shared_folder(spark, "stream")
    table = KeyedTable(spark, f"{path}/rows", df.schema, key, buckets)
    drain(changelog_stream(df).foreachBatch(KeyedSink(table)), f"{path}/checkpoint")
    return table.read()


def drain_added(df: DataFrame, new: Callable[[DataFrame], DataFrame], key: list[str], sums: list[str], buckets: int = 8) -> DataFrame:
    """Sums per key of a whole stream, of which ``new`` gives those of a micro-batch."""
    spark = df.sparkSession
    path = shared_folder(spark, "stream")
    table = KeyedTable(spark, f"{path}/rows", new(df).schema, key, buckets)
    drain(df.writeStream.foreachBatch(AddingSink(table, new, sums)), f"{path}/checkpoint")
    return table.read()


def drain_complete(df: DataFrame) -> DataFrame:
    """The whole result of a complete-mode stream after its last micro-batch."""
    spark = df.sparkSession
    path = shared_folder(spark, "stream")
    last = -1

    def sink(rows: DataFrame, batch_id: int) -> None:
        nonlocal last
        merge_batch(f"{path}/out")(rows, batch_id)
        last = batch_id

    drain(df.writeStream.outputMode("complete").foreachBatch(sink), f"{path}/checkpoint")
    return spark.read.schema(df.schema).parquet(f"{path}/out/batch={last}") if last >= 0 else spark.createDataFrame([], df.schema)


def drain_each(df: DataFrame, sink: Callable[[DataFrame, int], None]) -> None:
    """Hand every micro-batch to a sink."""
    path = shared_folder(df.sparkSession, "stream")
    drain(df.writeStream.foreachBatch(sink), f"{path}/checkpoint")
