"""Batch and streaming writers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from rillmark.columns import Names, names


def labelled(df: DataFrame, label: str | None) -> DataFrame:
    return df if label is None else df.select(F.lit(label).alias("label"), "*")


def to_console(df: DataFrame, label: str | None = None, mode: str = "append", columns: Names | None = None) -> DataStreamWriter | None:
    """Show rows, each under an optional label. For a stream, gives the writer to start.

    ``columns`` are those of the table that is shown; rows are mapped to them by name, whatever their own order.
    """
    out = labelled(df.select(*names(columns)) if columns else df, label)
    if df.isStreaming:
        return out.writeStream.format("console").outputMode(mode)
    out.show(truncate=False)
    return None


def append_stream(df: DataFrame) -> DataStreamWriter:
    """Each result row once, when it is final."""
    return df.writeStream.outputMode("append")


def changelog_stream(df: DataFrame) -> DataStreamWriter:
    """Each changed row of an updating result; readers keep the latest per key."""
    return df.writeStream.outputMode("update")


def checkpointed(writer: DataStreamWriter, folder: str, every: str | None = "10 seconds") -> DataStreamWriter:
    """Recover from ``folder``, which all executors share. ``every`` None drains what is there."""
    kept = writer.option("checkpointLocation", folder)
    return kept.trigger(processingTime=every) if every else kept.trigger(availableNow=True)


def to_text_files(
    df: DataFrame, path: str, *, max_records: int = 10_000_000, every: str = "15 minutes", checkpoint: str | None = None
) -> DataStreamWriter | None:
    """Rows of one text column as UTF-8 lines. Files roll by record count and, on a stream, by trigger."""
    if df.isStreaming:
        writer = df.writeStream.format("text").option("path", path).option("maxRecordsPerFile", max_records)
        return checkpointed(writer, checkpoint or f"{path}_checkpoint", every)
    df.write.option("maxRecordsPerFile", max_records).mode("append").text(path)
    return None


def to_csv_table(df: DataFrame, path: str, columns: Names | None = None) -> None:
    """Append to a CSV table, columns picked by name."""
    df.select(*(names(columns) or df.columns)).write.mode("append").csv(path)


def kafka_records(df: DataFrame, value: str, key: str | None = None) -> DataFrame:
    """Rows as Kafka records of text."""
    out = [F.col(value).cast("string").alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*out)


def to_kafka(
    df: DataFrame, servers: str, topic: str, value: str, key: str | None = None, mode: str = "append"
) -> DataStreamWriter | DataFrameWriter:
    """The writer to a topic. Kafka delivery is at least once; see ``merge_batch`` for once only."""
    records = kafka_records(df, value, key)
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if df.isStreaming:
        return records.writeStream.format("kafka").outputMode(mode).options(**options)
    return records.write.format("kafka").options(**options)


def to_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    columns: Names,
    *,
    batch: int = 1000,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
) -> DataFrameWriter:
    """The writer that inserts the named columns, ``batch`` rows per statement, one connection per task.

    For a stream pass ``lambda df, _: to_jdbc(df, ..).save()`` to ``foreachBatch``.
    """
    options = {"url": url, "dbtable": table, "batchsize": str(batch), "driver": driver, "user": user, "password": password}
    given = {k: v for k, v in options.items() if v is not None}
    return df.select(*names(columns)).write.format("jdbc").mode("append").options(**given)


def flush_files(folder: str) -> Callable[[str, pa.Table], None]:
    """A flush that writes each group to the Parquet file of its name: a group that comes again replaces itself."""

    def flush(name: str, rows: pa.Table) -> None:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        draft = f"{path}/.{name}.{uuid.uuid4().hex}"
        pq.write_table(rows, draft, filesystem=fs)
        fs.move(draft, f"{path}/{name}.parquet")

    return flush


def write_buffered(df: DataFrame, flush: Callable[[str, pa.Table], None], size: int = 10, batch_id: int = 0) -> DataFrame:
    """Hand rows to ``flush(name, rows)`` in groups of ``size``, the rest of a task at its end.

    The name tells batch, task and group, so that a repeated or speculative task, or a
    replayed micro-batch, can replace what it has flushed before. Gives one row per flush,
    (task, rows), so an action has to run it. As the sink of a stream use it inside
    ``foreachBatch`` with its batch id: rows not flushed when a task or executor is lost
    come again with the replayed micro-batch, which stands in for a saved buffer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        count = group = 0

        def name() -> str:
            nonlocal group
            group += 1
            return f"batch-{batch_id:06d}-task-{task:06d}-group-{group:08d}"

        def report(sizes: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"task": pa.array([task] * len(sizes), pa.int32()), "rows": pa.array(sizes, pa.int32())}
            )

        for batch in batches:
            start, flushed = 0, 0
            while count + batch.num_rows - start >= size:
                taken = size - count
                flush(name(), pa.Table.from_batches([*held, batch.slice(start, taken)]))
                held, count, start, flushed = [], 0, start + taken, flushed + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
                count += batch.num_rows - start
            yield report([size] * flushed)
        if count:
            flush(name(), pa.Table.from_batches(held))
            yield report([count])

    return df.mapInArrow(run, "task int, rows int")


def merge_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink of appended rows whose effect is once only: a replayed batch replaces itself.

    For rows that replace one another see ``KeyedSink``. Each micro-batch owns the partition ``batch=<id>`` of a Parquet table.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def fan_out(writers: dict[str, Callable[[DataFrame, int], None]]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` sink that sends each ``channel`` of a routed stream to its own writer."""

    def write(df: DataFrame, batch_id: int) -> None:
        # Kept while the channels are written, so the micro-batch is computed once.
        df.persist()
        try:
            for name, writer in writers.items():
                writer(df.filter(F.col("channel") == name).drop("channel"), batch_id)
        finally:
            df.unpersist()

    return write
