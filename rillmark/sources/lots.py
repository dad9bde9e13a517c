"""A table as files that arrive one after the other, for streams of many small micro-batches."""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.columns import micros


def write_lots(df: DataFrame, folder: str, *, ts: str, lots: int = 6, delay: Column | None = None, width_us: tuple[int, int] | None = None, files: int = 1) -> tuple[int, int]:
    """Write a table as ``lots`` sets of ``files`` files, each a range of arrival times, in that order.

    A row arrives ``delay`` microseconds (a column, never negative) after its time, so rows come out of order
    by as much as that. The ranges divide ``width_us``, first and last arrival, evenly; it is taken from the
    table unless given, as it is for tables that are to arrive side by side. Rows without a time come first.
    Every lot has exactly ``files`` files, so that a stream that takes so many at once takes one lot; where rows
    are too few for that, files without rows fill up.
    """
    at = micros(df, ts) + (delay if delay is not None else F.lit(0))
    timed = df.withColumn("_at", at)
    if width_us is None:
        span = timed.agg(F.min("_at").alias("a"), F.max("_at").alias("b")).first()
        width_us = (span["a"] or 0, span["b"] or 0)
    first, last = width_us
    step = max(1, -(-(last - first + 1) // lots))
    lot = F.greatest(F.lit(0), F.least(F.lit(lots - 1), F.floor((F.col("_at") - F.lit(first)) / F.lit(step))))
    numbered = timed.withColumn("_lot", F.coalesce(lot, F.lit(0)))
    for k in range(lots):
        # one write after the other, so that file times follow the arrival
        lot = numbered.filter(F.col("_lot") == k).drop("_at", "_lot")
        # dealt by hash, as a deal in turn would sort every task's rows first
        lot = lot.repartition(1) if files == 1 else lot.repartition(files, F.xxhash64(*df.columns))
        lot.write.mode("append").parquet(folder)
        for _ in range((k + 1) * files - _files(folder) if files > 1 else 0):
            df.sparkSession.createDataFrame([], df.schema).write.mode("append").parquet(folder)
    return width_us


def _files(folder: str) -> int:
    fs, path = pafs.FileSystem.from_uri(folder)
    return sum(i.base_name.endswith(".parquet") for i in fs.get_file_info(pafs.FileSelector(path)))


def lots_stream(spark: SparkSession, folder: str, schema, files: int = 1) -> DataFrame:
    """The files as a stream that takes one lot per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
