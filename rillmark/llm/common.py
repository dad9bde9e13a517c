"""Helpers shared by the corpus operators: stored steps, shared files, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.session import shared_folder

SPACES = r"[\x20\x09-\x0D]+"
ROW_GROUP_BYTES = 16 << 20
BATCH_CONF, BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: Rows of a few numbers or one hash that may be sent to every task: some 100 MB at most.
NARROW_ROWS = 1_000_000


def short_batches(spark: SparkSession) -> None:
    """Hand rows to Python a thousand at a time, unless the session says otherwise: ten thousand texts are some 50 MB,
    which the executor and the worker both hold more than once."""
    if spark.conf.get(BATCH_CONF, BATCH_DEFAULT) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, "1000")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step as Parquet under the shared folder and read it back.

    This cuts the lineage: later steps, and tasks repeated after a lost executor, read files that
    every executor can reach.
    """
    short_batches(df.sparkSession)
    folder = shared_folder(df.sparkSession, purpose)
    # a writer holds one row group in memory, which long texts make large
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def bounded(narrow: DataFrame) -> DataFrame:
    """A stored table of a few numbers or a hash per row, sent to every task if it has ``NARROW_ROWS`` rows at most.

    So the texts that it is joined with stay where they are. Beyond that Spark joins by shuffling both sides.
    """
    return F.broadcast(narrow) if narrow.count() <= NARROW_ROWS else narrow


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


#: What this worker process keeps from task to task: one thing at a time.
_KEPT: dict[tuple, object] = {}


def kept(name: tuple, make: Callable[[], object]) -> object:
    """A thing, such as a cache, that tasks of one operator share in a worker process; it gives way to any other."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int = 1024) -> DataFrame:
    """Apply a function to Arrow batches, so many rows at a time. What other operators have kept goes first."""

    short_batches(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _KEPT.clear()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield out
        # the worker lives on; what its task no longer uses goes back
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(each, schema)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path inside it."""
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, parts: Iterable[bytes]) -> int:
    """Write a file under a name of its own and then move it into place.

    A repeated or speculative attempt replaces the file by an equal one; readers never see half a file.
    """
    fs, target = filesystem(path)
    fs.create_dir(target.rpartition("/")[0], recursive=True)
    draft = f"{target}.{uuid.uuid4().hex}.tmp"
    size = 0
    with fs.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    fs.move(draft, target)
    return size


def new_folder(spark: SparkSession, purpose: str) -> str:
    return shared_folder(spark, purpose)


def blocks_of(n: int, size: int) -> int:
    return max(1, -(-n // size))
