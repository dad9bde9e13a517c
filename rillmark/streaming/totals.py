"""Counts since the beginning that are due some time after the first event since the last report."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillmark.columns import Names, micros, names
from rillmark.streaming.turns import InTurn, Turn


class TotalsInTurn(InTurn):
    """A ``foreachBatch`` sink that sends each key's count ``wait_us`` after the first event since its last report.

    Rows wait until the watermark has passed them. Each stretch is then dealt by key, sorted and read through once, next to
    one row per key with the count so far and when its open report is due; a report also goes out when only the watermark
    comes to it. A task holds one row at a time, however many a key has. ``sent`` has the key, ``reported_us`` and ``total``.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, *, key: Names, ts: str, seq: str, wait_us: int, delay_ms: int) -> None:
        super().__init__(spark, folder, schema, key=key, ts=ts, seq=seq, delay_ms=delay_ms, step=self._unused)
        fields = [schema[c] for c in self.key]
        numbers = [T.StructField(c, T.LongType()) for c in ("total", "report_at")]
        # one row per key
        self.carried.schema = T.StructType([*fields, *numbers])
        self.wait_us = wait_us

    @staticmethod
    def _unused(rows: DataFrame, turn: Turn) -> DataFrame:
        raise NotImplementedError

    def _take(self, ready: DataFrame, batch_id: int, watermark: int) -> None:
        spark = ready.sparkSession
        old = self.carried.read(self.carried.last_batch(before=batch_id))
        new = ready.select(*self.key, micros(ready, self.ts).alias("_at"), F.col(self.seq).cast("bigint").alias("_seq"))
        both = old.unionByName(new, allowMissingColumns=True).select(*self.key, "_at", "_seq", "total", "report_at")
        # the carried row of a key has no time and comes first
        dealt = both.repartition(*[F.col(c) for c in self.key]).sortWithinPartitions(*self.key, F.col("_at").asc_nulls_first(), "_seq")
        kept = [f for f in both.schema if f.name in self.key]
        out = T.StructType([*kept, *[T.StructField(c, T.LongType()) for c in ("reported_us", "total", "report_at")], T.StructField("state", T.BooleanType())])
        found = dealt.mapInArrow(read_through(self.key, out, self.wait_us, watermark), out)
        at = f"{self.folder}/totals/batch={batch_id}"
        found.write.mode("overwrite").partitionBy("state").parquet(at)
        found = spark.read.schema(out).parquet(at)
        reports = found.filter("NOT state").select(*self.key, "reported_us", "total")
        reports.write.mode("overwrite").parquet(f"{self.folder}/sent/batch={batch_id}")
        # every key has its row in what was read through
        self.carried.merge(batch_id, found.filter("state").select(*self.carried.schema.fieldNames()), lambda _, rows: rows)


def read_through(key: list[str], out: T.StructType, wait_us: int, watermark: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reports of rows that are sorted by key and time, and each key's count and open report after them."""
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        total, due = 0, None
        sent: list[tuple] = []

        def end() -> None:
            nonlocal due
            if current is None:
                return
            if due is not None and due <= watermark:
                sent.append((*current, due, total, None, False))
                due = None
            sent.append((*current, None, total, due, True))

        def told() -> pa.RecordBatch:
            columns = list(zip(*sent)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in key])
            rest = [batch.column(c).to_pylist() for c in ("_at", "total", "report_at")]
            for k, at, before, open_until in zip(keys, *rest):
                if k != current:
                    end()
                    current, total, due = k, 0, None
                if at is None:
                    total, due = before, open_until
                    continue
                # events of the very time of the report still count
                if due is not None and at > due:
                    sent.append((*k, due, total, None, False))
                    due = None
                total += 1
                if due is None:
                    due = at + wait_us
            yield told()
            sent = []
        end()
        yield told()

    return run
