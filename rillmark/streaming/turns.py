"""Ordered computation on a stream by the batch operators, one stretch of event time after the other.

A micro-batch holds back its rows until the watermark has passed them. What it lets through follows, in
event time, all that earlier micro-batches let through, so a batch operator can run on it as soon as it
also gets the few rows per key that it looks back at. Those are carried in a ``KeyedTable``. As the
operators cut keys with many rows, so does the stream: no key is bound to one task, and nothing but the
rows within the delay and the carried ones is held.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, micros, names
from rillmark.operators.ordered import KNOWN_SMALL, Running, same, slice_rows_of, with_running
from rillmark.sinks.keyed import KeyedTable


@dataclass(frozen=True)
class Turn:
    """What a step may know: the watermark in microseconds, and the ``slice_rows`` to hand to ordered operators."""

    watermark: int
    slice_rows: int | None


Step = Callable[[DataFrame, Turn], DataFrame]


class InTurn:
    """A ``foreachBatch`` sink that runs ``step`` on each stretch of event time.

    ``step(rows, turn)`` gets the carried rows and the new ones with two columns more:
    ``_new``, and ``position``, which numbers the rows of a key from the start of the stream. It gives the rows
    to send; they lie in ``sent`` per batch. By default the last ``reach`` rows of each key are carried on, and
    those of keys with new rows, or that fulfil ``always``, take part. ``carry(rows, turn)`` picks others,
    and then all carried rows take part in each stretch. A key's order is ``ts``, then ``seq``, a column of
    whole numbers; both are never null. Keys may be null.

    Rows that come after the watermark has passed them go to ``late``. A replayed batch reads what the
    batch before it left and replaces its own rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        *,
        key: Names,
        ts: str,
        seq: str,
        delay_ms: int,
        step: Step,
        reach: int = 1,
        carry: Step | None = None,
        always: Column | None = None,
        buckets: int = 8,
        slice_rows: int | None = None,
    ) -> None:
        self.folder, self.schema = folder, schema
        self.key, self.ts, self.seq, self.delay_us = names(key), ts, seq, delay_ms * 1000
        self.step, self.reach, self.carry, self.always, self.slice_rows = step, reach, carry, always, slice_rows
        held = T.StructType([*schema.fields, T.StructField("position", T.LongType())])
        self.carried = KeyedTable(spark, f"{folder}/carried", held, self.key, buckets)
        self._marks = f"{self.carried.path}-marks"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        passed = self._mark(batch_id - 1)
        at = micros(df, self.ts)
        now = df.agg(F.max(at).alias("us")).first()["us"]
        mark = max((x for x in (passed, now) if x is not None), default=None)
        self._set_mark(batch_id, mark)
        before = None if passed is None else passed - self.delay_us
        watermark = None if mark is None else mark - self.delay_us
        late = F.lit(False) if before is None else at <= F.lit(before)
        state = F.when(late, "late").when(at <= F.lit(watermark), "ready").otherwise("held")
        tagged = df.select(*self.schema.fieldNames(), state.alias("state"))
        if batch_id > 0:
            # what the batch before held is later than its watermark
            waiting = self._rows(spark, batch_id - 1, "held")
            tagged = tagged.unionByName(waiting.withColumn("state", F.when(at <= F.lit(watermark), "ready").otherwise("held")))
        tagged.write.mode("overwrite").partitionBy("state").parquet(f"{self.folder}/turns/batch={batch_id}")
        ready = self._rows(spark, batch_id, "ready")
        self._take(ready, batch_id, -1 if watermark is None else watermark)

    def _with(self, df: DataFrame, other: DataFrame, how: str = "left_semi") -> DataFrame:
        """The rows whose key is, or isn't, in another table."""
        there = other.select(*[F.col(c).alias(f"_k_{c}") for c in self.key]).distinct()
        return df.join(there, same(df, there, [(c, f"_k_{c}") for c in self.key]), how)

    def _take(self, ready: DataFrame, batch_id: int, watermark: int) -> None:
        old = self.carried.read(self.carried.last_batch(before=batch_id))
        if self.carry is None:
            # keys without new rows have nothing to send
            part = self._with(old, ready)
            old = part if self.always is None else old.filter(self.always).unionByName(part.filter(~self.always))
        fresh = ready.withColumns({"position": F.lit(None).cast("bigint"), "_new": F.lit(True)})
        both = old.withColumn("_new", F.lit(False)).unionByName(fresh)
        order = [self.ts, self.seq]
        # a stretch of no more rows than one task should sort holds no larger key
        limit = slice_rows_of(ready, self.slice_rows)
        limit = KNOWN_SMALL if ready.count() + old.count() <= limit else limit
        measures = {"_base": Running("max", F.col("position")), "_more": Running("sum", F.col("_new").cast("int").cast("bigint"))}
        placed = with_running(both, keys=self.key, order=order, measures=measures, slice_rows=limit)
        counted = F.coalesce("_base", F.lit(0).cast("bigint")) + F.col("_more")
        rows = placed.withColumn("position", F.when(F.col("_new"), counted).otherwise(F.col("position"))).drop("_base", "_more")
        turn = Turn(watermark, limit)
        self.step(rows, turn).write.mode("overwrite").parquet(f"{self.folder}/sent/batch={batch_id}")
        columns = self.carried.schema.fieldNames()
        if self.carry is not None:
            kept = self.carry(rows, turn).select(*columns)
            touched = old.select(*columns).unionByName(rows.select(*columns))
            self.carried.merge(batch_id, touched, lambda _, new: kept)
            return
        # a limit per key that tasks apply before they shuffle
        last = Window.partitionBy(*self.key).orderBy(*[F.col(c).desc() for c in order])
        kept = rows.withColumn("_rank", F.row_number().over(last)).filter(F.col("_rank") <= self.reach).select(*columns)
        self.carried.merge(batch_id, kept, self._replaced)

    def _replaced(self, old: DataFrame, new: DataFrame) -> DataFrame:
        return self._with(old, new, "left_anti").unionByName(new)

    def _rows(self, spark: SparkSession, batch_id: int, state: str) -> DataFrame:
        # read with its partition column, as a state without rows has no folder
        whole = T.StructType([*self.schema.fields, T.StructField("state", T.StringType())])
        found = spark.read.schema(whole).parquet(f"{self.folder}/turns/batch={batch_id}")
        return found.filter(F.col("state") == state).drop("state")

    def _mark(self, batch_id: int) -> int | None:
        """The largest time up to a batch."""
        found = self.carried.fs.get_file_info(f"{self._marks}/{batch_id}.json")
        if not found.is_file:
            return None
        with self.carried.fs.open_input_file(found.path) as source:
            return json.loads(source.read())

    def _set_mark(self, batch_id: int, mark: int | None) -> None:
        fs = self.carried.fs
        fs.create_dir(self._marks, recursive=True)
        draft = f"{self._marks}/.{batch_id}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(mark).encode())
        fs.move(draft, f"{self._marks}/{batch_id}.json")

    def sent(self, spark: SparkSession, schema: T.StructType | None = None) -> DataFrame:
        """All rows sent so far."""
        read = spark.read.schema(schema) if schema else spark.read
        return read.option("basePath", f"{self.folder}/sent").parquet(f"{self.folder}/sent")

    def late(self, spark: SparkSession) -> DataFrame:
        whole = T.StructType([*self.schema.fields, T.StructField("state", T.StringType()), T.StructField("batch", T.IntegerType())])
        return spark.read.schema(whole).parquet(f"{self.folder}/turns").filter("state = 'late'").drop("state", "batch")
