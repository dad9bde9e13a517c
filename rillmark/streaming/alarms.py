"""Event-time timers of all keys as rows that wait in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, names
from rillmark.streaming.late import LateSplitter


class AlarmSink(LateSplitter):
    """A ``foreachBatch`` sink that sets a timer ``wait_ms`` after each row and tells when it was set and when it rang.

    ``told`` has the key, ``kind`` (``set`` or ``rang``), ``time_ms`` and ``clock_ms``, the watermark then, null before the
    first. A timer rings once per key and time, in the micro-batch whose rows bring the watermark to its time. Timers that wait
    are rows, dealt over all tasks, and not calls per event of a task that holds the key; rows that come too late set none.
    Each table is written per batch id, so a replayed batch replaces its own output.
    """

    def __init__(self, folder: str, *, key: Names, ts: str, wait_ms: int, delay_ms: int) -> None:
        super().__init__(folder, ts=ts, close=F.col(ts), delay_ms=delay_ms)
        self.key, self.wait_ms = names(key), wait_ms

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        super().__call__(df.select(*self.key, self.ts), batch_id)
        spark = df.sparkSession
        before, now = (self._clock(spark, k) for k in (batch_id, batch_id + 1))
        schema = df.select(*self.key, self.ts).schema
        at = F.unix_millis(F.col(self.ts).cast("timestamp"))
        in_time = spark.read.schema(schema).parquet(f"{self.folder}/in_time/batch={batch_id}").select(*self.key, at.alias("time_ms"))
        said = in_time.select(*self.key, F.lit("set").alias("kind"), "time_ms", F.lit(before).cast("bigint").alias("clock_ms"))
        said.write.mode("overwrite").parquet(f"{self.folder}/told/batch={batch_id}/step=0")
        timers = in_time.withColumn("time_ms", F.col("time_ms") + self.wait_ms)
        if batch_id > 0:
            timers = timers.unionByName(self._timers(spark, timers.schema, batch_id - 1).filter(~F.col("due")).drop("due"))
        due = F.lit(False) if now is None else F.col("time_ms") <= F.lit(now)
        timers.distinct().withColumn("due", due).write.mode("overwrite").partitionBy("due").parquet(f"{self.folder}/timers/batch={batch_id}")
        rang = self._timers(spark, timers.schema, batch_id).filter("due")
        rang = rang.select(*self.key, F.lit("rang").alias("kind"), "time_ms", F.lit(now).cast("bigint").alias("clock_ms"))
        rang.write.mode("overwrite").parquet(f"{self.folder}/told/batch={batch_id}/step=1")

    def _clock(self, spark: SparkSession, batch_id: int) -> int | None:
        us = self.watermark_us(spark, batch_id)
        return None if us is None else us // 1000

    def _timers(self, spark: SparkSession, schema: T.StructType, batch_id: int) -> DataFrame:
        # read with its partition column, as a side without rows has no folder
        whole = T.StructType([*schema.fields, T.StructField("due", T.BooleanType())])
        return spark.read.schema(whole).parquet(f"{self.folder}/timers/batch={batch_id}")

    def told(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/told").drop("batch", "step")
