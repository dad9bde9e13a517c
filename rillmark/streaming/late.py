"""Late rows of a stream to a table of their own.

Built-in stateful operators drop late rows before user code sees them. Here each
micro-batch is split first: the largest event time of the earlier batches, less the
delay, is the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = T.StructType([T.StructField("us", T.LongType())])


class LateSplitter:
    """A ``foreachBatch`` sink that writes rows in time and late rows to two tables.

    A row is late if ``close`` of it, such as the end of its window plus the allowed
    lateness, does not lie after the watermark. All three tables are written per batch
    id, so a replayed batch replaces its own output and sees the same watermark.
    """

    def __init__(self, folder: str, *, ts: str, close: F.Column, delay_ms: int) -> None:
        self.folder, self.ts, self.close, self.delay_us = folder, ts, close, delay_ms * 1000

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        watermark = self.watermark_us(spark, batch_id)
        tagged = df.withColumn(
            "_late", F.lit(False) if watermark is None else F.unix_micros(self.close.cast("timestamp")) <= F.lit(watermark)
        )
        tagged.persist()
        try:
            for name, late in (("in_time", False), ("late", True)):
                rows = tagged.filter(F.col("_late") == late).drop("_late")
                rows.write.mode("overwrite").parquet(f"{self.folder}/{name}/batch={batch_id}")
            before = None if watermark is None else watermark + self.delay_us
            mark = tagged.agg(F.greatest(F.max(F.unix_micros(F.col(self.ts).cast("timestamp"))), F.lit(before).cast("bigint")).alias("us"))
            mark.write.mode("overwrite").parquet(f"{self.folder}/marks/batch={batch_id}")
        finally:
            tagged.unpersist()

    def watermark_us(self, spark: SparkSession, batch_id: int) -> int | None:
        """The watermark that the batches before this one left behind; the last of them carries the maximum of all."""
        if batch_id == 0:
            return None
        seen = spark.read.schema(MARK).parquet(f"{self.folder}/marks/batch={batch_id - 1}").agg(F.max("us")).first()[0]
        return None if seen is None else seen - self.delay_us

    def in_time(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/in_time")

    def late(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/late")
