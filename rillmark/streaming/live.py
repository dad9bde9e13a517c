"""Window counts that a running stream updates, with the rows that come too late beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, names, split_window
from rillmark.sinks.keyed import KeyedTable, added
from rillmark.streaming.late import LateSplitter


class LiveCounts(LateSplitter):
    """A ``foreachBatch`` sink that counts rows per key and fixed window and tells of each change at once.

    A window takes rows until the watermark has passed its end by ``lateness_ms``; what comes later goes to the
    ``late`` table. Each micro-batch adds its counts, made before they are shuffled, to those so far, which lie
    in a ``KeyedTable``, and writes the new totals of the windows it has touched to ``updates``. So an updated
    count can be seen as soon as the batch that brought it has ended, and a replayed batch changes nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        *,
        key: Names,
        ts: str,
        size: str,
        delay_ms: int,
        lateness_ms: int = 0,
        buckets: int = 8,
    ) -> None:
        close = F.window(ts, size)["end"] + F.expr(f"interval {lateness_ms} milliseconds")
        super().__init__(folder, ts=ts, close=close, delay_ms=delay_ms)
        self.key, self.size = names(key), size
        fields = [schema[c] for c in self.key]
        fields += [T.StructField(c, schema[ts].dataType) for c in ("window_start", "window_end")]
        fields.append(T.StructField("cnt", T.LongType()))
        self.group = [*self.key, "window_start", "window_end"]
        self.counts = KeyedTable(spark, f"{folder}/counts", T.StructType(fields), self.group, buckets)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        super().__call__(df, batch_id)
        spark = df.sparkSession
        in_time = spark.read.schema(df.schema).parquet(f"{self.folder}/in_time/batch={batch_id}")
        new = split_window(in_time.groupBy(*self.key, F.window(self.ts, self.size).alias("window")).agg(F.count(F.lit(1)).alias("cnt")))
        new = new.select(*self.counts.schema.fieldNames())
        after = self.counts.merge(batch_id, new, added(self.group, "cnt"))
        changed = after.join(new.select(*self.group).distinct(), self.group, "left_semi")
        changed.write.mode("overwrite").parquet(f"{self.folder}/updates/batch={batch_id}")

    def updates(self, spark: SparkSession) -> DataFrame:
        """The totals of the windows that each batch has touched, after that batch."""
        whole = T.StructType([*self.counts.schema.fields, T.StructField("batch", T.IntegerType())])
        return spark.read.schema(whole).parquet(f"{self.folder}/updates")
